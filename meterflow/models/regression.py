"""MLlib regressors for the specs of :mod:`.registry`, and their parallel fits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import join_on
from ..schema import SEED
from .least_squares import LeastSquares
from .registry import BOOSTING, ELASTIC_NET, HISTOGRAM, OLS, RANDOMISED, RIDGE, ModelSpec, full_depth
from .trees import HistogramBoosting, RandomisedTrees

VECTOR = "features"
_ITERATIONS = 6000


@dataclass(frozen=True)
class LabelStats:
    """Rows and population deviation of the label, which penalties scale with."""

    rows: int
    deviation: float


def label_stats(train: DataFrame, label: str) -> LabelStats:
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LabelStats(row["n"], row["s"] or 0.0)


def assemble(frame: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    return assembler.transform(frame).select(*keep, VECTOR)


def standardize(frame: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Features minus their mean over their population deviation.

    A constant feature becomes zero. MLlib's scaler divides by the sample
    deviation; its linear models scale by the population one on their own.
    """
    moments = frame.groupBy(*keys).agg(
        *[F.avg(name).alias(f"_mean_{name}") for name in features],
        *[F.stddev_pop(name).alias(f"_dev_{name}") for name in features],
    )
    if keys:
        rows = join_on(frame, moments, keys)
    else:
        one = moments.select(F.struct("*").alias("m")).scalar()
        rows = frame.withColumn("_m", one).select("*", "_m.*")
    scaled = {}
    for name in features:
        centred = F.col(name) - F.col(f"_mean_{name}")
        deviation = F.col(f"_dev_{name}")
        scaled[name] = F.when(deviation == 0, F.lit(0.0)).otherwise(
            F.try_divide(centred, deviation)
        )
    return rows.withColumns(scaled).select(*frame.columns)


def penalties(spec: ModelSpec, stats: LabelStats) -> tuple[float, float]:
    """MLlib's ``regParam`` and ``elasticNetParam`` for a spec.

    MLlib divides the label by its deviation before it fits, which weakens an
    L2 penalty by that factor and leaves an L1 penalty as it is.
    """
    if spec.kind == RIDGE:
        return spec.alpha * stats.deviation / max(stats.rows, 1), 0.0
    if spec.kind == ELASTIC_NET:
        lasso = spec.alpha * spec.l1_ratio
        ridge = spec.alpha * (1.0 - spec.l1_ratio) * stats.deviation
        total = lasso + ridge
        return total, lasso / total if total else 0.0
    raise ValueError(f"{spec.kind} has no penalty")


def estimator(spec: ModelSpec, label: str, stats: LabelStats) -> Estimator | LeastSquares | HistogramBoosting | RandomisedTrees:
    common = {"featuresCol": VECTOR, "labelCol": label, "predictionCol": spec.name}
    if spec.kind == OLS:
        return LeastSquares(label, spec.name)
    if spec.kind in (RIDGE, ELASTIC_NET):
        strength, mix = penalties(spec, stats)
        # The iterations of an L1 penalty run on the summed moments, not the data.
        iterations = _ITERATIONS if mix else 100
        return LinearRegression(
            regParam=strength, elasticNetParam=mix, maxIter=iterations, tol=1e-9, **common
        )
    if spec.kind == HISTOGRAM:
        return HistogramBoosting(
            label, spec.name, spec.trees, spec.step, full_depth(spec), spec.min_leaf, spec.bins,
            spec.l1, spec.l2, spec.rows, _share(spec.features),
        )
    if spec.kind == RANDOMISED:
        return RandomisedTrees(
            label, spec.name, spec.trees, full_depth(spec), spec.min_leaf, spec.rows, _share(spec.features)
        )
    trees = {
        "maxDepth": full_depth(spec),
        "minInstancesPerNode": spec.min_leaf,
        "maxBins": spec.bins,
        "subsamplingRate": spec.rows,
        "featureSubsetStrategy": spec.features,
        "seed": SEED,
    }
    if spec.kind == BOOSTING:
        return GBTRegressor(maxIter=spec.trees, stepSize=spec.step, **trees, **common)
    return RandomForestRegressor(
        numTrees=spec.trees, bootstrap=spec.bootstrap, **trees, **common
    )


def _share(features: str) -> float:
    return 1.0 if features == "all" else float(features)


def fit_all(
    spark: SparkSession, fits: Sequence[Callable[[], Model]], parallelism: int
) -> list[Model]:
    """Run independent fits at once; their Spark jobs share the cluster."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        running = [pool.submit(inherit(fit)) for fit in fits]
        return [fit.result() for fit in running]


def score(models: dict[str, Model], vectors: DataFrame) -> DataFrame:
    """A prediction column per model, all in one pass over the rows."""
    scored = vectors
    for model in models.values():
        scored = model.transform(scored)
    return scored
