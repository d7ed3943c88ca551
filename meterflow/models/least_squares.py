"""Least squares where features may repeat each other: a rank-revealing solve of summed moments.

The covariances of features and label are summed in one tree aggregation of
centred rows; only that matrix, one row and column per feature, reaches the
driver. Its eigenvalues tell which directions of the scaled features exist.
Directions below ``TOLERANCE`` of the largest one are repeats and get no weight,
so the answer is the one of least norm. A constant feature has no weight.

Rows without a label are left out; fewer than two rows raise ``ValueError``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .trees import VECTOR

TOLERANCE = 1e-12


@dataclass
class LinearModel:
    """A fitted line: ``intercept`` and a weight per feature."""

    output: str
    intercept: float
    weights: list[float]

    def transform(self, rows: DataFrame) -> DataFrame:
        weights = F.array(*map(F.lit, self.weights))
        terms = F.zip_with(vector_to_array(VECTOR), weights, lambda x, w: x * w)
        return rows.withColumn(self.output, F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b))

    def write(self) -> LinearModel:
        return self

    def overwrite(self) -> LinearModel:
        return self

    def save(self, path: str) -> None:
        """One row of a Parquet table; an earlier model at ``path`` is replaced."""
        spark = SparkSession.getActiveSession()
        row = spark.createDataFrame(
            [(self.output, self.intercept, self.weights)], "output string, intercept double, weights array<double>"
        )
        row.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> LinearModel:
        row = SparkSession.getActiveSession().read.parquet(path).first()
        return cls(row.output, row.intercept, list(row.weights))


@dataclass
class LeastSquares:
    label: str
    output: str

    def fit(self, data: DataFrame) -> LinearModel:
        both = F.concat(vector_to_array(VECTOR), F.array(F.col(self.label).cast("double")))
        # Dense vectors are centred before they are summed.
        rows = data.filter(F.col(self.label).isNotNull()).select(array_to_vector(both).alias("_row"))
        matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "_row"))
        stats = matrix.computeColumnSummaryStatistics()
        if stats.count() < 2:
            raise ValueError("least squares needs at least two rows")
        means = stats.mean()
        moments = matrix.computeCovariance().toArray()
        weights = solve(moments[:-1, :-1], moments[:-1, -1])
        return LinearModel(self.output, float(means[-1] - weights @ means[:-1]), weights.tolist())


def solve(gram: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """The weights whose scaled form has the least norm."""
    deviation = np.sqrt(np.maximum(np.diag(gram), 0.0))
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    values, vectors = np.linalg.eigh(gram * np.outer(scale, scale))
    real = values > TOLERANCE * max(values.max(initial=0.0), 0.0)
    basis = vectors[:, real]
    return scale * (basis @ ((basis.T @ (scale * pull)) / values[real]))
