"""Multiclass boosting: one softmax model over all classes, a tree per class in every round.

The chances of a row's classes come from margins that start at the logarithms of
the classes' shares. A round takes the gradients of all classes at once: one
aggregation per level finds the splits of all its trees, so a round costs as many
jobs as its trees have levels, whatever the number of classes. Rows of the same
class in the same bins have the same gradients in every round, so they are one
row with their number from the start.

Gradients are counted in whole units, as in :mod:`.trees`, so sums do not depend
on how rows are dealt over tasks. Rows hold MLlib vectors without missing values;
rows without a class are left out. Fewer than two classes raise ``ValueError``.
The classes are one driver row each (hours of a day here).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import stage, stage_folder
from .trees import _TREE, _WALK, UNITS, VECTOR, Tree, _binned, bin_edges

# Margins are written after so many rounds; between, they are computed from those rounds' trees.
ROUNDS_PER_STAGE = 4
_MODEL = f"base array<double>, trees array<array<{_TREE}>>, grown array<{_TREE}>, first array<int>"

# The best split of every open node of every class's tree, by the squared sums of residuals over rows.
_SPLITS = """
WITH placed AS (
    SELECT _x, _n, inline(filter(transform(_p, (p, tree) -> struct(tree, {node} AS node,
        CAST(round((if(tree = _y, 1D, 0D) - p) * {units}D) AS BIGINT) AS g,
        CAST(round(p * (1 - p) * {units}D) AS BIGINT) AS h)), r -> r.node >= get(_m.first, r.tree)))
    FROM {table}
), sums AS (
    SELECT tree, node, feature, bin, sum(g) AS g, sum(h) AS h, sum(_n) AS n
    FROM (SELECT tree, node, _n, g * _n AS g, h * _n AS h, posexplode(_x) AS (feature, bin) FROM placed)
    GROUP BY tree, node, feature, bin
), sides AS (
    SELECT tree, node, feature, bin, gl, hl, nl, ga, ga - gl AS gr, ha - hl AS hr, na, na - nl AS nr FROM (
        SELECT *, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl, sum(n) OVER upto AS nl,
            sum(g) OVER own AS ga, sum(h) OVER own AS ha, sum(n) OVER own AS na
        FROM sums
        WINDOW own AS (PARTITION BY tree, node, feature),
            upto AS (PARTITION BY tree, node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )
), gains AS (
    SELECT *, CAST(gl AS DOUBLE) * gl / nl + CAST(gr AS DOUBLE) * gr / nr - CAST(ga AS DOUBLE) * ga / na AS gain
    FROM sides WHERE nl >= {min_leaf} AND nr >= {min_leaf}
)
SELECT tree, node, max_by(struct(feature, bin, gl, hl, gr, hr), struct(gain, -feature, -bin)) AS s
FROM gains WHERE gain > 0 GROUP BY tree, node
"""


def _model(spark: SparkSession, base=(), trees=(), grown=(), first=()) -> DataFrame:
    """One row; its size is that of the trees."""
    rows = [[tree.row() for tree in own] for own in trees]
    return spark.createDataFrame([(list(base), rows, [tree.row() for tree in grown], list(first))], _MODEL)


def _margins(start: str, depth: int) -> Column:
    """Every class's margin after the trees of ``_m``, from the margins in ``start``."""
    walk = _WALK.format(depth=max(depth, 1), tree="t")
    return F.expr(f"transform({start}, (s, k) -> aggregate(get(_m.trees, k), s, (a, t) -> a + get(t.value, {walk})))")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once a row, and not again for each class that ``then`` goes through."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _softmax(margins: str) -> Column:
    """Chances that sum to 1; the largest margin is taken off first, so none overflows."""
    shifted = _once(F.array_max(margins), lambda top: F.transform(margins, lambda f: F.exp(f - top)))
    return _once(shifted, lambda own: _once(
        F.aggregate(own, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(own, lambda e: e / total)
    ))


@dataclass
class SoftmaxEnsemble:
    """A fitted model; ``output`` is the array of chances of ``labels``, in their order."""

    output: str
    labels: list[int]
    base: list[float]
    depth: int
    trees: list[list[Tree]]  # of each class, in the order of the rounds

    def transform(self, rows: DataFrame) -> DataFrame:
        model = _model(rows.sparkSession, self.base, self.trees).select(F.struct("*").alias("_m"))
        joined = rows.crossJoin(F.broadcast(model)).withColumn("_x", vector_to_array(VECTOR))
        scored = joined.withColumn("_f", _margins("_m.base", self.depth))
        return scored.withColumn(self.output, _softmax("_f")).drop("_m", "_x", "_f")

    def write(self) -> SoftmaxEnsemble:
        return self

    def overwrite(self) -> SoftmaxEnsemble:
        return self

    def save(self, path: str) -> None:
        """One row of a Parquet table; an earlier model at ``path`` is replaced."""
        spark = SparkSession.getActiveSession()
        row = _model(spark, self.base, self.trees).select("base", "trees").withColumns({
            "output": F.lit(self.output), "depth": F.lit(self.depth),
            "labels": F.array(*(F.lit(label) for label in self.labels)),
        })
        row.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> SoftmaxEnsemble:
        row = SparkSession.getActiveSession().read.parquet(path).first()
        names = ("feature", "threshold", "child", "value")
        trees = [[Tree(*(list(getattr(tree, name)) for name in names)) for tree in own] for own in row.trees]
        return cls(row.output, list(row.labels), list(row.base), row.depth, trees)


@dataclass
class SoftmaxBoosting:
    """Boosting on the multinomial log-loss over binned features.

    A leaf's value is ``step`` times (K - 1) / K times the sum of its residuals over the sum of
    p(1 - p), for K classes: one Newton step. Trees grow level by level to ``depth``.
    """

    label: str
    output: str
    rounds: int
    step: float
    depth: int
    min_leaf: int = 1
    bins: int = 255

    def fit(self, data: DataFrame) -> SoftmaxEnsemble:
        data = data.filter(F.col(self.label).isNotNull())
        counts = {int(row[0]): row[1] for row in data.groupBy(self.label).count().collect()}  # a row per class
        labels, n = sorted(counts), sum(counts.values())
        if len(labels) < 2:
            raise ValueError("boosting needs at least two different classes")
        base = [math.log(counts[label] / n) for label in labels]
        edges = bin_edges(data, self.bins)
        place = F.array_position(F.array(*map(F.lit, labels)), F.col("_y").cast("int")) - 1
        placed = _binned(data, self.label, edges, 0.0).select("_x", place.cast("int").alias("_y"))
        cells = placed.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
        folder = stage_folder(data.sparkSession)
        table = stage(cells.withColumn("_f", F.array(*map(F.lit, base))), folder, "binned0")
        done: list[list[Tree]] = [[] for _ in labels]
        fresh: list[list[Tree]] = [[] for _ in labels]  # not yet part of the table's margins
        for number in range(self.rounds):
            if len(fresh[0]) == ROUNDS_PER_STAGE:
                table = stage(self._with_model(table, fresh).drop("_m"), folder, f"binned{number}")
                done, fresh = [a + b for a, b in zip(done, fresh, strict=True)], [[] for _ in labels]
            for own, tree in zip(fresh, self._round(table, fresh), strict=True):
                own.append(tree)
        trees = [[self._raw(tree, edges) for tree in a + b] for a, b in zip(done, fresh, strict=True)]
        return SoftmaxEnsemble(self.output, labels, base, self.depth, trees)

    def _with_model(self, table: DataFrame, trees, grown=(), first=()) -> DataFrame:
        """The margins after ``trees``, and the model row beside them."""
        model = _model(table.sparkSession, (), trees, grown, first).select(F.struct("*").alias("_m"))
        joined = table.crossJoin(F.broadcast(model))
        return joined.withColumn("_f", _margins("_f", self.depth)) if any(trees) else joined

    def _raw(self, tree: Tree, edges: list[list[float]]) -> Tree:
        """The tree with thresholds of values in place of bins."""
        cuts = [edges[f][int(t) - 1] if f >= 0 else t for f, t in zip(tree.feature, tree.threshold, strict=True)]
        return Tree(tree.feature, cuts, tree.child, tree.value)

    def _round(self, table: DataFrame, fresh: list[list[Tree]]) -> list[Tree]:
        """A tree per class."""
        spark = table.sparkSession
        grown = [Tree() for _ in fresh]
        first = [0] * len(grown)
        for level in range(self.depth):
            rows = self._with_model(table, fresh, grown, first).withColumn("_p", _softmax("_f"))
            view = f"softmax_{uuid.uuid4().hex}"
            rows.createOrReplaceTempView(view)
            try:
                node = _WALK.format(depth=level, tree="get(_m.grown, tree)") if level else "0"
                found = spark.sql(_SPLITS.format(units=UNITS, table=view, node=node, min_leaf=self.min_leaf))
                splits = found.collect()  # at most a row per open node
            finally:
                spark.catalog.dropTempView(view)
            first = [len(tree.feature) for tree in grown]
            for row in sorted(splits, key=lambda r: (r.tree, r.node)):
                self._split(grown[row.tree], row, len(grown))
            if not splits:
                break
        return grown

    def _split(self, tree: Tree, row: Row, classes: int) -> None:
        s = row.s
        values = [self.step * (classes - 1) / classes * g / h if h else 0.0 for g, h in ((s.gl, s.hl), (s.gr, s.hr))]
        tree.split(row.node, s.feature, float(s.bin + 1), *values)
