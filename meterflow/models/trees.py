"""Tree ensembles grown by grouped aggregation: histogram boosting and extremely randomised trees.

MLlib's trees have no leaf penalty, sample columns per node and search the best
threshold. Here a level of a tree is one aggregation over all rows, and only
the chosen splits of a level (at most two per node above) reach the driver.

Residuals are counted in whole units (a power of two fits the label's spread),
so sums do not depend on how rows are dealt over tasks, and the same data give
the same trees on any cluster. Random choices are hashes of seed, tree, node and
feature for the same reason.

Rows hold MLlib vectors without missing values. No rows raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import SEED
from ..session import stage, stage_folder

VECTOR = "features"
# A feature's values are cut into this many cells to find its quantiles; the sketch that gives the cuts errs
# by at most one part in ``SKETCH`` of the rows.
CELLS = 2_000
SKETCH = 10_000
# Residuals are whole multiples of the label's spread over this.
UNITS = 1 << 30
# Margins are written after so many trees; between, they are computed from those trees.
TREES_PER_STAGE = 8
LEAF = -1
_TREE = "struct<feature: array<int>, threshold: array<double>, child: array<int>, value: array<double>>"
_MODEL = f"base double, depth int, trees array<{_TREE}>"
# Follows one tree from its root; the right child comes after the left one.
_WALK = """aggregate(sequence(1, {depth}), 0, (n, i) -> if(get({tree}.feature, n) < 0, n,
    get({tree}.child, n) + if(get(_x, get({tree}.feature, n)) >= get({tree}.threshold, n), 1, 0)))"""
# Nodes are numbered level by level, so the open ones are those from the level's first on.


@dataclass
class Tree:
    """Nodes in arrays: the feature that splits (or ``LEAF``), threshold, left child, value."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, threshold: float, left: float, right: float) -> tuple[int, int]:
        """Rows of at least the threshold go right. The numbers of both children."""
        self.feature[node], self.threshold[node], self.child[node] = feature, threshold, len(self.feature)
        for value in (left, right):
            self.feature.append(LEAF)
            self.threshold.append(0.0)
            self.child.append(0)
            self.value.append(value)
        return self.child[node], self.child[node] + 1

    def literal(self) -> str:
        """The tree as a SQL value."""
        numbers = {name: ", ".join(f"{x!r}{'D' if isinstance(x, float) else ''}" for x in getattr(self, name)) for name in self.__dict__}
        return f"named_struct({', '.join(f'{name!r}, array({values})' for name, values in numbers.items())})"

    def row(self) -> Row:
        return Row(feature=self.feature, threshold=self.threshold, child=self.child, value=self.value)


def _model_row(spark: SparkSession, base: float, depth: int, trees: Sequence[Tree]) -> DataFrame:
    """One row; its size is that of the trees, which ``depth`` and their number bound."""
    return spark.createDataFrame([(float(base), max(depth, 1), [tree.row() for tree in trees])], _MODEL)


def _sum_of_trees(start: str, trees: str, depth: str) -> Column:
    return F.expr(f"aggregate({trees}, {start}, (s, t) -> s + get(t.value, {_WALK.format(depth=depth, tree='t')}))")


@dataclass
class TreeEnsemble:
    """A fitted sum of trees: ``base`` and the values of the leaves a row falls into."""

    output: str
    base: float
    depth: int
    trees: list[Tree]

    def transform(self, rows: DataFrame) -> DataFrame:
        model = _model_row(rows.sparkSession, self.base, self.depth, self.trees).select(F.struct("*").alias("_m"))
        joined = rows.crossJoin(F.broadcast(model)).withColumn("_x", vector_to_array(VECTOR))
        return joined.withColumn(self.output, _sum_of_trees("_m.base", "_m.trees", "_m.depth")).drop("_m", "_x")

    def write(self) -> TreeEnsemble:
        return self

    def overwrite(self) -> TreeEnsemble:
        return self

    def save(self, path: str) -> None:
        """One row of a Parquet table; an earlier model at ``path`` is replaced."""
        spark = SparkSession.getActiveSession()
        row = _model_row(spark, self.base, self.depth, self.trees).withColumn("output", F.lit(self.output))
        row.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> TreeEnsemble:
        row = SparkSession.getActiveSession().read.parquet(path).first()
        trees = [Tree(*(list(getattr(t, name)) for name in ("feature", "threshold", "child", "value"))) for t in row.trees]
        return cls(row.output, row.base, row.depth, trees)


def share(*parts: object) -> float:
    """A number in [0, 1) fixed by its arguments."""
    digest = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return int(digest[:8], 16) / 2**32


def _share_column(*parts: Column) -> Column:
    """:func:`share` of columns."""
    text = F.concat_ws(":", *(part.cast("string") for part in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 2**32


@dataclass
class _Label:
    mean: float
    unit: float  # a residual of 1 in whole units is 1 / unit


def _label(rows: DataFrame, label: str) -> _Label:
    found = rows.agg(
        F.count(label).alias("n"), F.min(label).alias("low"), F.max(label).alias("high"),
    ).first()
    if not found.n:
        raise ValueError("no rows to grow trees on")
    spread = max(found.high - found.low, 1e-200) if found.high > found.low else 1.0
    unit = 2.0 ** math.floor(math.log2(UNITS / spread))
    total = rows.agg(F.sum(F.round((F.col(label) - found.low) * unit).cast("long")).alias("s")).first().s
    return _Label(found.low + total / unit / found.n, unit)


def bin_edges(rows: DataFrame, bins: int) -> list[list[float]]:
    """Per feature the values that part its bins: quantiles of all rows, repeats left out; a bin starts at its edge.

    Cuts from a sketch part a feature's values into cells, and all rows are counted by cell, which
    tells the cell of every wanted rank; the sketch's error only makes cells more or less even. In
    those cells values are counted one by one, and running counts find the ranks. So no task holds a
    feature's values, and the driver gets the counts of the cells and at most two values per edge.
    """
    shares = ", ".join(f"{k / CELLS!r}D" for k in range(CELLS))
    near = rows.select(F.posexplode(vector_to_array(VECTOR)).alias("feature", "value")).groupBy("feature").agg(
        F.expr(f"percentile_approx(value, array({shares}), {SKETCH})").alias("cuts")
    )
    cuts = [sorted({c for c in row.cuts if math.isfinite(c)}) for row in sorted(near.collect(), key=lambda r: r.feature)]
    cells = _placed(rows, [], cuts).select(F.posexplode(F.arrays_zip("_x", "_v")).alias("feature", "_c"))
    cells = cells.select("feature", F.col("_c._x").cast("int").alias("cell"), F.col("_c._v").alias("value"))
    sizes = cells.groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("_s"))
    positions, wanted = [], []
    for row in sizes.select("feature", "_s.cell", "_s.n").orderBy("feature").collect():
        upto = list(accumulate(row.n))
        positions.append([(upto[-1] - 1) * (k / bins) for k in range(bins)])
        for rank in sorted({f(p) for p in positions[-1] for f in (math.floor, math.ceil)}):
            k = bisect_right(upto, rank)
            wanted.append((row.feature, row.cell[k], rank - upto[k] + row.n[k], rank))
    # A row per wanted rank, counted from 0 in its cell (``at``) and in all rows.
    ranks = F.broadcast(rows.sparkSession.createDataFrame(wanted, "feature int, cell int, at long, rank long"))
    counted = cells.join(ranks, ["feature", "cell"], "left_semi").groupBy("feature", "cell", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("feature", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    found = upto.join(ranks, ["feature", "cell"]).filter("at < upto AND at >= upto - n")
    values = {(row.feature, row.rank): row.value for row in found.select("feature", "rank", "value").collect()}
    edges = []
    for feature, own in enumerate(positions):
        at = [_between(p, values[feature, math.floor(p)], values[feature, math.ceil(p)]) for p in own]
        edges.append(sorted({e for e in at if e > at[0]}))  # the first is the least value
    return edges


def _between(position: float, low: float, high: float) -> float:
    """The value at a position between two ranks, as ``percentile`` computes it."""
    return low if low == high else (math.ceil(position) - position) * low + (position - math.floor(position)) * high


def _placed(rows: DataFrame, keep: Sequence[Column], edges: list[list[float]]) -> DataFrame:
    """``keep``, the values ``_v``, and ``_x``: the number of each feature's edges up to its value."""
    values = rows.select(*keep, vector_to_array(VECTOR).alias("_v"))
    kept, single = values.columns[:-1], [f"_v{k}" for k in range(len(edges))]
    # -0.0 + 0.0 is 0.0: the bucketizer tells the two zeros apart, comparisons and groups do not.
    wide = values.select(*kept, *((F.get("_v", F.lit(k)) + F.lit(0.0)).alias(name) for k, name in enumerate(single)))
    splits = [["-Inf", *own, "Inf"] if own else ["-Inf", 0.0, "Inf"] for own in edges]
    names = [f"_b{k}" for k in range(len(edges))]
    bucketizer = Bucketizer(inputCols=single, outputCols=names)
    # As one text: 2,000 splits of 63 features take 25 s where each number is a call.
    java = bucketizer._java_obj
    java.setSplitsArray(java.splitsArray().jsonDecode(json.dumps(splits)))
    wide = bucketizer.transform(wide)
    found = F.array(*(F.col(n).cast("short") if own else F.lit(0).cast("short") for n, own in zip(names, edges)))
    return wide.select(*kept, F.array(*single).alias("_v"), found.alias("_x"))


def _binned(rows: DataFrame, label: str, edges: list[list[float]], start: float) -> DataFrame:
    """``_x`` (bin numbers), the label and the margin so far."""
    placed = _placed(rows, [F.col(label).cast("double").alias("_y")], edges)
    return placed.select("_y", "_x", F.lit(start).alias("_f"))


# The best split of every node and feature. The gain is the sum of T(G)**2 / (n + l2) of both sides less
# that of the node, where T moves a sum of residuals towards 0 by l1. Equal gains go to the first bin.
_SPLITS = """
WITH residuals AS (
    SELECT _x, CAST(round((_y - {margin}) * {unit}D) AS BIGINT) AS g FROM {table} WHERE {drawn}
), placed AS (
    SELECT {node} AS node, _x, g FROM residuals
), sums AS (
    SELECT node, feature, bin, sum(g) AS g, count(1) AS n
    FROM (SELECT node, g, posexplode(_x) AS (feature, bin) FROM placed WHERE node >= {first})
    WHERE {columns}
    GROUP BY node, feature, bin
), sides AS (
    SELECT node, feature, bin, gl, nl, ga - gl AS gr, na - nl AS nr, ga, na FROM (
        SELECT node, feature, bin, sum(g) OVER upto AS gl, sum(n) OVER upto AS nl, sum(g) OVER own AS ga, sum(n) OVER own AS na
        FROM sums
        WINDOW own AS (PARTITION BY node, feature),
            upto AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    )
), gains AS (
    SELECT *, {left} + {right} - {whole} AS gain FROM sides WHERE nl >= {min_leaf} AND nr >= {min_leaf}
)
SELECT node, feature, max_by(struct(bin, gl, nl, gr, nr), struct(gain, -bin)) AS s, max(gain) AS gain
FROM gains WHERE gain > 0 GROUP BY node, feature
"""


def _weight(g: str, n: str, unit: float, l1: float, l2: float) -> str:
    size = f"abs({g} / {unit!r}D)"
    cut = f"greatest({size} - {l1!r}D, 0D)" if l1 else size
    return f"{cut} * {cut} / ({n} + {l2!r}D)"


@dataclass
class HistogramBoosting:
    """Boosting on squared error over binned features, Newton leaves -G / (H + l2) times ``step``.

    ``rows`` of the rows and ``columns`` of the features are drawn for each tree; ``l1`` and ``l2``
    are the leaf penalties. Trees grow level by level to ``depth``.
    """

    label: str
    output: str
    trees: int
    step: float
    depth: int
    min_leaf: int = 1
    bins: int = 255
    l1: float = 0.0
    l2: float = 0.0
    rows: float = 1.0
    columns: float = 1.0
    seed: int = SEED

    def fit(self, data: DataFrame) -> TreeEnsemble:
        label = _label(data, self.label)
        edges = bin_edges(data, self.bins)
        folder = stage_folder(data.sparkSession)
        table = stage(_binned(data, self.label, edges, label.mean), folder, "binned0")
        done: list[Tree] = []
        fresh: list[Tree] = []  # not yet part of the table's margins
        for number in range(self.trees):
            fresh.append(self._grow(table, fresh, number, label.unit, edges))
            if len(fresh) == TREES_PER_STAGE and number + 1 < self.trees:
                table = stage(self._with_margin(table, fresh), folder, f"binned{number + 1}")
                done, fresh = done + fresh, []
        return TreeEnsemble(self.output, label.mean, self.depth, [self._raw(tree, edges) for tree in done + fresh])

    def _with_margin(self, table: DataFrame, fresh: list[Tree]) -> DataFrame:
        if not fresh:
            return table
        model = _model_row(table.sparkSession, 0.0, self.depth, fresh).select(F.struct("*").alias("_m"))
        joined = table.crossJoin(F.broadcast(model))
        return joined.withColumn("_f", _sum_of_trees("_f", "_m.trees", "_m.depth")).drop("_m")

    def _raw(self, tree: Tree, edges: list[list[float]]) -> Tree:
        """The tree with thresholds of values in place of bins."""
        cuts = [t if f == LEAF else edges[f][int(t) - 1] for f, t in zip(tree.feature, tree.threshold, strict=True)]
        return Tree(tree.feature, cuts, tree.child, tree.value)

    def drawn_columns(self, number: int, n: int) -> list[int]:
        """The features one tree may use."""
        order = sorted(range(n), key=lambda k: (share(self.seed, "column", number, k), k))
        return sorted(order[: max(1, int(self.columns * n))])

    def _grow(self, table: DataFrame, fresh: list[Tree], number: int, unit: float, edges: list[list[float]]) -> Tree:
        columns = [k for k in self.drawn_columns(number, len(edges)) if edges[k]]
        view = f"binned_{uuid.uuid4().hex}"
        table.createOrReplaceTempView(view)
        margin = "_f"
        if fresh:
            trees = f"array({', '.join(tree.literal() for tree in fresh)})"
            walk = _WALK.format(depth=self.depth, tree="t")
            margin = f"aggregate({trees}, _f, (s, t) -> s + get(t.value, {walk}))"
        drawn = "true"
        if self.rows < 1.0:
            drawn = f"conv(substring(md5(concat_ws(':', {self.seed}, {number}, xxhash64(_x, _y))), 1, 8), 16, 10) / {2**32}D < {self.rows}D"
        sides = {side: _weight(g, n, unit, self.l1, self.l2) for side, g, n in (("left", "gl", "nl"), ("right", "gr", "nr"), ("whole", "ga", "na"))}
        tree, first = Tree(), 0
        try:
            for level in range(self.depth if columns else 0):
                found = table.sparkSession.sql(_SPLITS.format(
                    margin=margin, unit=unit, table=view, drawn=drawn, first=first, min_leaf=self.min_leaf,
                    node=_WALK.format(depth=level, tree="_t").replace("_t.", f"{tree.literal()}.") if level else "0",
                    columns=f"feature IN ({', '.join(map(str, columns))})", **sides,
                )).collect()  # at most a row per open node and feature
                first = len(tree.feature)
                if not self._split(tree, found, unit):
                    break
        finally:
            table.sparkSession.catalog.dropTempView(view)
        return tree

    def _split(self, tree: Tree, found: list[Row], unit: float) -> bool:
        """Splits every node that gains; of equal gains the first feature's counts."""
        best: dict[int, Row] = {}
        for row in found:
            held = best.get(row.node)
            if held is None or (row.gain, -row.feature) > (held.gain, -held.feature):
                best[row.node] = row
        for node, row in sorted(best.items()):
            s = row.s
            values = [self.step * self._leaf(g / unit, n) for g, n in ((s.gl, s.nl), (s.gr, s.nr))]
            tree.split(node, row.feature, float(s.bin + 1), *values)
        return bool(best)

    def _leaf(self, g: float, n: int) -> float:
        return math.copysign(max(abs(g) - self.l1, 0.0), g) / (n + self.l2)


@dataclass
class RandomisedTrees:
    """Extremely randomised trees: every feature of a node offers one random threshold, the best one splits.

    A threshold lies at a random share of the feature's range in the node. ``columns`` of the features
    are drawn for each node, ``rows`` of the rows for each tree. All trees grow together, a level at
    a time: one aggregation finds the ranges, one the sums on both sides. The prediction is their mean.
    """

    label: str
    output: str
    trees: int
    depth: int
    min_leaf: int = 1
    rows: float = 1.0
    columns: float = 1.0
    seed: int = SEED

    def fit(self, data: DataFrame) -> TreeEnsemble:
        spark = data.sparkSession
        label = _label(data, self.label)
        trees = [Tree() for _ in range(self.trees)]
        table = data.select(
            vector_to_array(VECTOR).alias("_x"), F.round((F.col(self.label) - label.mean) * label.unit).cast("long").alias("_g")
        )
        table = stage(table, stage_folder(spark), "rows")
        n_features = len(data.select(VECTOR).first()[0])
        n_drawn = max(1, int(self.columns * n_features))
        open_nodes = [(k, 0) for k in range(self.trees)]
        for level in range(self.depth):
            if not open_nodes:
                break
            splits = self._level(table, trees, level, open_nodes, n_drawn, n_features)
            open_nodes = []
            for row in sorted(splits.collect(), key=lambda r: (r.tree, r.node)):  # at most a row per open node
                s = row.s
                left, right = (g / n / label.unit for g, n in ((s.gl, s.nl), (s.gr, s.nr)))
                children = trees[row.tree].split(row.node, s.feature, s.threshold, left, right)
                open_nodes += [(row.tree, child) for child, n in zip(children, (s.nl, s.nr), strict=True) if n > 1]
        for tree in trees:
            tree.value = [value / self.trees for value in tree.value]
        return TreeEnsemble(self.output, label.mean, self.depth, trees)

    def _level(self, table, trees, level, open_nodes, n_drawn, n_features) -> DataFrame:
        spark = table.sparkSession
        model = _model_row(spark, 0.0, max(level, 1), trees).select(F.struct("*").alias("_m"))
        alive = spark.createDataFrame(open_nodes, "tree int, node int")
        each = table.crossJoin(F.broadcast(model)).select("_x", "_g", "_m.depth", F.posexplode("_m.trees").alias("tree", "_t"))
        if self.rows < 1.0:
            each = each.filter(_share_column(F.lit(self.seed), F.col("tree"), F.xxhash64("_x", "_g")) < self.rows)
        at = each.select("tree", F.expr(_WALK.format(depth="depth", tree="_t")).alias("node"), "_x", "_g")
        at = at.join(F.broadcast(alive), ["tree", "node"])  # as many rows as open nodes, which the model's size bounds
        cells = at.select("tree", "node", "_g", F.posexplode("_x").alias("feature", "value"))
        place = ["tree", "node", "feature"]
        ranges = cells.groupBy(*place).agg(F.min("value").alias("low"), F.max("value").alias("high")).filter("low < high")
        if n_drawn < n_features:
            # Features without a range do not count among those drawn.
            draw = _share_column(F.lit(self.seed), F.lit("column"), *map(F.col, place))
            order = Window.partitionBy("tree", "node").orderBy(draw, "feature")  # a row per feature
            ranges = ranges.withColumn("_draw", F.row_number().over(order)).filter(F.col("_draw") <= n_drawn).drop("_draw")
        at_random = _share_column(F.lit(self.seed), F.lit("cut"), *map(F.col, place))
        cuts = ranges.select(*place, (F.col("low") + at_random * (F.col("high") - F.col("low"))).alias("threshold"))
        right = F.col("value") >= F.col("threshold")
        one, none = F.lit(1), F.lit(0)
        sums = cells.join(cuts, place).groupBy(*place).agg(
            F.min("threshold").alias("threshold"),
            F.sum(F.when(right, none).otherwise(F.col("_g"))).alias("gl"), F.sum(F.when(right, none).otherwise(one)).alias("nl"),
            F.sum(F.when(right, F.col("_g")).otherwise(none)).alias("gr"), F.sum(F.when(right, one).otherwise(none)).alias("nr"),
        ).filter((F.col("nl") >= self.min_leaf) & (F.col("nr") >= self.min_leaf))
        fit = sum((F.col(g).cast("double") * F.col(g) / F.col(n) for g, n in (("gl", "nl"), ("gr", "nr"))), F.lit(0.0))
        whole = (F.col("gl") + F.col("gr")).cast("double")
        gained = sums.withColumn("gain", fit - whole * whole / (F.col("nl") + F.col("nr"))).filter("gain > 0")
        chosen = F.max_by(F.struct("feature", "threshold", "gl", "nl", "gr", "nr"), F.struct("gain", -F.col("feature")))
        return gained.groupBy("tree", "node").agg(chosen.alias("s"))
