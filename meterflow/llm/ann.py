"""Nearest neighbours by an inverted multi-index.

Each vector is cut into two halves, and each half is quantised by its own
centroids, so K centroids a half give K * K cells. A query adds its products
with the two halves' centroids; a heap walks the pairs of centroids from the
best sum downwards until the cells visited hold enough vectors, and the vectors
of those cells are ranked by their true inner products in double precision.

The centroids are fitted on a bounded sample (``TRAIN_ROWS``), K grows with the
root of the table up to ``MOST_CENTROIDS``, so the counts of the cells that
every task gets stay bounded. All vectors are indexed. How many vectors a query
must visit is calibrated: for a sample of ``PROBES`` vectors the true neighbours
are found against all rows, and the least number is taken whose cells hold
``RECALL`` of them. On vectors without structure that is a large share of the
table, on clustered ones a small one.

Equal vectors are one entry with its smallest keys; an entry needs no more keys
than neighbours are asked for (and one, for the query's own), as ties go to
smaller keys, so copies of one vector cost no more than one. Index blocks hold
at most about ``BLOCK`` entries. Queries travel to the blocks they visit with
the sum of their last cell, from which the block's task finds the visited cells
again; a block is copied once per ``QUERY_CHUNK`` queries that visit it, so the
rows shuffled grow with the visits and never by more than ``BLOCK`` /
``QUERY_CHUNK`` of them for copies (one copy of each visited block besides).

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; rows without a key neither. Rows that
repeat key and vector count once. With fewer candidates than asked for, all are
returned. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterflow.session import stage, stage_folder

TOP = 20
TRAIN_ROWS = 20_000
MOST_CENTROIDS = 256
ENTRIES_PER_CELL = 16
ROUNDS = 8
PROBES = 128
RECALL = 0.97
BLOCK = 8192
QUERY_CHUNK = 16_384
WALKS = 4096  # queries of a task that looks for the cells they visit
QUERY_ROWS = 256  # queries multiplied with a block at once
FLOOR_SLACK = 1e-5  # share of a cell's sum that single precision may lose
SEED = 10


def _usable(vector: str) -> Column:
    return F.expr(
        f"size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        f"AND exists({vector}, x -> x <> 0)"
    )


def entries_of(vectors: DataFrame, top: int) -> DataFrame:
    """``keys, vector``: distinct vectors with their smallest ``top + 1`` keys."""
    first = Window.partitionBy("vector").orderBy("key")
    ranked = vectors.distinct().withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= top + 1)
    return ranked.groupBy("vector").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def fit_centroids(points: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from randomly chosen points; an empty cluster keeps its centre."""
    rng = np.random.default_rng(SEED)
    centers = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centers))
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centers.T - 0.5 * (centers * centers).sum(axis=1), axis=1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by falling sum of their two products, until they hold ``enough`` entries."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    rows, columns, width = rows.tolist(), columns.tolist(), len(b)
    heap, reached = [(-(a[0] + b[0]), 0, 0)], [0] * len(a)  # reached: next column of each row not yet offered
    reached[0] = 1
    cells, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = rows[i] * width + columns[j]
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        if j + 1 < width and reached[i] == j + 1:
            reached[i] = j + 2
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            reached[i + 1] = 1
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
    return cells


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors give equal results wherever they stand."""
    return (vectors * query).sum(axis=1)


def _matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1)


def _best(scores: np.ndarray, keys: list[list[int]], at: np.ndarray, own: int, top: int) -> list[tuple[float, int]]:
    """The ``top`` (score, key) of the entries ``at``, by falling score, then key, without ``own``."""
    if len(scores) > top + 1:
        cut = np.partition(scores, len(scores) - top - 1)[len(scores) - top - 1]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    found = [(-s, key) for s, i in zip(scores[some].tolist(), at[some].tolist(), strict=True) for key in keys[i] if key != own]
    return heapq.nsmallest(top, found)


def _search_block(top: int, half: int, shared: Broadcast):
    """One block of entries against the queries that visit it: each query's best in the cells it visits.

    Rough products of many queries at once choose the entries whose exact products are taken.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query": [], "score": [], "key": []}
        if left.num_rows and right.num_rows:
            centers = shared.value[0]
            vectors = _matrix(left.column("vector"), np.float64)
            own, place = np.unique(left.column("cell").to_numpy(), return_inverse=True)
            first, second = own // len(centers[1]), own % len(centers[1])
            keys = left.column("keys").to_pylist()
            longest = np.sqrt((vectors * vectors).sum(axis=1).max())
            asked, floors = right.column("query").to_pylist(), right.column("floor").to_numpy()
            points = _matrix(right.column("vector"), np.float64)
            beyond = max(0, len(vectors) - top - 1)
            for low in range(0, len(asked), QUERY_ROWS):
                some = points[low : low + QUERY_ROWS]
                single = some.astype(np.float32)
                sums = (single[:, :half] @ centers[0].T)[:, first] + (single[:, half:] @ centers[1].T)[:, second]
                visited = sums >= floors[low : low + QUERY_ROWS, None]
                rough = np.where(visited[:, place], some @ vectors.T, -np.inf)
                cut = np.partition(rough, beyond, axis=1)[:, beyond]
                cut -= 1e-12 * len(vectors[0]) * longest * np.sqrt((some * some).sum(axis=1))
                for r, query in enumerate(asked[low : low + QUERY_ROWS]):
                    at = np.flatnonzero((rough[r] >= cut[r]) & (rough[r] > -np.inf))
                    for score, key in _best(exact_products(vectors[at], some[r]), keys, at, query, top):
                        out["query"].append(query)
                        out["score"].append(-score)
                        out["key"].append(key)
        return pa.table({
            "query": pa.array(out["query"], pa.int64()), "score": pa.array(out["score"], pa.float64()), "key": pa.array(out["key"], pa.int64()),
        })

    return run


class Index:
    """A fitted and written index; ``search`` takes ``query, vector`` rows."""

    def __init__(self, vectors: DataFrame, key: str, vector: str, top: int = TOP) -> None:
        spark = vectors.sparkSession
        self.top, self.folder = top, stage_folder(spark)
        plain = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector")).filter("key IS NOT NULL")
        plain = plain.filter(_usable("vector"))
        length = plain.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
        self.length = length.n if length else 0
        self.vectors = plain.filter(F.size("vector") == self.length)
        entries = stage(entries_of(self.vectors, top), self.folder, "entries")
        self.n = entries.count()
        if not self.n:
            return
        share = min(1.0, TRAIN_ROWS / self.n)
        sample = entries.filter(F.pmod(F.xxhash64("vector"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
        points = _matrix(sample.select("vector").limit(2 * TRAIN_ROWS).toArrow().column("vector"), np.float32)  # bounded sample
        k = int(min(MOST_CENTROIDS, max(1, np.ceil(np.sqrt(self.n / ENTRIES_PER_CELL)))))
        self.half = max(1, self.length // 2)
        self.centers = [fit_centroids(points[:, : self.half], k), fit_centroids(points[:, self.half :], k) if self.length > 1 else np.zeros((1, 0), np.float32)]
        self.width = len(self.centers[1])
        self._assign(entries)
        self.enough = self._calibrate()

    def _assign(self, entries: DataFrame) -> None:
        centers, half, width = self.centers, self.half, self.width
        kind = entries.schema["vector"].dataType.simpleString()

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = _matrix(batch.column("vector"), np.float32)
                cell = nearest(points[:, :half], centers[0]) * width + nearest(points[:, half:], centers[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys"), batch.column("vector"), pa.array(cell.astype(np.int32))], names=["keys", "vector", "cell"]
                )

        placed = stage(entries.select("keys", "vector").mapInArrow(cells, f"keys array<long>, vector {kind}, cell int"), self.folder, "placed")
        counts = np.zeros(len(centers[0]) * width, dtype=np.int64)
        for row in placed.groupBy("cell").count().toArrow().to_pylist():  # at most MOST_CENTROIDS squared
            counts[row["cell"]] = row["count"]
        self.counts = counts
        # Blocks are ranges of cells; a cell of more than a block's entries is dealt over several.
        before = np.cumsum(counts) - counts
        self.block_of = (before // BLOCK).astype(np.int32)
        self.parts_of = np.maximum(1, -(-counts // BLOCK)).astype(np.int32)
        self.placed = placed

    def _cell_table(self) -> DataFrame:
        spark = self.placed.sparkSession
        table = pa.table({"cell": np.arange(len(self.counts), dtype=np.int32), "block": self.block_of, "parts": self.parts_of})
        return spark.createDataFrame(table.filter(pa.array(self.counts > 0)))

    def _calibrate(self) -> int:
        """Entries to visit so that the cells hold RECALL of a sample's true neighbours."""
        top, centers, half = self.top, self.centers, self.half
        sample = self.placed.select("keys", "vector").orderBy(F.xxhash64("vector", F.lit(SEED)), F.col("keys")[0]).limit(PROBES).toArrow()
        probes, own = _matrix(sample.column("vector"), np.float64), [k[0] for k in sample.column("keys").to_pylist()]

        def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors, cells = _matrix(batch.column("vector"), np.float64), batch.column("cell").to_numpy()
                first = np.array([k[0] for k in batch.column("keys").to_pylist()])
                scores = vectors @ probes.T
                for p in range(len(probes)):
                    s = np.where(first == own[p], -np.inf, scores[:, p])
                    some = np.argsort(-s, kind="stable")[:top]
                    yield pa.RecordBatch.from_pydict({
                        "probe": pa.array(np.full(len(some), p, dtype=np.int32)), "score": pa.array(s[some]), "cell": pa.array(cells[some]),
                    })

        every = self.placed.mapInArrow(brute, "probe int, score double, cell int")
        best = Window.partitionBy("probe").orderBy(F.desc("score"), "cell")
        true = every.withColumn("_n", F.row_number().over(best)).filter((F.col("_n") <= top) & (F.col("score") > float("-inf"))).toArrow()
        needed = []
        probe, cell = true.column("probe").to_numpy(), true.column("cell").to_numpy()
        for p in range(len(probes)):
            sums = (centers[0] @ probes[p][:half])[:, None] + (centers[1] @ probes[p][half:])[None, :]
            order = np.argsort(-sums.ravel(), kind="stable")
            held = np.empty(len(order), dtype=np.int64)
            held[order] = np.cumsum(self.counts[order])
            needed += held[cell[probe == p]].tolist()
        return int(np.quantile(needed, RECALL, method="higher")) if needed else self.n

    def search(self, queries: DataFrame) -> DataFrame:
        """``query_id, rank, vec_id, score`` of the best entries found for each query."""
        centers, half, counts, enough = self.centers, self.half, self.counts, max(self.enough, 2 * self.top)
        block_of, parts_of = self.block_of, self.parts_of
        kind = queries.schema["vector"].dataType.simpleString()
        shared = queries.sparkSession.sparkContext.broadcast((centers, counts, block_of, parts_of))

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centers, counts, block_of, parts_of = shared.value
            for batch in batches:
                points = _matrix(batch.column("vector"), np.float32)
                rows, blocks, parts, floors = [], [], [], []
                for r in range(len(points)):
                    sums = centers[0] @ points[r, :half], centers[1] @ points[r, half:]
                    visited = np.array(walk(*sums, counts, enough))
                    i, j = divmod(int(visited[-1]), len(sums[1]))
                    floor = float(sums[0][i]) + float(sums[1][j]) - FLOOR_SLACK * float(np.abs(sums[0]).max() + np.abs(sums[1]).max())
                    reached = np.zeros(int(block_of.max()) + 1, dtype=np.int32)  # parts of each block
                    np.maximum.at(reached, block_of[visited], parts_of[visited])
                    met = np.flatnonzero(reached)
                    n_parts = reached[met]
                    blocks.append(np.repeat(met, n_parts))
                    parts.append(np.arange(n_parts.sum()) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts))
                    rows.append(np.full(n_parts.sum(), r))
                    floors.append(np.full(n_parts.sum(), floor))
                if rows:
                    taken = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("query").take(taken), batch.column("vector").take(taken),
                            pa.array(np.concatenate(blocks).astype(np.int32)), pa.array(np.concatenate(parts).astype(np.int32)),
                            pa.array(np.concatenate(floors)),
                        ],
                        names=["query", "vector", "block", "part", "floor"],
                    )

        tasks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-queries.count() // WALKS))
        asked = queries.select("query", "vector").repartition(tasks, "query").mapInArrow(visits, f"query long, vector {kind}, block int, part int, floor double")
        asked = stage(asked, self.folder, f"asked-{uuid.uuid4().hex}")
        visitors = asked.groupBy("block", "part").agg(F.ceil(F.count(F.lit(1)) / QUERY_CHUNK).cast("int").alias("copies"))
        table = F.broadcast(self._cell_table())  # at most MOST_CENTROIDS squared rows
        placed = self.placed.join(table, "cell").withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int"))
        copied = placed.join(visitors, ["block", "part"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        copied = copied.select("keys", "vector", "cell", "block", "part", "chunk")
        dealt = asked.join(visitors, ["block", "part"]).withColumn("chunk", F.pmod(F.xxhash64("query"), F.col("copies")).cast("int"))
        by = ["block", "part", "chunk"]
        found = copied.groupBy(*by).cogroup(dealt.drop("copies").groupBy(*by)).applyInArrow(
            _search_block(self.top, half, shared), "query long, score double, key long"
        )
        best = Window.partitionBy("query").orderBy(F.desc("score"), "key")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= self.top)
        return ranked.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


def neighbours(vectors: DataFrame, every: int = 20, key: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """The ``top`` nearest rows to each row whose key is divisible by ``every``."""
    index = Index(vectors, key, vector, top)
    if not index.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = index.vectors.filter(F.col("key") % every == 0).select(F.col("key").alias("query"), "vector").dropDuplicates(["query"])
    return index.search(stage(queries, index.folder, "queries"))
