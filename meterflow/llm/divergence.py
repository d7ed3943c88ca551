"""How far the sources of a language differ in their words: run-length columns.

Each language keeps the terms that occur in at least ``LEAST_DOCUMENTS`` of its
documents. A group (language and source) gives every kept term a probability
in units of a thousand-millionth, smoothed by two, and two groups differ by the
sum of f = floor((p - q)**2 / (p + q)) over all kept terms.

The terms of a language are put in an order that brings equal counts together:
sorted by their counts in the ``SORTED_BY`` largest sources, the smallest of these
first, then by their total. In this order a group's counts are a column of few
runs. Columns are cut into blocks of ``BLOCK`` terms and kept as runs; two sources
are compared block by block on the intersections of their runs, f once per
intersection, times its length. Sources meet in chunks of ``CHUNK``, so a task
holds at most 2 * ``CHUNK`` columns of one block, whatever the number of sources
and terms; a pair costs its runs, not the terms.

All numbers are whole: probabilities come from decimals of 38 digits, f fits
into 64 bits.

A null text, language or source counts as the empty string. Groups without
terms, and languages that keep none, take part: the latter differ by 0. Repeated
rows are documents of their own. Ties rank by the UTF-8 of the item. Texts are
read whole and hold as many words as they like. An empty table gives no row.
Only the three named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterflow.session import stage, stage_folder

from .common import as_bytes, blocks

LEAST_DOCUMENTS = 10
UNIT = 1_000_000_000
TOP_TERMS = 10
SORTED_BY = 16
BLOCK = 1 << 16
CHUNK = 32
TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8: letters A-Z and all beyond ASCII


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents, summed over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text"):
            groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
            names = zip(block.column("lang").to_pylist(), block.column("source").to_pylist(), strict=True)
            for name, value in zip(names, as_bytes(block.column("_text")), strict=True):
                occurrences, documents = groups.setdefault(name, (Counter(), Counter()))
                own = Counter(TERM.findall(value.lower()))
                occurrences.update(own)
                documents.update(own.keys())
            for (language, origin), (occurrences, documents) in groups.items():
                terms = list(occurrences)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([language] * len(terms), pa.string()),
                    "source": pa.array([origin] * len(terms), pa.string()),
                    "term": pa.array(terms, pa.binary()).cast(pa.string()),
                    "n": pa.array(occurrences.values(), pa.int64()),
                    "n_docs": pa.array(map(documents.__getitem__, terms), pa.int64()),
                })

    filled = docs.select(*_groups(docs, lang, source), docs[text].alias("_text"))
    found = filled.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _groups(docs: DataFrame, lang: str, source: str) -> list[Column]:
    return [F.coalesce(docs[name].cast("string"), F.lit("")).alias(alias) for name, alias in ((lang, "lang"), (source, "source"))]


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exactly."""
    share = (F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    whole = (total + 2 * terms).cast("decimal(38,0)")
    return F.call_function("div", share, whole) + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, sources: DataFrame, folder: str) -> DataFrame:
    """``lang, term, total, place``: every kept term with its place in the order of its language.

    Places come from one range partitioning: a term's rank in its partition plus the number of
    its language's terms in earlier partitions.
    """
    large = sources.filter(F.col("number") < SORTED_BY)
    ranked = counts.join(large.select("lang", "source", "number"), ["lang", "source"], "left")
    by_source = [F.coalesce(F.sum(F.when(F.col("number") == k, F.col("n"))), F.lit(0)).alias(f"_s{k}") for k in range(SORTED_BY)]
    kept = ranked.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("n_docs").alias("_docs"), *by_source)
    kept = stage(kept.filter(F.col("_docs") >= LEAST_DOCUMENTS).drop("_docs"), folder, "kept")
    order = ["lang", *(f"_s{k}" for k in reversed(range(SORTED_BY))), "total", "term"]
    numbered = kept.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "lang", "term", "total", F.monotonically_increasing_id().alias("_at")
    )
    numbered = stage(numbered, folder, "ordered").withColumn("_part", F.shiftright("_at", 33))
    parts = numbered.groupBy("lang", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("lang").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = numbered.join(parts.drop("_n"), ["lang", "_part"])
    return stage(
        placed.select("lang", "term", "total", (F.col("_at") - F.col("_first") + F.col("_before")).alias("place")), folder, "placed"
    )


def _runs(places: np.ndarray, values: np.ndarray, rest: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of a column that holds ``rest`` outside ``places``."""
    order = np.argsort(places, kind="stable")
    places, values = places[order], values[order]
    gap = places[1:] != places[:-1] + 1
    first = np.concatenate([[True], gap | (values[1:] != values[:-1])]) if len(places) else np.zeros(0, bool)
    ends = np.concatenate([gap, [True]]) if len(places) else first
    after = places[ends] + 1  # the rest goes on behind each gap
    after = after[after < length]
    starts = np.concatenate([places[first], after, [] if len(places) and places[0] == 0 else [0]]).astype(np.int64)
    held = np.concatenate([values[first], np.full(len(starts) - int(first.sum()), rest)]).astype(np.int64)
    order = np.argsort(starts, kind="stable")
    starts, held = starts[order], held[order]
    new = np.concatenate([[True], held[1:] != held[:-1]])
    return starts[new], held[new]


def run_columns(counts: DataFrame, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, number, block, length, starts, values``: every group's column of probabilities as runs, block by block."""
    marked = counts.join(terms.select("lang", "term", "place"), ["lang", "term"]).join(
        groups.select("lang", "source", "number", "n_all", "n_terms"), ["lang", "source"]
    )
    filled = marked.groupBy("lang", "number", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.collect_list(F.struct(  # at most BLOCK entries
            F.pmod("place", F.lit(BLOCK)).cast("int").alias("place"), probability(F.col("n"), F.col("n_all"), F.col("n_terms")).alias("p"),
        )).alias("some")
    )
    every = groups.filter("n_terms > 0").select(
        "lang", "number", "n_terms", probability(F.lit(0), F.col("n_all"), F.col("n_terms")).alias("rest"),
        F.explode(F.sequence(F.lit(0), F.expr(f"(n_terms - 1) div {BLOCK}"))).alias("block"),
    )
    columns = every.join(filled, ["lang", "number", "block"], "left").select(
        "lang", "number", "block", "rest", F.least(F.lit(BLOCK), F.col("n_terms") - F.col("block") * BLOCK).alias("length"),
        F.col("some.place").alias("places"), F.col("some.p").alias("ps"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                places, ps = (batch.column(name)[row].values for name in ("places", "ps"))
                rest, length = (batch.column(name)[row].as_py() for name in ("rest", "length"))
                none = places is None
                found.append(_runs(
                    np.zeros(0, np.int64) if none else places.to_numpy().astype(np.int64),
                    np.zeros(0, np.int64) if none else ps.to_numpy(), rest, length,
                ))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("number"), batch.column("block"), batch.column("length"),
                 pa.array([starts for starts, _ in found], lists), pa.array([values for _, values in found], lists)],
                names=["lang", "number", "block", "length", "starts", "values"],
            )

    return columns.mapInArrow(run, "lang string, number long, block long, length long, starts array<long>, values array<long>")


def run_difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """The sum of f over a block: once per intersection of two runs, times its length."""
    cuts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], cuts, "right") - 1]
    q = b[1][np.searchsorted(b[0], cuts, "right") - 1]
    lengths = np.diff(cuts, append=length)
    return int((((p - q) * (p - q)) // (p + q) * lengths).sum())


def _pairs_of_chunks(table: pa.Table) -> pa.Table:
    """Sums of f over one block for all pairs of sources of two chunks."""
    length = table.column("length")[0].as_py()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    numbers = table.column("number").to_pylist()
    starts, values = table.column("starts").combine_chunks(), table.column("values").combine_chunks()
    columns = {
        number: (starts[row].values.to_numpy(), values[row].values.to_numpy()) for row, number in enumerate(numbers)
    }
    pairs = [
        (a, b) for a in numbers if a // CHUNK == i for b in numbers if b // CHUNK == j and a < b
    ]
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * len(pairs), pa.string()),
        "a": pa.array([a for a, _ in pairs], pa.int64()),
        "b": pa.array([b for _, b in pairs], pa.int64()),
        "value": pa.array([run_difference(columns[a], columns[b], length) for a, b in pairs], pa.int64()),
    })


def pair_differences(columns: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of all pairs of sources a < b of languages that keep terms."""
    chunk = F.expr(f"number div {CHUNK}")
    most = columns.groupBy("lang").agg(F.max(chunk).alias("_last"))
    dealt = columns.join(most, "lang").withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    dealt = dealt.select(
        "lang", "block", "number", "length", "starts", "values",
        F.least(chunk, F.col("_other")).alias("i"), F.greatest(chunk, F.col("_other")).alias("j"),
    )
    parts = dealt.groupBy("lang", "block", "i", "j").applyInArrow(_pairs_of_chunks, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the other sources of the language by how far they differ. Part ``term``: the
    ``TOP_TERMS`` terms that a group uses more than its language does, by f.
    """
    folder = stage_folder(docs.sparkSession)
    counts = stage(term_counts(docs, text, lang, source), folder, "counts")
    found = docs.select(*_groups(docs, lang, source)).distinct()
    sizes = found.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("_n")), ["lang", "source"], "left")
    by_size = Window.partitionBy("lang").orderBy(F.desc(F.coalesce("_n", F.lit(0))), "source")  # a row per source
    sources = stage(
        sizes.select("lang", "source", (F.row_number().over(by_size) - 1).cast("long").alias("number")), folder, "sources"
    )
    terms = kept_terms(counts, sources, folder)
    kept = stage(
        counts.join(terms.select("lang", "term", "total"), ["lang", "term"]).select("lang", "source", "term", "n", "total"), folder, "used"
    )
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    vocabularies = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("total").alias("n_lang"))
    groups = sources.join(sums, ["lang", "source"], "left").join(vocabularies, "lang", "left")
    groups = stage(groups.na.fill(0, ["n_all", "n_terms", "n_lang"]), folder, "groups")

    columns = stage(run_columns(kept, terms, groups), folder, "columns")
    one = stage(pair_differences(columns), folder, "pairs")
    both = one.union(one.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "number", "source")
    measured = both.join(names.select("lang", F.col("number").alias("a"), "source"), ["lang", "a"]).join(
        names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    ).select("lang", "source", "item", "value")
    bare = groups.filter("n_terms = 0").select("lang", "source")  # without terms all sources are alike
    alike = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    pairs = measured.union(alike.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))

    own = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        probability(F.col("n"), F.col("n_all"), F.col("n_terms")).alias("p"),
        probability(F.col("total"), F.col("n_lang"), F.col("n_terms")).alias("q"),
    ).filter("p > q")
    used = own.select("lang", "source", "item", difference(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").union(ranked(used, "term").filter(F.col("rank") <= TOP_TERMS))


ORACLE = f"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        unnest(list_concat([''], regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term
    FROM documents
), g AS (
    SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n FROM d WHERE term <> '' GROUP BY ALL
), v AS (
    SELECT lang, term, count(*) AS total FROM d WHERE term <> '' GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}
), vs AS (
    SELECT lang, count(*) AS n_terms, sum(total) AS n_lang FROM v GROUP BY lang
), ns AS (
    SELECT c.lang, c.source, sum(n) AS n_all FROM c JOIN v USING (lang, term) GROUP BY ALL
), p AS (
    SELECT g.lang, g.source, v.term, v.total, coalesce(c.n, 0) AS n, n_lang, n_terms,
        (1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(n_all, 0) + 2 * n_terms))::BIGINT AS p
    FROM g JOIN v USING (lang) JOIN vs USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN ns USING (lang, source)
), pair AS (
    SELECT a.lang, a.source, b.source AS item,
        coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
            WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), own AS (
    SELECT lang, source, term AS item, p, (1 + ({UNIT}::HUGEINT * (total + 2)) // (n_lang + 2 * n_terms))::BIGINT AS q FROM p WHERE n > 0
), term AS (
    SELECT lang, source, item, ((p - q) * (p - q)) // (p + q) AS value FROM own WHERE p > q
), every AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pair
    UNION ALL SELECT lang, source, 'term', item, value FROM term
)
SELECT lang, source, part, item, value::BIGINT AS value,
    (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
