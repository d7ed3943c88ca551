"""Quality rules per document, and verdicts on whole hosts.

Word statistics of a text decide its own rules. A host's failures are summed
and its failure rate is shrunk towards all hosts by a beta prior whose two
parameters are fitted to the hosts' rates by the method of moments, less the
spread that chance alone gives to hosts of few documents. So a host of few
documents is judged by what is usual and a host of many by its own record. The
verdicts are joined back to the documents.

Texts are read once: their counts are written to the staging folder, and the
hosts and the verdicts are made of that table. A text is counted whole in one
task's memory, about 60 bytes a word.

Null and empty texts have no words and fail. Rows of a null host form one host
of their own. Repeated rows count each; a table without rows gives none.
Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage, stage_folder
from .common import as_bytes, blocks, salted_join

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\v\f\r"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# A host fails when its shrunk rate of failing documents reaches this.
HOST_RATE = 0.6
HASH_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, first ones included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=n)
    pairs = ids[:-1] * np.uint64(len(number)) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1].ravel().astype(np.uint64)
    windows = pairs[:-1] * np.uint64(len(number)) + ids[2:]
    _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[where.ravel()] > 1
    covered = np.zeros(n, dtype=bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # of bytes: at \x20 and \x09-\x0D only
    body = text.translate(None, WHITE)
    chars = len(body) if body.isascii() else len(body.decode())
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def document_stats(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """``key, host`` and the five counts."""
    fields = {"_key": docs.schema[key].dataType, "_host": docs.schema[host].dataType}
    schema = ", ".join(
        [*(f"{n} {t.simpleString()}" for n, t in fields.items()), *(f"{n} long" for n in STATS)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text"):
            stats = np.array([text_stats(t) for t in as_bytes(block.column("_text"))], dtype=np.int64)
            columns = [pa.array(stats[:, i]) for i in range(len(STATS))]
            yield pa.RecordBatch.from_arrays(
                [block.column("_key"), block.column("_host"), *columns], names=["_key", "_host", *STATS]
            )

    chosen = docs.selectExpr(f"`{key}` AS _key", f"`{host}` AS _host", f"`{text}` AS _text")
    return chosen.mapInArrow(run, schema)


def failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def host_rates(stats: DataFrame) -> DataFrame:
    """``_host, n_docs, n_failed, shrunk_rate``.

    A host of n documents drawn with correlation rho has a rate of variance
    m(1 - m)(1 + (n - 1) rho) / n around the mean m, so n times its squares sum to
    m(1 - m)(H + (N - H) rho) for H hosts of N documents. The prior has
    alpha + beta = 1 / rho - 1 pseudo-documents, at least 1 and at most 1000. Its mean
    weighs a host by n / (1 + (n - 1) rho), so one host of very many documents is no
    more than one host's evidence where hosts differ.
    """
    hosts = stats.groupBy("_host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(failed().cast("long")).alias("n_failed")
    )
    moments = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("_mean"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("_squares"),
        F.sum("n_docs").alias("_n"),
        F.count(F.lit(1)).alias("_hosts"),
    )
    mean = F.col("_mean")
    spread = F.try_divide(F.col("_squares") - F.col("_n") * mean * mean, mean * (1 - mean))
    shared = F.try_divide(spread - F.col("_hosts"), F.col("_n") - F.col("_hosts"))
    weight = F.when(shared > 0, 1 / shared - 1).otherwise(1000.0)
    spread_of = moments.select(F.least(F.greatest(weight, F.lit(1.0)), F.lit(1000.0)).alias("_weight"))
    # of one row, as is the prior
    hosts = hosts.crossJoin(F.broadcast(spread_of))
    evidence = F.col("n_docs") / (1 + (F.col("n_docs") - 1) / (F.col("_weight") + 1))
    prior = hosts.agg((F.sum(evidence * F.col("n_failed") / F.col("n_docs")) / F.sum(evidence)).alias("_mean"))
    shrunk = (F.col("n_failed") + F.col("_mean") * F.col("_weight")) / (F.col("n_docs") + F.col("_weight"))
    return hosts.crossJoin(F.broadcast(prior)).select("_host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"))


def quality(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """``key``, the counts, ``base_failed``, the host's ``host_rate`` and ``kept``.

    ``kept`` is false for a document that fails itself or whose host fails.
    """
    stats = stage(document_stats(docs, key, host, text), stage_folder(docs.sparkSession), "quality_counts")
    hosts = host_rates(stats).select(
        F.coalesce(F.col("_host"), F.lit("")).alias("_name"),
        F.col("_host").isNull().alias("_none"),
        F.col("shrunk_rate").alias("host_rate"),
    )
    named = stats.withColumns({"_name": F.coalesce("_host", F.lit("")), "_none": F.col("_host").isNull()})
    joined = salted_join(named, hosts, ["_name", "_none"], F.xxhash64("_key", "n_words", "word_chars"))
    return joined.select(
        F.col("_key").alias(key),
        *STATS,
        failed().alias("base_failed"),
        "host_rate",
        (~failed() & (F.col("host_rate") < HOST_RATE)).alias("kept"),
    )


# The same rows from the whole table; the host's rate is rounded, as in the query.
ORACLE = f"""WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row, unnest(found) AS word, generate_subscripts(found, 1) AS place
  FROM (SELECT row, regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+') AS found FROM docs)),
three AS (
  SELECT row, place, word, lead(word) OVER own AS second, lead(word, 2) OVER own AS third
  FROM words WINDOW own AS (PARTITION BY row ORDER BY place)),
twice AS (
  SELECT row, place, third IS NOT NULL AND count(*) OVER (PARTITION BY row, word, second, third) > 1 AS again FROM three),
covered AS (
  SELECT row, bool_or(again) OVER (PARTITION BY row ORDER BY place ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM twice),
counted AS (SELECT row, count(*) AS n_words, count(*) FILTER (hit) AS n_repeat_words FROM covered GROUP BY row),
lines AS (
  SELECT row, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \\t\\n\\x0b\\f\\r]')) AS lines FROM docs),
stats AS (
  SELECT doc_id, source, coalesce(n_words, 0) AS n_words,
         length(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs JOIN lines USING (row) LEFT JOIN counted USING (row)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM stats),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed))::DOUBLE AS bad FROM judged GROUP BY source),
moments AS (
  SELECT sum(bad) / sum(n) AS mean, sum(bad * bad / n) AS squares, sum(n) AS n, count(*) AS hosts FROM hosts),
shares AS (
  SELECT ((squares - n * mean * mean) / nullif(mean * (1 - mean), 0) - hosts) / nullif(n - hosts, 0) AS shared FROM moments),
weights AS (
  SELECT CASE WHEN shared > 0 THEN least(greatest(1 / shared - 1, 1.0::DOUBLE), 1000.0::DOUBLE) ELSE 1000.0::DOUBLE END AS weight
  FROM shares),
evidence AS (SELECT *, n / (1 + (n - 1) / (weight + 1)) AS w FROM hosts, weights),
prior AS (SELECT sum(w * bad / n) / sum(w) AS mean FROM evidence),
rates AS (SELECT source, (bad + mean * weight) / (n + weight) AS rate FROM evidence, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(rate + 1e-9, 6) AS host_rate, NOT base_failed AND rate < {HOST_RATE} AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source"""
