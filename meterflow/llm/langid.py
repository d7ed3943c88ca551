"""Language identification by fusing evidence in Bayes' way.

A text's likelihood under each language comes from byte-trigram models. To it
come the declared markup language, the address suffix and a prior of the host.
How far declarations and suffixes can be trusted is counted: the share of each
value among texts that read like a language. Host priors are smoothed in two
steps, hosts towards their domain and domains towards all documents. All counts
are grouped aggregations over every document.

Every declared value of a text that is not empty is a possible language. Its
trigram model is fitted on about ``ROWS_PER_LANGUAGE`` of its documents, chosen
by a hash of key and text, or on all if it has fewer. Models are held in memory, a
quarter of a megabyte per language on the driver and in each Python worker; the plan does
not grow with their number. A text is read in whole, at about 190 bytes of memory a letter.

Texts without letters, null and empty ones have no language and are rejected,
as are texts whose best language stays below ``LEAST_BELIEF``. A null
declaration, suffix or host is no evidence. Ties go to the language first in
the alphabet. Repeated rows count each and get equal results. Without any
declared language nothing can be learned: then no language is given and nothing
but texts without letters is rejected. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage, stage_folder

from .common import as_bytes, blocks, salted_join

ROWS_PER_LANGUAGE = 5_000
AT_ONCE = 16  # languages counted or scored in one array
LEAST_BELIEF = 0.5
GRAMS = 1 << 16
# Neighbouring trigrams share letters, so each counts as this much independent evidence.
TEMPER = 0.3
HOST_WEIGHT = 20.0
VALUE_WEIGHT = 10.0
LEARNED = "_learned"


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    letters = np.zeros(256, dtype=bool)
    letters[65:91] = letters[97:123] = letters[128:] = True
    table[~letters] = 32
    return table


LOWER = _lowered()


def gram_numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for the trigram that starts at each byte; whether it holds a letter."""
    low = LOWER[data]
    grams = np.zeros(len(data), dtype=np.int64)
    if len(data) >= 3:
        mixed = (low[:-2] * np.uint32(0x9E3779B1)) ^ (low[1:-1] * np.uint32(0x85EBCA77)) ^ (low[2:] * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> 15
        grams[:-2] = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    return grams, low != 32


def _block_grams(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and letter marks of all bytes, and where each text starts, plus the end."""
    texts = as_bytes(block.column("_text"))
    raw = b"   ".join([*texts, b""])
    starts = np.cumsum([0, *(len(t) + 3 for t in texts)])
    grams, letters = gram_numbers(np.frombuffer(raw, dtype=np.uint8))
    return grams, letters, starts


def fit(docs: DataFrame, key: str, text: str, declared: str) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of each bucket."""
    labelled = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text", f"`{declared}` AS _lang").filter(
        "_lang IS NOT NULL AND length(_text) > 0"
    )
    folder = stage_folder(docs.sparkSession)
    sizes = stage(labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("_size")), folder, "sizes")
    # The counts are written, so the planner sends them to every task unless there are very many.
    place = F.pmod(F.xxhash64("_key", "_text"), F.lit(1_000_000_000)).cast("double")
    known = salted_join(labelled, sizes, ["_lang"], F.xxhash64("_key", F.length("_text")))
    sample = known.filter(place * F.col("_size") < ROWS_PER_LANGUAGE * 1_000_000_000).select("_text", "_lang")

    def tables(held: dict[str, np.ndarray], rows: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(some) + 1)),
                    "gram": pa.array(np.append(some, -1), pa.int32()),
                    "n": pa.array(np.append(counts[some], rows[lang]), pa.int64()),
                }
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for block in blocks(batches, "_text"):
            grams, letters, starts = _block_grams(block)
            for k, lang in enumerate(block.column("_lang").to_pylist()):
                a, b = starts[k], starts[k + 1]
                own = grams[a:b][letters[a:b]]
                held[lang] = held.get(lang, 0) + np.bincount(own, minlength=GRAMS)
                rows[lang] = rows.get(lang, 0) + 1
                if len(held) > AT_ONCE:
                    yield from tables(held, rows)
                    held, rows = {}, {}
        yield from tables(held, rows)

    counted = sample.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stage(counted, folder, "grams")
    languages = sorted(row.lang for row in counts.filter("gram = -1").select("lang").collect())
    model = np.full((len(languages), GRAMS), 0.5, dtype=np.float32)
    places = {lang: i for i, lang in enumerate(languages)}
    for first in range(0, len(languages), AT_ONCE):
        part = counts.filter(F.col("gram") >= 0).filter(F.col("lang").isin(languages[first : first + AT_ONCE]))
        for batch in part.toArrow().to_batches():  # at most AT_ONCE languages x buckets
            rows = [places[lang] for lang in batch.column("lang").to_pylist()]
            model[rows, batch.column("gram").to_numpy()] += batch.column("n").to_numpy()
    for own in model:
        own[:] = np.log(own / own.sum(dtype=np.float64))
    return languages, model


def _log_likelihoods(docs: DataFrame, languages: list[str], model: np.ndarray, columns: dict[str, str | None]) -> DataFrame:
    """``_key, _declared, _suffix, _host, _letters, _logs``: tempered log-likelihoods per language."""
    shared = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    chosen = docs.selectExpr(
        *(f"`{name}` AS {alias}" if name else f"CAST(NULL AS string) AS {alias}" for alias, name in columns.items())
    )
    passed = [name for name in columns if name != "_text"]
    schema = ", ".join(f"{name} {chosen.schema[name].dataType.simpleString()}" for name in passed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for block in blocks(batches, "_text", 1 << 20):
            grams, letters, starts = _block_grams(block)
            before = np.concatenate([[0], np.cumsum(letters)])[starts]
            own, logs = grams[letters], np.empty((block.num_rows, table.shape[1]))
            for first in range(0, table.shape[1], AT_ONCE):
                some = slice(first, first + AT_ONCE)
                part = table[own, some]
                sums = np.zeros((len(part) + 1, part.shape[1]))
                np.cumsum(part, axis=0, dtype=np.float64, out=sums[1:])
                logs[:, some] = TEMPER * (sums[before[1:]] - sums[before[:-1]])
            values = pa.FixedSizeListArray.from_arrays(pa.array(logs.ravel()), max(1, logs.shape[1])) if logs.shape[1] else None
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(name) for name in passed),
                    pa.array(np.diff(before)),
                    pa.array([[]] * block.num_rows, pa.list_(pa.float64())) if values is None else values.cast(pa.list_(pa.float64())),
                ],
                names=[*passed, "_letters", "_logs"],
            )

    return chosen.mapInArrow(score, f"{schema}, _letters long, _logs array<double>")


def _best(logs: str, languages: list[str]) -> Column:
    """The likeliest language; ties go to the first."""
    names = F.array(*map(F.lit, languages))
    return F.element_at(names, F.array_position(logs, F.array_max(logs)).cast("int"))


def _added(logs: Column, more: str) -> Column:
    """The sum per language; no evidence adds nothing."""
    return F.when(F.col(more).isNull(), logs).otherwise(F.zip_with(logs, F.col(more), lambda a, b: a + b))


def _domain(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def _numbered(counts: DataFrame, languages: list[str]) -> DataFrame:
    """The counts with the language's number ``_at``."""
    names = F.array(*map(F.lit, languages))
    return counts.withColumn("_at", (F.array_position(names, F.col(LEARNED)) - 1).cast("int"))


def _shares(counts: DataFrame, by: str) -> DataFrame:
    """A row per value of ``by`` with its documents, in all and by number of the language."""
    single = counts.groupBy(by, "_at").agg(F.sum("_n").alias("_n"))
    pairs = F.collect_list(F.struct("_at", F.col("_n").cast("double").alias("_n")))  # at most one per language
    return single.groupBy(by).agg(F.map_from_entries(pairs).alias("_by"), F.sum("_n").cast("double").alias("_all"))


def _each(n_languages: int, of_language) -> Column:
    """An array of ``of_language(number)`` for every language; the plan stays as small for many of them."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_languages - 1)), of_language)


def _count(by: str, number: Column) -> Column:
    return F.coalesce(F.try_element_at(by, number), F.lit(0.0))


def _per_language(counts: DataFrame, n_languages: int) -> list[float]:
    """Documents of each language."""
    found = [0.0] * n_languages
    for row in counts.groupBy("_at").agg(F.sum("_n").alias("_n")).collect():  # a row per language
        found[row["_at"]] = float(row["_n"])
    return found


def language_shares(counts: DataFrame, languages: list[str]) -> DataFrame:
    """One row with the share of each language among all documents, one more of each counted."""
    own = _per_language(_numbered(counts, languages), len(languages))
    shares = [(n + 1.0) / (sum(own) + len(own)) for n in own]
    names = ", ".join(f"_p{i} double" for i in range(len(own)))
    return counts.sparkSession.createDataFrame([tuple(shares)], names)


def host_priors(counts: DataFrame, total: DataFrame, languages: list[str]) -> DataFrame:
    """``_host, _prior``: log-probabilities of each language, hosts smoothed by domains, domains by all (``total``, one row)."""
    n_languages, total = len(languages), F.array(*map(F.lit, total.first()))
    known = _numbered(counts, languages).filter("_host IS NOT NULL").withColumn("_domain", _domain(F.col("_host")))
    domains = _shares(known, "_domain").withColumnsRenamed({"_by": "_of_domain", "_all": "_all_domain"})
    hosts = _shares(known, "_host").withColumn("_domain", _domain(F.col("_host")))
    joined = salted_join(hosts, domains, ["_domain"], F.xxhash64("_host"))

    def prior(i: Column) -> Column:
        expected = (_count("_of_domain", i) + HOST_WEIGHT * F.get(total, i)) / (F.col("_all_domain") + HOST_WEIGHT)
        return F.log((_count("_by", i) + HOST_WEIGHT * expected) / (F.col("_all") + HOST_WEIGHT))

    return joined.select("_host", _each(n_languages, prior).alias("_prior"))


def value_likelihoods(counts: DataFrame, column: str, languages: list[str]) -> DataFrame:
    """``column, _like``: log-probability of a declared value given each language, up to a constant."""
    n_languages = len(languages)
    known = _numbered(counts, languages).filter(F.col(column).isNotNull())
    totals = F.array(*map(F.lit, _per_language(known, n_languages)))
    values = _shares(known, column)
    spare = F.lit(VALUE_WEIGHT) / max(known.agg(F.count_distinct(column)).first()[0], 1)

    def like(i: Column) -> Column:
        return F.log((_count("_by", i) + spare) / (F.get(totals, i) + VALUE_WEIGHT))

    return values.select(column, _each(n_languages, like).alias(f"{column}_like"))


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", declared: str | None = "lang",
    suffix: str | None = None, host: str | None = "source",
) -> DataFrame:
    """``key, text_lang, lang_id, belief, kept`` for every row."""
    languages, model = fit(docs, key, text, declared) if declared else ([], np.zeros((0, GRAMS)))
    columns = {"_key": key, "_text": text, "_declared": declared, "_suffix": suffix, "_host": host}
    scored = _log_likelihoods(docs, languages, model, columns)
    if not languages:
        none = F.lit(None).cast("string")
        return scored.select(
            F.col("_key").alias(key), none.alias("text_lang"), none.alias("lang_id"),
            F.lit(None).cast("double").alias("belief"), (F.col("_letters") > 0).alias("kept"),
        )
    scored = scored.withColumn(LEARNED, F.when(F.col("_letters") > 0, _best("_logs", languages)))
    scored = stage(scored, stage_folder(docs.sparkSession), "language")
    counts = (
        scored.filter(F.col(LEARNED).isNotNull())
        .groupBy("_host", "_declared", "_suffix", LEARNED)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = stage(counts, stage_folder(docs.sparkSession), "counts")
    spread = F.xxhash64("_key", "_letters")
    fused = salted_join(scored, host_priors(counts, language_shares(counts, languages), languages), ["_host"], spread)
    parts = ["_logs", "_prior"]
    for column in ("_declared", "_suffix"):
        if columns[column]:
            fused = salted_join(fused, value_likelihoods(counts, column, languages), [column], spread)
            parts.append(f"{column}_like")
    fused = fused.withColumn("_fused", reduce(_added, parts[1:], F.col("_logs")))
    belief = F.transform(  # a bound variable is computed once, not per language
        F.array(F.array_max("_fused")), lambda top: 1 / F.aggregate("_fused", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    )[0]
    named = F.col("_letters") > 0
    return fused.select(
        F.col("_key").alias(key),
        F.col(LEARNED).alias("text_lang"),
        F.when(named, _best("_fused", languages)).alias("lang_id"),
        F.when(named, belief).alias("belief"),
        (named & (belief >= LEAST_BELIEF)).alias("kept"),
    )


def with_addresses(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents with the evidence of the page they came from, where a page's address names them.

    Adds ``_markup, _tld, _from``: the page's declared language, the last label of its host, and its
    host; for a document without a page its own ``lang`` and ``source``. A document's first address
    in alphabetic order counts. Columns of these three names are replaced.
    """
    found = pages.select(
        F.regexp_extract("url", r"^[^?#]*/([0-9]{1,18})(?:[/.?#]|$)", 1).cast("bigint").alias("_id"),
        F.struct(
            F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1)).alias("host"),
            F.nullif(F.regexp_extract("html", r'<html[^>]*\slang="([A-Za-z-]+)"', 1), F.lit("")).alias("markup"),
        ).alias("page"),
    ).filter("_id IS NOT NULL")
    first = found.groupBy("_id").agg(F.min("page").alias("_page")).alias("first")
    named = docs.drop("_markup", "_tld", "_from").alias("docs")  # the evidence takes these names
    joined = named.join(first, F.col("docs.doc_id") == F.col("first._id"), "left")
    return joined.select(
        "docs.*",
        F.coalesce("first._page.markup", "docs.lang").alias("_markup"),
        F.substring_index(F.col("first._page.host"), ".", -1).alias("_tld"),
        F.coalesce("first._page.host", "docs.source").alias("_from"),
    )
