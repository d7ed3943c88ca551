"""The training-data pipeline: language, near duplicates, secrets, mix, tokens.

Every stage reads the documents the stage before it wrote. The first four return
the columns of ``documents``; the last returns a row of digests per document.

Further columns of the input, whatever their names, are left out by the first
stage. Null and empty texts and texts without letters go there; a null language
or source is no evidence. Rows that share a key are judged by their own texts as
near duplicates, and each different text stays. Texts are used whole. An empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import langid, minhash, mixing, secrets
from meterflow.llm.common import importable, read
from meterflow.llm.queries import SOURCE_REPEATS, token_digests
from meterflow.session import stage, stage_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_PERCENT = 80  # the similarity of word shingles from which documents are near duplicates
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; ``lang`` becomes the one found.

    Rows of one key, and rows without any, stay or go together: they stay if one of them is kept.
    """
    importable(spark)
    docs = docs.select(*COLUMNS)
    found = langid.identify(docs).filter("kept").select(F.col("doc_id").alias("_id"), "lang_id")
    found = found.dropDuplicates(["_id"])
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]))
    return joined.select("doc_id", "text", F.coalesce("lang_id", "lang").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    importable(spark)
    return minhash.keep_one(docs, percent=NEAR_PERCENT).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    importable(spark)
    clean = secrets.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources up to the repetition limit; every document stays."""
    plan = mixing.mix(docs, repeats=SOURCE_REPEATS)
    return mixing.apply_mix(docs, plan).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes."""
    importable(spark)
    return token_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Byte-pair merges and MinHash have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = stage_folder(spark)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
