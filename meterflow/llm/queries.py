"""Queries of the numbered operators: name -> function of a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, divergence, langid, minhash, mixing, pieces, pii, quality, secrets, toxicity, urls, variants
from .common import read

Query = Callable[[SparkSession, str], DataFrame]
# How often the mix may repeat the smallest source.
SOURCE_REPEATS = 2.0
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = langid.with_addresses(read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages"))
    return langid.identify(docs, declared="_markup", suffix="_tld", host="_from")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), repeats=SOURCE_REPEATS)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, path: str = RANKS, offsets: bool = False) -> DataFrame:
    """Token count and digests of ids and of the decoded bytes, per document; with ``offsets`` also those of the pre-tokens."""
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["offsets"] if offsets else []),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"), offsets=True)


def piece_digests(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """Count of all ids and digests of ids and of the decoded text, per document."""
    coded = pieces.encode(docs, path, decoded=True)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def digests(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans."""

    def n_of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(n_of(kind) for kind in kinds),
        F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(kinds))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pii.find(read(spark, sf_dir, "documents")), list(pii.KINDS))


def secret_digests(docs: DataFrame) -> DataFrame:
    return digests(secrets.scan(docs), [rule.kind for rule in secrets.RULES if rule.base])


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(read(spark, sf_dir, "documents"))
    return judged.withColumn("host_rate", F.round(F.col("host_rate") + 1e-9, 6))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read(spark, sf_dir, "embeddings"))


def build() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op3_mixing": op3_mixing,
        "op4_toxicity": op4_toxicity,
        "op5_urls": op5_urls,
        "op6_minhash": op6_minhash,
        "op7_pii": op7_pii,
        "op2_byte_bpe": op2_byte_bpe,
        "op8_secrets": op8_secrets,
        "op9_quality": op9_quality,
        "op10_neighbours": op10_neighbours,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_variants": op12_variants,
        "op13_divergence": op13_divergence,
    }


def oracle() -> dict[str, str]:
    return {"op9_quality": quality.ORACLE, "op13_divergence": divergence.ORACLE}
