"""Mixing sources to target weights, by DataFrame functions only.

Source shares p become weights p**t / sum p**t. The exponent t in [0, 1] meets a
goal: the largest t (closest to the natural shares) whose weights have the given
share of the greatest possible entropy, or the smallest t (most level) at which
no source is repeated more often than a limit while no document is left out.
Bisection finds it; a job looks at several levels of halves at once and returns
a few sums, so any number of sources works.

Weights and a token budget give each source a quota. It is realised as whole
passes over the source (epochs) and a last partial one. Every pass is a block
permutation: documents fall into blocks by hash, the blocks of a pass are put
in a random order with running totals, and documents in a random order within
their block. Only sums per block meet in one task, so a source of any size is
spread over tasks.

Rows of a null source form one source. Null and empty texts have no tokens: they
go into every whole pass and into the last one where their block is reached
before the quota. Rows that share a key and a source share their decisions.
Sources without any token have weight 0 and one pass. An empty table gives an
empty mix. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterflow.session import stage, stage_folder

from .common import WORD, salted_join

BLOCK_DOCS = 512
LEVELS = 4
ROUNDS = 10  # of LEVELS halvings each
SEED = 20


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_table(tokens: DataFrame) -> DataFrame:
    """``_source, _docs, _tokens`` of each source."""
    return tokens.groupBy("_source").agg(F.count(F.lit(1)).alias("_docs"), F.sum("_n").alias("_tokens"))


def find_exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent in [0, 1]: the largest that reaches the entropy (0 if none does), or the smallest,
    which levels the sources most, that keeps to the repetition limit (1 always does)."""
    if (entropy is None) == (repeats is None):
        raise ValueError("give either an entropy or a repetition limit")
    logs = sources.filter("_tokens > 0").select(F.log("_tokens").alias("_log"))
    ends = logs.agg(F.max("_log").alias("top"), F.min("_log").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if not ends.n:
        return 1.0
    shifted = F.col("_log") - ends.top

    def meet(points: list[float]) -> list[bool]:
        if repeats is not None:  # the smallest source is repeated (p_max / p_min) ** (1 - t) times
            return [math.exp(x * (ends.top - ends.least)) <= repeats * (1 + 1e-12) for x in points]
        weights = [F.exp(F.lit(t) * shifted) for t in points]
        sums = logs.agg(*(F.sum(w) for w in weights), *(F.sum(w * shifted) for w in weights)).first()
        pairs = zip(points, sums[: len(points)], sums[len(points) :], strict=True)
        return [math.log(z) - t * m / z >= entropy * math.log(ends.n) - 1e-12 for t, z, m in pairs]

    # The largest x that meets the goal, where x is the exponent or, for repeats, what it lacks to 1.
    low, high = 0.0, 1.0
    if meet([1.0])[0]:
        low = 1.0
    else:
        for _ in range(ROUNDS):
            points = [low + (high - low) * k / 2**LEVELS for k in range(1, 2**LEVELS)]
            last = sum(meet(points))  # points that meet the goal come first
            low, high = [low, *points, high][last : last + 2]
    return 1 - low if repeats is not None else low


def quotas(sources: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """``_source, weight, quota, whole, rest``: tokens due, whole passes, tokens of the last pass.

    Without a budget every document goes in at least once: the source with the most tokens per weight
    gets one whole pass.
    """
    power = F.when(F.col("_tokens") > 0, F.pow(F.col("_tokens").cast("double"), F.lit(exponent))).otherwise(0.0)
    weighed = sources.withColumn("_power", power)
    sums = weighed.agg(F.sum("_power").alias("_z"), F.max(F.when(F.col("_power") > 0, F.col("_tokens") / F.col("_power"))).alias("_most"))
    weight = F.when(F.col("_z") > 0, F.col("_power") / F.col("_z")).otherwise(0.0)
    total = F.lit(float(budget)) if budget is not None else F.col("_most") * F.col("_z")
    joined = weighed.crossJoin(F.broadcast(sums)).withColumn("weight", weight)  # sums is one row
    due = F.round(F.coalesce(F.col("weight") * total, F.lit(0.0))).cast("long")
    whole = F.when(F.col("_tokens") > 0, F.floor(F.col("quota") / F.col("_tokens"))).otherwise(1).cast("long")
    return joined.withColumn("quota", due).select(
        "_source", "_docs", "_tokens", "weight", "quota", whole.alias("whole"),
        F.when(F.col("_tokens") > 0, F.col("quota") - whole * F.col("_tokens")).otherwise(0).alias("rest"),
    )


def _order(*columns: str) -> Column:
    return F.xxhash64(F.lit(SEED), *columns)


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    entropy: float | None = None, repeats: float | None = None, budget: int | None = None,
) -> DataFrame:
    """``key, source, epoch, block, position, n_tokens, weight``: one row per use of a document.

    ``position`` is the document's place within its source and epoch, from 0.
    """
    folder = stage_folder(docs.sparkSession)
    tokens = stage(
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
                    F.col(source).isNull().alias("_none"), token_count(F.col(text)).alias("_n"))
        .withColumn("_source", F.struct("_none", "_source")).drop("_none"),
        folder, "tokens",
    )
    sources = stage(source_table(tokens), folder, "sources")
    exponent = find_exponent(sources, entropy, repeats)
    due = quotas(sources, exponent, budget).withColumn("_blocks", F.ceil(F.col("_docs") / BLOCK_DOCS))
    spread = F.xxhash64("_key")
    placed = salted_join(tokens, due.select("_source", "_blocks"), ["_source"], spread).withColumn(
        "_block", F.pmod(_order("_key"), F.col("_blocks"))
    ).drop("_blocks")
    blocks = placed.groupBy("_source", "_block").agg(F.count(F.lit(1)).alias("_docs"), F.sum("_n").alias("_n"))
    passes = salted_join(blocks, due.drop("_docs"), ["_source"], _order("_block")).withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))
    )
    # One row per block of a source and pass, so thousands of documents make a few rows here.
    earlier = Window.partitionBy("_source", "_epoch").orderBy(_order("_epoch", "_block"), "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    passes = passes.select(
        "_source", "_epoch", "_block", "weight",
        F.when(F.col("_epoch") < F.col("whole"), F.lit(None).cast("long")).otherwise(F.col("rest")).alias("_limit"),
        F.coalesce(F.sum("_docs").over(earlier), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_used"),
    ).filter("_limit IS NULL OR _used < _limit")
    uses = placed.join(passes, ["_source", "_block"])
    within = Window.partitionBy("_source", "_epoch", "_block").orderBy(_order("_epoch", "_key"), "_key", "_n")
    before = F.col("_used") + F.coalesce(F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = uses.withColumns({"_place": F.row_number().over(within) - 1, "_before": before})
    return ranked.filter("_limit IS NULL OR _before < _limit").select(
        F.col("_key").alias(key),
        F.when(~F.col("_source._none"), F.col("_source._source")).alias(source),
        F.col("_epoch").alias("epoch"), F.col("_block").alias("block"),
        (F.col("_first") + F.col("_place")).alias("position"),
        F.col("_n").alias("n_tokens"), "weight",
    )


def apply_mix(docs: DataFrame, plan: DataFrame, key: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents' rows, each as often as the plan uses it; rows with a null key as often as their source's whole passes
    would: once."""
    times = plan.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(source).alias("_from")).agg(
        F.countDistinct("epoch").cast("int").alias("_times")
    )
    joined = docs.join(times, (docs[key] == F.col("_key")) & docs[source].eqNullSafe(F.col("_from")), "left")
    wanted = F.when(docs[key].isNull(), F.lit(1)).otherwise(F.coalesce("_times", F.lit(0)))
    return joined.withColumn("_use", F.explode(F.array_repeat(F.lit(1), wanted))).select(*(docs[c] for c in docs.columns))
