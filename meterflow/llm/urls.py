"""URL filter: address rules first, then a character language-model ratio. DataFrame functions only.

Addresses that a rule allows or blocks teach two Markov models over characters,
of variable order: contexts of up to three characters, each smoothed towards the
next shorter one. An n-gram seen ``LEAST_SEEN`` times is kept, whatever the table's
size, so the model grows with the labelled addresses. An address is judged by the log
ratio of the two likelihoods per character against a threshold calibrated on
labelled addresses the models have not seen.

The smoothed log ratio of a character splits into one term per context length,
so a table of terms by n-gram and a sum over an address's n-grams is all that
scoring needs.

A null address, or one without ``://``, has an empty host and path and is
allowed unless a rule says otherwise. Without labelled addresses of both kinds
the ratio is 0 and everything is allowed. Addresses are read whole. Repeated
rows are scored once and returned as often as they occur. Only the named
columns are read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterflow.session import stage, stage_folder

from .common import salted_join

ALLOW, BLOCK = "allow", "block"
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)
ORDER = 3
LEAST_SEEN = 2
SMOOTHING = 4.0
ALPHABET = 42
BEGIN, END = "\x02", "\x03"
PIECE = 64
CUT_STEP, MOST_CUT = 0.05, 10.0
HELD_OUT = 5  # one labelled address of so many calibrates


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(slash + own_path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _grams(table: DataFrame, *keep: str) -> DataFrame:
    """A row per n-gram of ``host`` and ``path``, with ``_length`` symbols in all; padding contexts too."""
    plain = F.regexp_replace(F.lower(F.concat("host", "path")), "[^a-z0-9./_-]", "~")
    pieces = F.regexp_extract_all(F.concat(plain, F.lit(END)), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    pieces = table.select(*keep, (F.length(plain) + 1).alias("_length"), pieces.alias("_all"))
    led = F.transform(
        "_all",
        lambda x, i: F.struct(
            F.when(i == 0, F.lit(BEGIN * ORDER)).otherwise(F.substring(F.get("_all", i - 1), -ORDER, ORDER)).alias("lead"),
            x.alias("own"), (i == 0).alias("first"),
        ),
    )
    pieces = pieces.select(*keep, "_length", F.explode(led).alias("p")).select(
        *keep, "_length", F.concat("p.lead", "p.own").alias("_text"), F.length("p.own").alias("_n"), "p.first"
    )
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.col("_n")),
            lambda at: F.array(*(F.col("_text").substr(at + ORDER - k, F.lit(k + 1)) for k in range(ORDER + 1))),
        )
    )
    padding = F.when(F.col("first"), F.array(*(F.lit(BEGIN * k) for k in range(1, ORDER + 1)))).otherwise(F.array().cast("array<string>"))
    return pieces.select(*keep, "_length", F.posexplode(F.concat(places, padding)).alias("_place", "gram"))


def fit(labelled: DataFrame) -> DataFrame:
    """``gram, term`` from ``host, path, accepted, copies``, for every n-gram kept and every context of one."""
    folder = stage_folder(labelled.sparkSession)
    counts = _grams(labelled, "accepted", "copies").groupBy("gram").agg(
        F.sum(F.when(F.col("accepted"), F.col("copies")).otherwise(0)).alias("a"),
        F.sum(F.when(~F.col("accepted"), F.col("copies")).otherwise(0)).alias("r"),
    ).filter(~F.col("gram").rlike(f"^{BEGIN}+$"))
    counts = stage(counts.withColumn("k", F.length("gram") - 1), folder, "counts")
    kept = stage(counts.filter(F.col("a") + F.col("r") >= LEAST_SEEN), folder, "kept")
    contexts = counts.groupBy("k", F.expr("left(gram, k)").alias("context")).agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"))
    contexts = stage(contexts.join(kept.select(F.expr("left(gram, k)").alias("context"), "k").distinct(), ["k", "context"]), folder, "contexts")
    back = F.log((F.col("cr") + SMOOTHING) / (F.col("ca") + SMOOTHING))
    tables, lower = [], None
    for k in range(ORDER + 1):
        own = kept.filter(F.col("k") == k).withColumn("context", F.expr("left(gram, k)")).join(
            contexts.filter(F.col("k") == k).drop("k"), "context"
        )
        if lower is None:
            own = own.select(
                "gram", ((F.col("a") + 1) / (F.col("ca") + ALPHABET)).alias("pa"), ((F.col("r") + 1) / (F.col("cr") + ALPHABET)).alias("pr"),
                F.lit(0.0).alias("_known"),
            )
        else:
            shorter = lower.select(F.col("gram").alias("_short"), F.col("pa").alias("_pa"), F.col("pr").alias("_pr"))
            own = own.join(shorter, F.expr("substring(gram, 2)") == F.col("_short"))
            own = own.select(
                "gram",
                ((F.col("a") + SMOOTHING * F.col("_pa")) / (F.col("ca") + SMOOTHING)).alias("pa"),
                ((F.col("r") + SMOOTHING * F.col("_pr")) / (F.col("cr") + SMOOTHING)).alias("pr"),
                (F.log(F.col("_pa") / F.col("_pr")) + back).alias("_known"),
            )
        lower = stage(own, folder, f"order{k}")
        tables.append(lower.select("gram", (F.log(F.col("pa") / F.col("pr")) - F.col("_known")).alias("term")))
    backing = contexts.filter("k > 0").select(F.col("context").alias("gram"), back.alias("term"))
    return stage(reduce(DataFrame.union, [*tables, backing]).groupBy("gram").agg(F.sum("term").alias("term")), folder, "terms")


def score(table: DataFrame, terms: DataFrame, *keep: str) -> DataFrame:
    """``keep, score``: the log ratio per symbol; ``keep`` must tell rows apart."""
    folder = stage_folder(table.sparkSession)
    # Only a number, which is fixed by writing it, goes through the join of the n-grams.
    numbered = stage(table.select(*dict.fromkeys((*keep, "host", "path"))).withColumn("_id", F.monotonically_increasing_id()), folder, "numbered")
    spread = F.xxhash64("_id", "_place")  # an n-gram may be in every address, and often in one
    matched = salted_join(_grams(numbered, "_id"), terms, ["gram"], spread).filter("term IS NOT NULL")
    sums = matched.groupBy("_id").agg((F.sum("term") / F.max("_length")).alias("score"))
    return numbered.join(sums, "_id", "left").select(*keep, F.coalesce("score", F.lit(0.0)).alias("score"))


def threshold(scored: DataFrame, kind: str = "accepted") -> DataFrame:
    """One row: of all multiples of ``CUT_STEP`` up to ``MOST_CUT`` the cut with the best balanced accuracy, the nearest to 0 if several are."""
    most = round(MOST_CUT / CUT_STEP)
    bins = F.least(F.greatest(F.floor(F.col("score") / CUT_STEP), F.lit(-most)), F.lit(most)).cast("long")
    counts = scored.groupBy(bins.alias("bin")).agg(
        F.sum(F.when(F.col(kind), F.col("copies")).otherwise(0)).alias("a"), F.sum(F.when(~F.col(kind), F.col("copies")).otherwise(0)).alias("r")
    )
    # Where the kinds part cleanly, the cuts in the gap between them have no rows of their own.
    empty = scored.sparkSession.range(-most, most + 1).select(F.col("id").alias("bin"), F.lit(0).alias("a"), F.lit(0).alias("r"))
    counts = counts.union(empty).groupBy("bin").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    every = Window.partitionBy(F.lit(1))  # 2 * most + 1 rows
    below = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    rate = (
        F.try_divide(F.coalesce(F.sum("r").over(below), F.lit(0)), F.sum("r").over(every))
        + F.try_divide(F.sum("a").over(every) - F.coalesce(F.sum("a").over(below), F.lit(0)), F.sum("a").over(every))
    )
    cuts = counts.select((F.col("bin") * CUT_STEP).alias("cut"), F.round(rate, 9).alias("rate")).filter("rate IS NOT NULL")
    best = cuts.agg(F.min_by("cut", F.struct(-F.col("rate"), F.abs("cut"), "cut")).alias("cut"))
    return best.select(F.coalesce("cut", F.lit(0.0)).alias("cut"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``key, host, path, rule, verdict, score`` of every row."""
    folder = stage_folder(pages.sparkSession)
    once = pages.groupBy(F.col(key).alias("_key"), F.col(url).alias("_url")).agg(F.count(F.lit(1)).alias("copies"))
    host, path = split_url(F.col("_url"))
    split = once.select("_key", "_url", "copies", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = stage(split.withColumns({"rule": rule, "_says": verdict}), folder, "ruled")
    labelled = ruled.filter("_says IS NOT NULL").select(
        "_key", "_url", "host", "path", "copies", (F.col("_says") == ALLOW).alias("accepted"),
        (F.pmod(F.crc32(F.concat("host", "path")), F.lit(HELD_OUT)) == 0).alias("held"),
    )
    kinds = labelled.filter("NOT held").agg(F.max("accepted").alias("some"), F.min("accepted").alias("all")).first()
    terms = fit(labelled.filter("NOT held"))
    if kinds.some is None or kinds.some == kinds.all:
        terms = terms.limit(0)
    kept = ["_key", "_url", "copies", "host", "path", "rule", "_says"]
    scored = stage(score(ruled, terms, *kept), folder, "scored")
    held = scored.filter("_says IS NOT NULL").withColumn("accepted", F.col("_says") == ALLOW).filter(
        F.pmod(F.crc32(F.concat("host", "path")), F.lit(HELD_OUT)) == 0
    )
    cut = threshold(held)
    method = F.when((F.col("host") == "") & (F.col("path") == ""), ALLOW).when(F.col("score") >= F.col("cut"), ALLOW).otherwise(BLOCK)
    judged = scored.crossJoin(F.broadcast(cut)).withColumn("verdict", F.coalesce("_says", method))  # cut is one row
    return judged.select(
        F.col("_key").alias(key), "host", "path", "rule", "verdict", "score",
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
