"""Personal data: patterns, and terms that give protected entities away. DataFrame functions only.

Addresses, numbers and phones are found by pattern. Corpus co-occurrence then
tells which words reveal them: every word t of a document is counted with every entity
e of it, whatever its length and place. The share P(e | t) must reach
``LEAST_SHARE`` and be higher than P(e) beyond chance: a bound on the binomial
tail, times the pairs tested, must stay below ``CHANCE``, which frequent entities
and small tables can meet. A word seen with the entity in several different
contexts (the words around a mention; copies of one passage are one context)
then discloses the entity wherever it stands; it becomes a further span ``term`` and is removed
from sanitised texts, while pattern matches are generalised to their kind.

Patterns are anchored so that every run of characters is tried once, so texts
of any length take linear time. Null and empty texts have no spans. Rows without
a key are told apart by text, keep their pattern spans and get no term spans. Rows of one key share
their terms. Only the named columns are read; empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage, stage_folder

from .common import salted_join

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# A start inside a run succeeds only where the run's own start would, but for the end of a match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}  # without it a text has no match
WINDOW = 3  # words on each side of a mention that make its context
REACH = 96  # characters in which they are looked for
LEAST_CONTEXTS = 3
LEAST_SHARE = 0.8
CHANCE = 0.01
GROUP = 128  # matches whose places are added up together
NONE = "array<struct<kind:string,start:int,stop:int,value:string>>"


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        n = F.length(digits)
        total = F.aggregate(
            F.sequence(F.lit(1), n), F.lit(0),
            lambda s, i: s + F.element_at(
                F.array(*map(F.lit, [0, 2, 4, 6, 8, 1, 3, 5, 7, 9])), digits.substr(n - i + 1, F.lit(1)).cast("int") + 1
            ) * (i % 2 == 0).cast("int") + digits.substr(n - i + 1, F.lit(1)).cast("int") * (i % 2).cast("int"),
        )
        return total % 10 == 0
    return F.lit(True)


def spans_of(text: Column, pattern: Column, kind: str) -> Column:
    """Matches as ``struct<kind, start, stop, value>``: positions are running lengths of the parts between them.

    Parts are added up in groups, and the groups' totals after that, as appending to a long array copies it.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
    parts = F.filter(parts, lambda p: p.value.isNotNull())  # no match follows the last gap

    def span(start: Column, stop: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), value.alias("value"))

    def add_part(done: Column, part: Column) -> Column:
        start = done.at + part.gap
        stop = start + F.length(part.value)
        return F.struct(stop.alias("at"), F.concat(done.spans, F.array(span(start, stop, part.value))).alias("spans"))

    def add_group(done: Column, group: Column) -> Column:
        moved = F.transform(group.spans, lambda s: span(s.start + done.at, s.stop + done.at, s.value))
        return F.struct((done.at + group.at).alias("at"), F.concat(done.spans, F.array(moved)).alias("spans"))

    def placed(parts: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / GROUP).cast("int"))
        numbers = F.when(F.size(parts) > 0, numbers).otherwise(F.array().cast("array<int>"))
        groups = F.transform(numbers, lambda g: F.aggregate(F.slice(parts, g * GROUP + 1, GROUP), nothing(NONE), add_part))
        return F.aggregate(groups, nothing(f"array<{NONE}>"), add_group, lambda done: F.flatten(done.spans))

    def nothing(spans: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))

    return F.transform(F.array(parts), placed)[0]  # a bound variable is computed once, not per element


def base_spans(text: Column) -> Column:
    """All pattern matches that pass, by kind, then start."""
    lists = []
    for kind in KINDS:
        found = F.filter(spans_of(text, F.lit(PATTERNS[kind]), kind), _check(kind))
        needed = F.contains(text, F.lit(NEEDED[kind])) if kind in NEEDED else text.rlike("[0-9][ -]?[0-9]")
        lists.append(F.when(needed, found).otherwise(F.array().cast(NONE)))
    return F.when(text.isNull(), F.array().cast(NONE)).otherwise(F.concat(*lists))


def _check(kind: str):
    return lambda s: _passes(kind, s.value)


def _near(text: Column, span: Column) -> Column:
    """The lower-case words around a span; cut words at the reach's edges are left out."""
    first = F.greatest(span.start - REACH, F.lit(0))
    before = F.split(F.lower(text.substr(first + 1, span.start - first)), "[^\\p{L}]+")
    before = F.when(first > 0, F.slice(before, 2, F.size(before))).otherwise(before)
    after = F.split(F.lower(text.substr(span.stop + 1, F.lit(REACH))), "[^\\p{L}]+")
    after = F.when(span.stop + REACH < F.length(text), F.slice(after, 1, F.size(after) - 1)).otherwise(after)
    left, right = F.array_remove(before, ""), F.array_remove(after, "")
    return F.concat(F.slice(left, F.greatest(F.size(left) - WINDOW + 1, F.lit(1)), WINDOW), F.slice(right, 1, WINDOW))


def _words(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), "[^\\p{L}]+")), "")


def revealing_terms(found: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """``_key, terms``: the terms each document holds that disclose an entity.

    ``found`` has ``_id``, ``mentions`` (entity and the words near it) and ``words``, ``docs`` ``_key`` and ``_text``.
    """
    mentions = found.select("_id", F.explode("mentions").alias("m")).select("_id", "m.entity", F.xxhash64("m.near").alias("context"))
    mentions = stage(mentions.groupBy("_id", "entity").agg(F.min("context").alias("context")), folder, "entities")
    by_context = mentions.groupBy("entity", "context").agg(F.count(F.lit(1)).alias("_n"))
    entities = by_context.groupBy("entity").agg(F.sum("_n").alias("n_entity"), F.count(F.lit(1)).alias("_contexts"))
    entities = stage(entities.filter(F.col("_contexts") >= LEAST_CONTEXTS).drop("_contexts"), folder, "often")
    known = stage(salted_join(mentions, entities, ["entity"], F.xxhash64("_id")).filter("n_entity IS NOT NULL"), folder, "known")
    most = entities.agg(F.max("n_entity")).first()[0] or 0
    # A term needs LEAST_CONTEXTS documents and a share of LEAST_SHARE, so what is left out here discloses nothing.
    words = docs.select("_key", F.explode(_words(F.col("_text"))).alias("term"))
    spread = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    spread = stage(spread.filter((F.col("n_term") >= LEAST_CONTEXTS) & (LEAST_SHARE * F.col("n_term") <= most)), folder, "spread")
    held = found.join(known.select("_id").distinct(), "_id", "left_semi").select("_id", F.explode("words").alias("term")).distinct()
    held = salted_join(held, spread, ["term"], F.xxhash64("_id")).filter("n_term IS NOT NULL")
    both = held.join(known, "_id").filter(LEAST_SHARE * F.col("n_term") <= F.col("n_entity"))
    both = both.groupBy("term", "entity", "n_term", "n_entity", "context").agg(F.count(F.lit(1)).alias("_n"))
    pairs = both.groupBy("term", "entity", "n_term", "n_entity").agg(F.sum("_n").alias("n_both"), F.count(F.lit(1)).alias("n_contexts"))
    pairs = stage(pairs, folder, "pairs")
    n, tests = max(docs.count(), 1), max(pairs.count(), 1)
    share, usual = F.col("n_both") / F.col("n_term"), F.col("n_entity") / F.lit(n)
    # Chernoff's bound: so many documents of n_term hold the entity by chance with at most 2 ** -bits.
    rest = F.when(share < 1, (1 - share) * F.log2((1 - share) / (1 - usual))).otherwise(0.0)
    bits = F.when(share > usual, F.col("n_term") * (share * F.log2(share / usual) + rest)).otherwise(0.0)
    sure = (F.col("n_contexts") >= LEAST_CONTEXTS) & (share >= LEAST_SHARE) & (bits >= math.log2(tests / CHANCE))
    told = stage(pairs.filter(sure).select("term").distinct(), folder, "told")
    holders = words.filter("_key IS NOT NULL").join(told, "term")
    return holders.groupBy("_key").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text, spans array<struct<kind, start, stop, value>>``: patterns by kind and start, then terms."""
    folder = stage_folder(docs.sparkSession)
    plain = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    based = plain.select("_key", "_text", base_spans(F.col("_text")).alias("base"))
    mentions = F.transform("base", lambda s: F.struct(F.concat_ws(":", s.kind, s.value).alias("entity"), _near(F.col("_text"), s).alias("near")))
    own = F.coalesce(F.col("_key").cast("string"), F.concat(F.lit("text "), F.sha2("_text", 256)))
    beside = F.regexp_replace("_text", PATTERNS["email"], " ")  # an address is no term of itself
    found = based.filter(F.size("base") > 0).select(own.alias("_id"), mentions.alias("mentions"), _words(beside).alias("words"))
    found = stage(found, folder, "mentions")
    terms = stage(revealing_terms(found, plain, folder), folder, "terms")
    joined = based.join(terms, "_key", "left")  # the planner sends the written terms to every task if they are few
    quoted = F.transform("terms", lambda t: F.concat(F.lit("\\Q"), t, F.lit("\\E")))
    pattern = F.concat(F.lit("(?iu)(?<!\\p{L})(?:"), F.array_join(quoted, "|"), F.lit(")(?!\\p{L})"))
    further = F.when(F.col("terms").isNull(), F.array().cast(NONE)).otherwise(spans_of(F.col("_text"), pattern, TERM))
    return joined.select(F.col("_key").alias(key), F.col("_text").alias(text), F.concat("base", further).alias("spans"))


def sanitise(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with pattern spans generalised to ``<kind>`` and terms removed; a span inside another goes with it."""
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), s.kind.alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    built = F.aggregate(
        ordered, state,
        lambda done, s: F.when(s.start < done.at, F.struct(F.greatest(done.at, s.stop).alias("at"), done.out.alias("out"))).otherwise(
            F.struct(
                s.stop.alias("at"),
                F.concat(done.out, F.col(text).substr(done.at + 1, s.start - done.at),
                         F.when(s.kind == TERM, "").otherwise(F.concat(F.lit("<"), s.kind, F.lit(">")))).alias("out"),
            )
        ),
        lambda done: F.concat(done.out, F.col(text).substr(done.at + 1, F.length(F.col(text)))),
    )
    return found.withColumn(text, F.when(F.size("spans") > 0, built).otherwise(F.col(text)))
