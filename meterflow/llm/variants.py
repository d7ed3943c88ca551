"""Spelling variants: words one edit apart, found on a trie kept as tables.

Words are the distinct runs of letters of all texts, some of them misspelled on
purpose (:func:`occurrences`). Two words are near if one inserted, deleted or
replaced letter makes them equal. A word's form is its near word of largest
count, if that is ``RATIO`` times its own; its root is where following forms ends.

The trie is an edge table (node, letter, child), a node being the hash of its
prefix, the end of a word being a letter of its own. States (word, position,
node, edits) start on the word's own path. Where it leaves a node that other
words share, a replaced or an inserted letter leads to a state of one edit; the
letter behind the edit is part of that join, so most wrong turns are never made.
Deletions are insertions seen from the other word, and of two replaced letters
the smaller one starts. Level by level the frontier is then joined with the edge
table by node and next letter; a state follows one edge or ends. Below a node
without branches it goes down at once to the next branch, so the number of
levels is that of branches on a path, not of letters. A state above a single
word ends there: the hash of the letters left must be the same, and comparing
both words confirms the neighbour, which makes up for letters passed unread and
for equal hashes.

A join by node may meet very many words at one node (the root, a common
prefix): both sides are then split by ``CROWD`` words.

A null text is empty; a null key counts as the empty string where the key
decides about misspelling. Repeated rows count each. Ties of counts go to the
smaller word in code-point order. Very long runs are words like others: their
states hold hashes, and time is linear in their letters. An empty table gives no
row. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage, stage_folder

from .common import salted_join

LETTERS = "a-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
MISSPELLED = 31
RATIO = 10
CROWD = 1 << 14
END = 0  # the letter behind a word's last
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 2**64))
AHEAD = 4  # letters read at once behind an edit
STEPS = "id long, depth int, node long, letter int, here long, ahead long, child long, tail int, far_tail int"


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``: every run of letters, A-Z lower-cased; where ``MISSPELLED`` divides the checksum of key and run, without one letter."""
    lowered = F.translate(docs[text], string.ascii_uppercase, string.ascii_lowercase)
    # Shorter runs give no word of LEAST_LETTERS.
    runs = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))
    named = docs.select(F.coalesce(docs[key].cast("string"), F.lit("")).alias("_key"), F.explode(runs).alias("run"))
    named = named.withColumn("_sum", F.crc32(F.concat_ws(":", "_key", "run").cast("binary")))
    at = F.pmod(F.col("_sum"), F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod(F.col("_sum"), F.lit(MISSPELLED)) == 0, shorter).otherwise(F.col("run"))
    return named.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words that occur ``LEAST_COUNT`` times or more."""
    counted = occurrences(docs, key, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def path_steps(words: DataFrame) -> DataFrame:
    """Every step of each word's path, the end included.

    ``id, depth, node, letter, child``: the step itself. ``here`` and ``ahead`` are hashes of the next
    ``AHEAD`` letters from ``letter`` on and behind it (up to the end; ``ahead`` is null behind the end),
    ``tail`` and ``far_tail`` are short hashes of all behind ``here`` and ``ahead``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                texts = part.column("word").to_pylist()
                lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
                letters = np.frombuffer("".join([t + "\0" for t in texts]).encode("utf-32-le"), np.uint32)
                owner = np.repeat(np.arange(len(texts)), lengths)
                first = np.cumsum(lengths) - lengths
                depth = np.arange(len(letters)) - first[owner]
                powers, backs = (np.full(int(lengths.max(initial=0)) + 1, base, np.uint64) for base in (BASE, BACK))
                for power in (powers, backs):
                    power[:1] = 1
                    np.multiply.accumulate(power, out=power)
                sums = np.cumsum(_mix(letters.astype(np.uint64) + np.uint64(1)) * powers[depth])
                before = np.concatenate([np.zeros(1, np.uint64), sums])[first][owner]
                down = _mix(sums - before + depth.astype(np.uint64) + np.uint64(1))
                last = np.repeat(first + lengths - 1, lengths)
                rest = _mix((sums[last] - sums) * backs[depth + 1])  # of all letters behind each
                rest = (rest >> np.uint64(32)).astype(np.uint32).view(np.int32)
                own = np.arange(len(letters))
                stop = [np.minimum(own + k, last) for k in (AHEAD - 1, AHEAD)]  # the last letter read
                here = _mix((sums[stop[0]] - sums + _mix(letters.astype(np.uint64) + np.uint64(1)) * powers[depth]) * backs[depth])
                ahead = np.append(here[1:], np.zeros(1, np.uint64))
                node = np.empty_like(down)
                node[1:] = down[:-1]
                node[first] = 0
                ends = letters == END
                ids = part.column("id").to_numpy()[owner]
                for low in range(0, len(letters), 1 << 18):
                    some = slice(low, low + (1 << 18))
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(ids[some]), "depth": pa.array(depth[some].astype(np.int32)),
                        "node": pa.array(node[some].view(np.int64)), "letter": pa.array(letters[some].astype(np.int32)),
                        "here": pa.array(here[some].view(np.int64)), "ahead": pa.array(ahead[some].view(np.int64), mask=ends[some]),
                        "child": pa.array(down[some].view(np.int64)),
                        "tail": pa.array(rest[stop[0]][some]), "far_tail": pa.array(rest[stop[1]][some]),
                    })

    return words.select("id", "word").mapInArrow(run, STEPS)


def chains_of(edges: DataFrame) -> DataFrame:
    """``one, n, bottom, bottom_depth``: the deepest node above each set of words that is below an edge.

    Nodes with the same smallest word lie on its path, so as many words below are the same words.
    """
    return edges.filter("n > 1").groupBy("one", "n").agg(F.max_by("child", "depth").alias("bottom"), (F.max("depth") + 1).alias("bottom_depth"))


def edge_table(steps: DataFrame) -> DataFrame:
    """``node, letter, depth, child, n, one``: the trie's edges, ``n`` words below, ``one`` the smallest id of them."""
    return steps.groupBy("node", "letter").agg(
        F.min("child").alias("child"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n"), F.min("id").alias("one")
    )


def with_bottom(rows: DataFrame, chains: DataFrame) -> DataFrame:
    """The rows with ``bottom`` and ``bottom_depth`` of their words; above a single word there is nothing to look up."""
    single = rows.filter("n = 1").select("*", F.lit(None).cast("long").alias("bottom"), F.lit(None).cast("int").alias("bottom_depth"))
    return rows.filter("n > 1").join(chains, ["one", "n"], "left").select(*rows.columns, "bottom", "bottom_depth").union(single)


def one_edit_states(steps: DataFrame, edges: DataFrame, chains: DataFrame, folder: str) -> DataFrame:
    """``id, at, node, n, one, same, gone``: the states of one edit, ``AHEAD`` letters behind it or at the next branch below.

    ``same`` letters lie before the edit, which takes ``gone`` letters of the word and one of the other's.
    """
    branches = edges.groupBy("node").agg(
        F.count(F.lit(1)).alias("_ways"), F.sum("n").alias("_crowd"), F.max("letter").alias("_last")
    ).filter("_ways > 1")
    branches = branches.select("node", "_last", F.ceil(F.col("_crowd") / CROWD).cast("int").alias("_parts"))
    branches = stage(branches, folder, "branches")
    # The root and other short prefixes are on very many paths.
    own = salted_join(steps.drop("child"), branches, ["node"], F.xxhash64("id")).filter("_parts IS NOT NULL")
    own = stage(own, folder, "own")
    turns = own.filter(F.col("letter") != END).groupBy(
        F.xxhash64("node", "ahead").alias("wanted"), F.col("letter").alias("turn"), "depth"
    ).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("one"), F.min("far_tail").alias("left"), F.min("_parts").alias("_parts")
    )
    turns = with_bottom(turns, chains)
    skip = F.coalesce(F.col("bottom_depth") - F.col("depth") - 1 - AHEAD, F.lit(0))
    turns = turns.select(
        "wanted", "turn", "n", "one", "left", "bottom", skip.alias("skip"),
        F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"),
    )
    # Of two replaced letters the smaller one asks, so the last letter of a node has nothing to ask.
    replaced = F.when(F.col("letter") < F.col("_last"), F.struct(
        F.xxhash64("node", "ahead").alias("wanted"), F.col("far_tail").alias("rest"), F.lit(1).alias("gone")
    ))
    inserted = F.struct(F.xxhash64("node", "here").alias("wanted"), F.col("tail").alias("rest"), F.lit(0).alias("gone"))
    replaced = F.when(F.col("letter") != END, replaced)  # behind the end there is nothing to replace
    asked = own.select(
        "id", "letter", "depth", F.pmod(F.xxhash64("id", F.lit(1)), F.col("_parts")).cast("int").alias("_part"),
        F.explode(F.array_compact(F.array(replaced, inserted))).alias("_edit"),
    ).select("id", "letter", F.col("depth").alias("same"), "_part", "_edit.*")
    met = asked.join(turns, ["wanted", "_part"])
    met = met.filter(F.when(F.col("gone") == 1, F.col("turn") > F.col("letter")).otherwise(F.col("turn") != F.col("letter")))
    met = met.filter("n > 1 OR left = rest")  # a single word is below: its letters must be the rest
    return met.select(
        "id", (F.col("same") + F.col("gone") + AHEAD + F.col("skip")).alias("at"), F.col("bottom").alias("node"), "n", "one", "same", "gone",
    )


def near_pairs(words: DataFrame, folder: str) -> DataFrame:
    """``a, b``: the ids of all pairs of words one edit apart, each pair once."""
    steps = path_steps(words)  # computed twice from the written words: cheaper than a table ten times their size
    edges = stage(edge_table(steps), folder, "edges")
    chains = stage(chains_of(edges), folder, "chains")
    states = stage(one_edit_states(steps, edges, chains, folder), folder, "states0")
    pair = ["id", "one", "same", "gone"]
    found = [states.filter("n = 1").select(*pair)]
    spelled = words.select("id", "word")
    going = states.filter("n > 1").join(spelled, "id").filter(F.length("word") >= F.col("at")).select(
        "id", "node", "same", "gone", F.expr("substring(word, at + 1)").alias("rest")
    )
    level = 0
    going = stage(going, folder, "going0")
    # States wait at the bottoms only.
    waited = edges.join(chains.select(F.col("bottom").alias("node")), "node", "left_semi")
    follow = with_bottom(waited, chains).select(
        "node", "letter", F.coalesce("bottom", "child").alias("bottom"), "n", "one",
        F.coalesce(F.col("bottom_depth") - F.col("depth") - 1, F.lit(0)).alias("skip"),
    )
    follow = stage(follow, folder, "follow")
    while not going.isEmpty():
        level += 1
        moved = going.withColumn("letter", F.ascii("rest")).join(follow, ["node", "letter"])  # of an empty rest: END
        moved = moved.filter((F.col("letter") == END) | (F.length("rest") > F.col("skip")))
        moved = moved.select("id", F.col("bottom").alias("node"), "n", "one", "same", "gone", F.expr("substring(rest, skip + 2)").alias("rest"))
        moved = stage(moved, folder, f"states{level}")
        found.append(moved.filter("n = 1").select(*pair))
        going = moved.filter("n > 1").select("id", "node", "same", "gone", "rest")
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.union(more)
    first = words.select("id", F.col("word").alias("_first"))
    second = words.select(F.col("id").alias("one"), F.col("word").alias("_second"))
    both = candidates.filter("id <> one").join(first, "id").join(second, "one")
    near = both.filter("left(_first, same) = left(_second, same)").filter(
        "substring(_first, same + gone + 1) = substring(_second, same + 2)"
    )
    return stage(near.select(F.least("id", "one").alias("a"), F.greatest("id", "one").alias("b")).distinct(), folder, "near")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """``id, root`` for the words ``id`` that have a ``form``: the end of the chain of forms.

    Counts grow by ``RATIO`` along a chain, so it ends; each round doubles the steps taken.
    """
    found, level = stage(forms.select("id", F.col("form").alias("root")), folder, "roots0"), 0
    while True:
        level += 1
        further = found.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        moved = salted_join(found, further, ["root"], F.xxhash64("id"))
        moved = stage(moved.select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), folder, f"roots{level}")
        found = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return found


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    folder = stage_folder(docs.sparkSession)
    words = stage(word_counts(docs, key, text).withColumn("id", F.monotonically_increasing_id()), folder, "words")
    pairs = near_pairs(words, folder)
    links = pairs.union(pairs.select("b", "a"))
    other = words.select(F.col("id").alias("b"), F.col("word").alias("_word"), F.col("n").alias("_n"))
    best = salted_join(links, other, ["b"], F.xxhash64("a")).groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_n")).alias("_minus"), "_word", "b")).alias("_best")
    )
    linked = words.join(best.withColumnRenamed("a", "id"), "id", "left").withColumn("form_n", -F.col("_best._minus"))
    fits = F.col("form_n") >= RATIO * F.col("n")
    linked = stage(
        linked.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("form_n")).alias("form_n"),
            F.when(fits, F.col("_best._word")).alias("form"), F.when(fits, F.col("_best.b")).alias("_form"),
        ),
        folder, "linked",
    )
    ends = roots(linked.filter("_form IS NOT NULL").select("id", F.col("_form").alias("form")), folder)
    named = salted_join(ends, words.select(F.col("id").alias("root"), F.col("word").alias("_root")), ["root"], F.xxhash64("id"))
    done = linked.join(named.select("id", "_root"), "id", "left")
    return done.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
