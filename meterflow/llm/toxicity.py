"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, and context windows.

Terms are words and word beginnings (stems) whose log-odds of standing in a
toxic text, counted on labelled documents, are high; a term must have been seen
in several different contexts, so copies of one passage teach nothing. A trie
holds the terms. An automaton whose states are sets of (trie node, edits so far)
reads a word letter by letter: it is the Levenshtein automaton of one edit
(change, insertion, omission, exchange of neighbours) intersected with the trie.
Its states are made when first needed and then looked up.

A sign or digit between letters may stand for a letter or be one too many, so
two words that one sign joins are also read as one. Every term of
``FUZZY_LETTERS`` letters may be misspelled, whatever its weight. A misspelling
counts less than the term, and nothing if labelled clean texts hold it. Around each hit the words of a window, and quotation marks that enclose
it, add what they tell by their own log-odds: that separates quoting from abuse.
The score is the logistic of the prior and the hits' evidence, or the rate of
toxic labels among texts without hits.

The lexicon is fitted on at most about ``TRAIN_DOCS`` labelled documents, chosen
by a hash of the key, and holds at most ``MOST_TERMS`` terms. Every document is
scored on its whole text. Labels, language, source and key are no inputs of a
score. Null and empty texts get the base score. Without labels nothing is known
and every text gets 0.05. A document labelled twice counts as toxic if one label
says so. Repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage, stage_folder

from .common import blocks

TRAIN_DOCS = 20_000
MOST_TERMS = 5_000
MOST_CANDIDATES = 100_000
STEMS = range(4, 8)
LEAST_CONTEXTS = 3
CONTEXTS_KEPT = 8
LEAST_SHARE = 0.01  # of the toxic texts must hold a term
LEAST_WEIGHT = 2.5
FUZZY_LETTERS = 5  # shorter terms must be spelled exactly
FUZZY_SHARE = 0.75  # of a term's weight that a misspelling keeps
WINDOW = 3
CONTEXT_SMOOTHING = 5.0
CONTEXT_LIMIT = 2.0
MOST_WEIGHT = 8.0
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+|[\"“”„«»‘’'`]")
# A run of letters, one sign or digit, and the run after it: the sign may stand for a letter or be one too many.
DISGUISED = re.compile(r"(?<![^\W\d_])([^\W\d_]++)(?=([^\w\s]|[\d_])([^\W\d_]++))")
QUOTE = '"'
QUOTES = frozenset("\"“”„«»‘’'`")


def words_of(text: str) -> list[str]:
    """Lower-case words, and every quotation mark as one sign."""
    return [QUOTE if w in QUOTES else w for w in WORDS.findall(text.lower())]


def disguised(text: str) -> Iterator[tuple[int, str]]:
    """Where a lower-case text has two words that one sign joins, and both with the sign."""
    for found in DISGUISED.finditer(text):
        yield found.start(), "".join(found.groups())


class FuzzyTrie:
    """Terms in a trie, read by an automaton that allows one edit. A term that ends in ``*`` is a stem:
    any ending may follow, and it is matched without edits."""

    def __init__(self, terms: dict[str, float]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        self.stems: dict[int, str] = {}
        for term in sorted(terms):
            node = 0
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                node = self.children[node][letter]
            (self.stems if term.endswith("*") else self.ends)[node] = term
        start = self._closed({(0, 0, "")})
        self.sets = [start]
        self.known = {start: 0}
        self.steps: list[dict[str, int]] = [{}]
        self.results: list[tuple[str, int] | None] = [self._result(start)]

    def _closed(self, places: set) -> frozenset:
        """With the omission of one letter of the term. A place is (node, edits, letter owed)."""
        more = {(child, 1, "") for node, edits, owed in places if not edits and not owed for child in self.children[node].values()}
        return frozenset(places | more)

    def _move(self, places: frozenset, letter: str) -> frozenset:
        out = set()
        for node, edits, owed in places:
            if node < 0:  # inside any ending of a stem
                out.add((node, edits, owed))
                continue
            children = self.children[node]
            if owed:  # the second of two exchanged letters
                if owed == letter:
                    out.add((node, edits, ""))
                continue
            if letter in children:
                out.add((children[letter], edits, ""))
            if not edits:
                out.add((node, 1, ""))  # a letter too many
                for first, child in children.items():
                    out.add((child, 1, ""))  # a changed letter
                    if first != letter and letter in self.children[child]:
                        out.add((self.children[child][letter], 1, first))
        for node, edits, owed in list(out):
            if node in self.stems and not edits and not owed:
                out.add((-node, 0, ""))
        return self._closed(out)

    def _result(self, places: frozenset) -> tuple[str, int] | None:
        """The best term that ends here, and its edits."""
        found = []
        for node, edits, owed in places:
            if owed:
                continue
            if node < 0 or (node in self.stems and not edits):
                found.append((self.stems[abs(node)], 0))
            if node in self.ends:
                term = self.ends[node]
                if not edits or len(term) >= FUZZY_LETTERS:
                    found.append((term, edits))
        return min(found, key=lambda f: (f[1], -self.terms[f[0]], f[0])) if found else None

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest term within one edit and the number of edits."""
        state, steps = 0, self.steps
        for letter in word:
            after = steps[state].get(letter)
            if after is None:
                after = self._make(state, letter)
            if after < 0:
                return None
            state = after
        return self.results[state]

    def _make(self, state: int, letter: str) -> int:
        places = self._move(self.sets[state], letter)
        number = -1
        if places:
            number = self.known.get(places, -2)
            if number == -2:
                number = self.known[places] = len(self.sets)
                self.sets.append(places)
                self.steps.append({})
                self.results.append(self._result(places))
        if len(self.steps[state]) < 4096:
            self.steps[state][letter] = number
        return number


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    innocent: set[str] = field(default_factory=set)  # misspellings that clean texts hold
    context: dict[str, float] = field(default_factory=dict)
    base: float = math.log(0.05 / 0.95)  # log-odds without any hit
    prior: float = 0.0  # log-odds of all labelled texts, to which hits add

    def trie(self) -> FuzzyTrie:
        if not hasattr(self, "_trie"):
            self._trie = FuzzyTrie(self.terms)
        return self._trie

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_trie"}

    def hits(self, text: str, words: list[str]) -> list[tuple[int, str, int, str]]:
        """Places, terms, edits and spellings of the words of ``text`` that match a term, and of words with a sign inside."""
        match = self.trie().match
        some = {w: m for w in set(words) if len(w) > 1 and (m := match(w)) and not (m[1] and w in self.innocent)}
        found = [(i, *some[w], w) for i, w in enumerate(words) if w in some] if some else []
        text, at, place = text.lower(), 0, 0
        for start, word in disguised(text):
            # A stem needs no edit, and has been found in the part before the sign.
            if (m := match(word)) and m[1] and word not in self.innocent:
                at, place = start, place + sum(1 for _ in WORDS.finditer(text, at, start))
                found.append((place, *m, word))
        return found

    def score(self, text: str) -> float:
        words = words_of(text)
        best: dict[str, float] = {}
        for at, term, edits, _ in self.hits(text, words):
            weight = min(self.terms[term], MOST_WEIGHT) * (FUZZY_SHARE if edits else 1.0)
            around = sum(self.context.get(w, 0.0) for w in window(words, at))
            weight += max(-CONTEXT_LIMIT, min(CONTEXT_LIMIT, around))
            best[term] = max(best.get(term, 0.0), weight)
        logit = self.prior + sum(best.values()) if best else self.base
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def window(words: list[str], at: int) -> set[str]:
    """Words around a place; ``QUOTE`` only if marks stand on both sides."""
    left, right = words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW]
    around = {w for w in left + right if w != QUOTE}
    return around | ({QUOTE} if QUOTE in left and QUOTE in right else set())


def is_training(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 != 1, F.lit(False))


def _counted(train: DataFrame, count, schema: str) -> DataFrame:
    """``count`` takes (texts, labels) of a block and yields columns of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            columns = count(block.column("text").to_pylist(), block.column("toxic").to_pylist())
            yield pa.RecordBatch.from_pydict(columns)

    return train.mapInArrow(run, schema)


def _candidates(train: DataFrame) -> list[str]:
    def count(texts: list[str], labels: list[int]) -> dict:
        seen: dict[str, set[int]] = {}
        for text in texts:
            words = words_of(text or "")
            for i, word in enumerate(words):
                if len(word) < 3:
                    continue
                context = hash((tuple(words[max(0, i - 2) : i]), tuple(words[i + 1 : i + 3]))) & 0x7FFFFFFF
                for term in (word, *(word[:n] + "*" for n in STEMS if n < len(word))):
                    own = seen.setdefault(term, set())
                    if len(own) < CONTEXTS_KEPT:
                        own.add(context)
        terms = list(seen)
        return {"term": pa.array(terms, pa.string()), "contexts": pa.array([list(seen[t]) for t in terms], pa.list_(pa.int64()))}

    found = _counted(train.filter("toxic = 1"), count, "term string, contexts array<long>")
    often = found.select("term", F.explode("contexts").alias("c")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    top = often.filter(F.col("n") >= LEAST_CONTEXTS).orderBy(F.desc("n"), "term").limit(MOST_CANDIDATES)
    return [row.term for row in top.select("term").collect()]


def _term_counts(train: DataFrame, terms: set[str]) -> DataFrame:
    shared = train.sparkSession.sparkContext.broadcast(terms)

    def count(texts: list[str], labels: list[int]) -> dict:
        known, tally = shared.value, (Counter(), Counter())
        for text, label in zip(texts, labels, strict=True):
            found = set(words_of(text or ""))
            found |= {w[:n] + "*" for w in found for n in STEMS if n < len(w)}
            tally[label].update(found & known)
        names = list(tally[0].keys() | tally[1].keys())
        return {"term": pa.array(names, pa.string()), **{f"n{y}": pa.array([tally[y][t] for t in names], pa.int64()) for y in (0, 1)}}

    return _counted(train, count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _hit_counts(train: DataFrame, model: Model) -> DataFrame:
    """Documents with each misspelling (``kind`` m) and with each word around a hit (``kind`` c)."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def count(texts: list[str], labels: list[int]) -> dict:
        known, tally = shared.value, (Counter(), Counter())
        for text, label in zip(texts, labels, strict=True):
            words = words_of(text or "")
            found = set()
            for at, _, edits, spelled in known.hits(text or "", words):
                found |= {("c", w) for w in window(words, at)} if not edits else {("m", spelled)}
            tally[label].update(found)
        names = list(tally[0].keys() | tally[1].keys())
        return {
            "kind": pa.array([k for k, _ in names], pa.string()), "word": pa.array([w for _, w in names], pa.string()),
            **{f"n{y}": pa.array([tally[y][t] for t in names], pa.int64()) for y in (0, 1)},
        }

    counted = _counted(train, count, "kind string, word string, n0 long, n1 long")
    return counted.groupBy("kind", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter("kind = 'm' OR n0 + n1 >= 5")


def _log_odds(n1: float, all1: float, n0: float, all0: float, smoothing: float = 0.5) -> float:
    return math.log((n1 + smoothing) / (all1 + 2 * smoothing)) - math.log((n0 + smoothing) / (all0 + 2 * smoothing))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model from labelled documents whose keys belong to the training part."""
    known = labels.filter(is_training(F.col(key)) & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(
        F.max(label).cast("int").alias("toxic")
    )
    share = min(1.0, TRAIN_DOCS / max(known.count(), 1))
    sample = known.filter(F.pmod(F.xxhash64("_key"), F.lit(1_000_000)) < int(share * 1_000_000))
    plain = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    train = plain.join(F.broadcast(sample), "_key").select("text", "toxic")  # about TRAIN_DOCS rows at most
    train = stage(train, stage_folder(docs.sparkSession), "train")
    sizes = {row.toxic: row["count"] for row in train.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    model = Model()
    if not clean or not toxic:
        return model
    counts = {row.term: (row.n0, row.n1) for row in _term_counts(train, set(_candidates(train))).collect()}
    # The lower end of the 90 % interval: a weight that few documents speak for is small.
    weights = {
        t: _log_odds(n1, toxic, n0, clean) - 1.645 * math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5)) for t, (n0, n1) in counts.items()
    }
    ranked = sorted((t for t, w in weights.items() if w >= LEAST_WEIGHT), key=lambda t: (-weights[t], t))
    # Most documents with the term are toxic, and it is no rare word.
    good = {t for t in ranked if counts[t][1] >= max(9 * counts[t][0], LEAST_CONTEXTS, LEAST_SHARE * toxic)}
    stems = {t[:-1] for t in good if t.endswith("*")}
    short = {s for s in stems if not any(s[:n] in stems for n in STEMS if n < len(s))}
    for term in ranked:
        word = term.rstrip("*")
        covered = any(word[:n] in short for n in STEMS if n <= len(word))
        # A stem needs endings: a stem that only one word has is that word.
        if term in good and len(model.terms) < MOST_TERMS:
            if term.endswith("*"):
                whole = max((counts[t][1] for t in good if not t.endswith("*") and t.startswith(word)), default=0)
                if word in short and counts[term][1] > 1.2 * whole:
                    model.terms[term] = weights[term]
            elif not covered or max(counts[word[:n] + "*"][1] for n in STEMS if word[:n] in short) <= 1.2 * counts[term][1]:
                model.terms[term] = weights[term]
    rows = _hit_counts(train, model).collect()
    model.innocent = {row.word for row in rows if row.kind == "m" and 4 * row.n0 >= row.n1}
    for row in rows:
        if row.kind == "c":
            # Beside a term most texts are toxic; a word that makes it likelier clean counts against.
            odds = math.log((row.n1 + CONTEXT_SMOOTHING) / (row.n0 + CONTEXT_SMOOTHING))
            model.context[row.word] = min(0.0, odds)
    model.prior = math.log(toxic / clean)
    model.base = _base_rate(train, model, clean, toxic)
    return model


def _base_rate(train: DataFrame, model: Model, clean: int, toxic: int) -> float:
    """Log-odds of a toxic label where no term is found."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def count(texts: list[str], labels: list[int]) -> dict:
        known, silent = shared.value, [0, 0]
        for text, label in zip(texts, labels, strict=True):
            silent[label] += not known.hits(text or "", words_of(text or ""))
        return {"n0": pa.array([silent[0]], pa.int64()), "n1": pa.array([silent[1]], pa.int64())}

    row = _counted(train, count, "n0 long, n1 long").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    return min(math.log((row.n1 + 0.5) / (row.n0 + 0.5)), math.log(0.2 / 0.8))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in blocks(batches, "_text"):
            scores = np.array([known.score(t or "") for t in block.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([block.column("_key"), pa.array(scores, pa.float64())], names=[key, "score"])

    chosen = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    return chosen.mapInArrow(run, f"`{key}` {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` of every row."""
    scored = score(docs, fit(docs, labels, key, text), key, text)
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
    return scored.select(key, held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
