"""Secret scan by one deterministic automaton for all rules.

Rules are parsed into one nondeterministic automaton, made deterministic by
subset construction and minimised into transition arrays over byte classes. The
search automaton reads each byte once for all rules. A block of texts is cut
into lanes at byte pairs that bring every state back to the start, so no match
crosses a cut, and all lanes step together through the arrays. Lanes in which a
rule accepted are then resolved exactly: leftmost, longest, non-overlapping
matches of each rule, from automata of the single rules.

Null and empty texts have no spans. Texts are read whole, at any length. Tables
may be empty, rows may repeat, and further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_bytes, blocks

LANE = 512
SEPARATOR = 0xFF  # never a byte of UTF-8; no rule matches it


@dataclass(frozen=True)
class Rule:
    """``least`` characters are needed in the match, or in what follows ``head`` if the rule has one;
    shorter matches are dropped, not retried. Long counted repeats belong into ``least``: they
    multiply the states of the combined automaton."""

    kind: str
    pattern: str
    any_case: bool = False
    least: int = 0
    head: str = ""
    base: bool = False


KEYWORD = "(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
VALUE = "[A-Za-z0-9+/_.=-]+"
RULES = (
    Rule("assign", KEYWORD + VALUE, any_case=True, least=6, head=KEYWORD, base=True),
    Rule("access", "AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", "[0-9a-f]{24,}", base=True),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", "gh[opsu]_[A-Za-z0-9]+", least=40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]+", least=39),
)


# --- patterns to nondeterministic automata ---------------------------------------------------


class Nfa:
    """States with moves on byte sets and without input; built from a small pattern language:
    literals, ``[...]`` with ranges, groups, ``|``, ``? * + {n} {n,} {n,m}`` and ``\\`` escapes."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, pattern: str, any_case: bool) -> tuple[int, int]:
        self.text, self.at, self.any_case = pattern, 0, any_case
        built = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"{pattern!r}: unexpected {pattern[self.at]!r}")
        return built

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _choice(self) -> tuple[int, int]:
        start, end = self.state(), self.state()
        while True:
            a, b = self._sequence()
            self.free[start].append(a)
            self.free[b].append(end)
            if self._peek() != "|":
                return start, end
            self._next()

    def _sequence(self) -> tuple[int, int]:
        start = end = self.state()
        while self._peek() and self._peek() not in "|)":
            begin = self.at
            a, b = self._atom()
            stop = self.at
            low, high = self._count()
            after = self.at
            self.free[end].append(a) if (low, high) == (1, 1) else None
            if (low, high) == (1, 1):
                end = b
                continue
            for k in range(max(low, high or low + 1)):
                if k:
                    self.at = begin
                    a, b = self._atom()
                    assert self.at == stop
                if k >= low:  # this copy can be left out
                    skip = self.state()
                    self.free[end].append(skip)
                    self.free[b].append(skip)
                    if high is None:
                        self.free[b].append(a)
                    self.free[end].append(a)
                    end = skip
                else:
                    self.free[end].append(a)
                    end = b
            self.at = after
        return start, end

    def _count(self) -> tuple[int, int | None]:
        sign = self._peek()
        if sign and sign in "?*+":
            self._next()
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign == "{":
            close = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1 : close].partition(",")
            self.at = close + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def _atom(self) -> tuple[int, int]:
        sign = self._next()
        if sign == "(":
            built = self._choice()
            if self._next() != ")":
                raise ValueError("unclosed group")
            return built
        chars: set[int] = set()
        if sign == "[":
            while self._peek() != "]":
                low = self._next()
                low = self._next() if low == "\\" else low
                if self._peek() == "-" and self.text[self.at + 1] != "]":
                    self._next()
                    chars.update(range(ord(low), ord(self._next()) + 1))
                else:
                    chars.add(ord(low))
            self._next()
        else:
            chars.add(ord(self._next() if sign == "\\" else sign))
        if self.any_case:
            chars |= {ord(f(chr(c))) for c in chars if chr(c).isalpha() for f in (str.lower, str.upper)}
        start, end = self.state(), self.state()
        self.moves[start].append((frozenset(chars), end))
        return start, end

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for q in self.free[todo.pop()]:
                if q not in seen:
                    seen.add(q)
                    todo.append(q)
        return frozenset(seen)


# --- deterministic automata ------------------------------------------------------------------


@dataclass
class Dfa:
    """State 0 is the start. ``step[state, class_of[byte]]``; ``accepts[state]`` has a bit per rule."""

    step: np.ndarray
    class_of: np.ndarray
    accepts: np.ndarray
    dead: int  # the state that nothing leaves and that accepts nothing, or -1

    @cached_property
    def rows(self) -> list[list[int]]:
        return self.step[:, self.class_of].tolist()

    @cached_property
    def final(self) -> list[int]:
        return self.accepts.tolist()


def compile_rules(rules: tuple[Rule, ...], search: bool) -> Dfa:
    """Subset construction and minimisation; with ``search`` matches may start at any byte."""
    nfa = Nfa()
    ends = {}
    start = nfa.state()
    for bit, rule in enumerate(rules):
        a, b = nfa.add(rule.pattern, rule.any_case)
        nfa.free[start].append(a)
        ends[b] = 1 << bit
    sets = {chars for moves in nfa.moves for chars, _ in moves}
    signature = [tuple(byte in chars for chars in sets) for byte in range(256)]
    classes = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    class_of = np.array([classes[s] for s in signature], dtype=np.int64)
    example = [signature.index(s) for s in classes]

    first = nfa.closure({start})
    known, order, table = {first: 0}, [first], []
    for states in order:  # grows while it is read
        row = []
        for byte in example:
            moved = {q for p in states for chars, q in nfa.moves[p] if byte in chars}
            target = nfa.closure(moved | ({start} if search else set()))
            if target not in known:
                known[target] = len(order)
                order.append(target)
            row.append(known[target])
        table.append(row)
    step = np.array(table)
    accepts = np.array([sum({ends[q] for q in states if q in ends}) for states in order])

    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:  # refine blocks until all states of a block step to equal blocks
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    block = (block - block[0]) % (block.max() + 1)  # the start becomes 0
    size = block.max() + 1
    member = np.zeros(size, dtype=np.int64)
    member[block] = np.arange(len(block))
    step, accepts = block[step[member]], accepts[member]
    dead = [q for q in range(size) if not accepts[q] and (step[q] == q).all()]
    return Dfa(step, class_of, accepts, dead[0] if dead and not search else -1)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.all = compile_rules(rules, search=True)
        self.single = [compile_rules((rule,), search=False) for rule in rules]
        self.heads = [
            compile_rules((Rule(rule.kind, rule.head, rule.any_case),), search=False) if rule.head else None
            for rule in rules
        ]
        step = self.all.step
        twice = step[step]  # state, class, class
        self.resets = (twice == 0).all(axis=0)

    def flagged(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """Lanes ``(begin, end, rule bits)`` in which a rule accepted."""
        classes = self.all.class_of[data]
        cuts = np.flatnonzero(self.resets[classes[:-1], classes[1:]]) + 2
        wanted = np.arange(LANE, len(data), LANE)
        at = np.searchsorted(cuts, wanted)
        begins = np.unique(np.concatenate([[0], cuts[at[at < len(cuts)]]]))
        begins = begins[begins < len(data)]
        ends = np.append(begins[1:], len(data))
        longest = np.argsort(begins - ends, kind="stable")
        begins, ends = begins[longest], ends[longest]
        size = ends - begins
        width = self.all.step.shape[1]
        flat = self.all.step.ravel()
        state = np.zeros(len(begins), dtype=np.int64)
        seen = np.zeros(len(begins), dtype=np.int64)
        live = len(begins)
        for j in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -j, side="left"))  # lanes longer than j
            state[:live] = flat[state[:live] * width + classes[begins[:live] + j]]
            seen[:live] |= self.all.accepts[state[:live]]
        hit = np.flatnonzero(seen)
        return list(zip(begins[hit].tolist(), ends[hit].tolist(), seen[hit].tolist(), strict=True))

    @staticmethod
    def _longest(dfa: Dfa, data: bytes, at: int, end: int) -> int:
        state, last = 0, -1
        rows, final, dead = dfa.rows, dfa.final, dfa.dead
        while at < end:
            state = rows[state][data[at]]
            if state == dead:
                break
            at += 1
            if final[state]:
                last = at
        return last

    def resolve(self, data: bytes, begin: int, end: int, bits: int) -> list[tuple[int, int, int]]:
        """Exact spans ``(start, end, rule)`` in a lane."""
        found = []
        lane = np.frombuffer(data[begin:end], dtype=np.uint8)
        for k, rule in enumerate(self.rules):
            if not bits >> k & 1:
                continue
            dfa = self.single[k]
            free = begin
            for at in (np.flatnonzero(dfa.step[0, dfa.class_of[lane]] != dfa.dead) + begin).tolist():
                if at < free:
                    continue
                stop = self._longest(dfa, data, at, end)
                if stop < 0:
                    continue
                free = stop
                head = self.heads[k]  # ends as late as it can while something follows
                begun = self._longest(head, data, at, stop - 1) if head else at
                if stop - begun >= rule.least:
                    found.append((at, stop, k))
        return found

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text, spans ``(start, end, rule)`` in code points, by start, then rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        raw = b"\xff".join([*texts, b""])
        if len(raw) < 2:
            return out
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        for begin, end, bits in self.flagged(np.frombuffer(raw, dtype=np.uint8)):
            for start, stop, k in self.resolve(raw, begin, end, bits):
                doc = int(np.searchsorted(begins, start, side="right")) - 1
                out[doc].append((start - int(begins[doc]), stop - int(begins[doc]), k))
        for text, spans in zip(texts, out, strict=True):
            if spans:
                spans.sort(key=lambda s: (s[0], s[2], s[1]))
                if not text.isascii():
                    spans[:] = _code_points(text, spans)
        return out


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    heads = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
    before = np.concatenate([[0], heads])
    return [(int(before[a]), int(before[b]), k) for a, b, k in spans]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


# --- Spark -----------------------------------------------------------------------------------


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans array<struct<kind, start, stop>>``, in code points, by start, then rule."""
    kind = docs.schema[key].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan_texts = scanner(rules).spans
        for block in blocks(batches, "_text"):
            found = [
                [{"kind": rules[k].kind, "start": a, "stop": b} for a, b, k in spans]
                for spans in scan_texts(as_bytes(block.column("_text")))
            ]
            yield pa.RecordBatch.from_arrays(
                [block.column("_key"), pa.array(found, spans_type)], names=[key, "spans"]
            )

    chosen = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    return chosen.mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:int,stop:int>>")


def redacted(text: str, spans: list[tuple[int, int, int]], mark: Callable[[int], str]) -> str:
    """The text with every span replaced by its mark; overlapping spans become one."""
    out, done = [], 0
    for k, (start, stop, rule) in enumerate(spans):
        if start >= done:
            out += [text[done:start], mark(rule)]
        done = max(done, stop)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All columns and rows, with secrets in ``text`` replaced by ``<kind>``."""
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan_texts = scanner(rules).spans
        for block in blocks(batches, text):
            column = block.column(at)
            found = scan_texts(as_bytes(column))
            if any(found):
                values = [
                    redacted(value, spans, lambda k: f"<{rules[k].kind}>") if spans else value
                    for value, spans in zip(column.to_pylist(), found, strict=True)
                ]
                column = pa.array(values, column.type)
            yield block.set_column(at, names[at], column)

    return docs.mapInArrow(run, docs.schema)
