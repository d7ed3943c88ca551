"""Byte-level BPE by public rank files.

Boundaries between pre-tokens come from no regex. Every code point becomes a
symbol (letter, number, space before a word, ...) that already knows its
neighbours; a symbol acts on the states of a small automaton, and the actions
form a finite monoid. Composition is associative, so prefix products over a
block of texts are table look-ups on whole arrays: first within columns of
chunks, then over the chunks' totals. State and symbol tell where a token
starts. The slices feed a merge routine behind a bounded cache.

Null and empty texts have no tokens. A text of any length is read whole.
Repeated rows give repeated results; only the named columns are read, so extra
columns of any name do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_bytes, blocks

CACHE_PIECES = 400_000
MERGED_TOGETHER = 48
NEVER = np.iinfo(np.int64).max
CHUNK = 128
HASH_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

# Symbols of code points, and states of the automaton that reads them.
LETTER, NUMBER, OTHER, CLITIC2, CLITIC3, SPACE_END, WHITE_END, WHITE, BREAK = range(9)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACED, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)
N_STATES = 8
# The White_Space property.
WHITE_POINTS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SEPARATOR = 0xFF  # never a byte of UTF-8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token starts at this symbol."""
    if symbol == LETTER:
        if state == TWO_LEFT:
            return ONE_LEFT, False
        if state == ONE_LEFT:
            return FRESH, False
        return IN_LETTERS, state not in (IN_LETTERS, SPACED)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, SPACED)
    if symbol in (OTHER, CLITIC2, CLITIC3):
        if state in (IN_OTHER, SPACED):
            return IN_OTHER, False
        return {OTHER: IN_OTHER, CLITIC2: ONE_LEFT, CLITIC3: TWO_LEFT}[symbol], True
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    return {SPACE_END: SPACED, WHITE_END: FRESH, BREAK: FRESH}[symbol], True


class Scanner:
    """Prefix products of the symbols' transition functions."""

    def __init__(self) -> None:
        actions = [tuple(_step(q, x)[0] for q in range(N_STATES)) for x in range(9)]
        identity = tuple(range(N_STATES))
        number = {f: i for i, f in enumerate(dict.fromkeys([*actions, identity]))}
        known = list(number)
        for f in known:  # grows while it is read, until closed
            for g in actions:
                h = tuple(g[q] for q in f)
                if h not in number:
                    number[h] = len(known)
                    known.append(h)
        self.size = len(known)
        self.act = np.array(known, dtype=np.uint8)
        self.identity = number[identity]
        self.of_symbol = np.array([number[f] for f in actions], dtype=np.int32)
        self.times = np.array(
            [number[tuple(g[q] for q in f)] for f in known for g in known], dtype=np.int32
        )
        self.starts = np.array([[_step(q, x)[1] for x in range(9)] for q in range(N_STATES)])

    def _states(self, functions: np.ndarray) -> np.ndarray:
        """The state before each function, from FRESH."""
        n = len(functions)
        if n <= CHUNK:
            states, state = np.empty(n, dtype=np.uint8), FRESH
            for i, f in enumerate(functions.tolist()):
                states[i] = state
                state = self.act[f, state]
            return states
        rows = -(-n // CHUNK)
        padded = np.full(rows * CHUNK, self.identity, dtype=np.int32)
        padded[:n] = functions
        columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        product = np.empty_like(columns)
        product[0] = self.identity
        running = columns[0]
        for j in range(1, CHUNK):
            product[j] = running
            running = self.times[running * self.size + columns[j]]
        entering = self._states(running)
        return np.ascontiguousarray(self.act[product, entering[None, :]].T).ravel()[:n]

    def boundaries(self, symbols: np.ndarray) -> np.ndarray:
        return self.starts[self._states(self.of_symbol[symbols]), symbols]


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


@lru_cache(maxsize=1)
def point_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major in "LN":
            table[point] = LETTER if major == "L" else NUMBER
    table[WHITE_POINTS] = WHITE
    return table


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters that begin at ``at``."""
    lead = data[at].astype(np.int32)
    points = lead.copy()
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
        which = np.flatnonzero((lead >= low) & (lead < high))
        if len(which):
            value = lead[which] & mask
            for k in range(1, more + 1):
                value = (value << 6) | (data[at[which] + k] & 0x3F)
            points[which] = value
    return points


def token_starts(data: np.ndarray) -> np.ndarray:
    """Byte offsets where a pre-token or a separator starts, in texts that each end in a separator."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    at = at if len(at) < len(data) else np.arange(len(data))
    points = _points(data, at)
    cut = data[at] == SEPARATOR
    points[cut] = 0
    symbols = point_classes()[points]
    symbols[cut] = BREAK
    white = symbols == WHITE
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~cut[1:])
    symbols[last] = np.where(points[last] == 0x20, SPACE_END, WHITE_END)
    quotes = np.flatnonzero(points[:-2] == 0x27)
    if len(quotes):
        first, second = points[quotes + 1], points[quotes + 2]
        two = np.isin(first, [ord(c) for c in "stmd"])
        three = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
        three |= (first == ord("l")) & (second == ord("l"))
        symbols[quotes[two]] = CLITIC2
        symbols[quotes[three]] = CLITIC3
    tail = len(points) - 2  # a clitic of two characters right before the last separator
    if tail > 0 and points[tail - 1] == 0x27 and chr(points[tail]) in "stmd":
        symbols[tail - 1] = CLITIC2
    return at[scanner().boundaries(symbols)]


class Merger(dict):
    """Piece to the bytes of its ids (little-endian, 32 bits); ``learn`` adds pieces in bulk."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    piece, rank = line.split()
                    self.ranks[base64.b64decode(piece)] = int(rank)
        self.words = {rank: piece for piece, rank in self.ranks.items()}
        self.lengths = np.zeros(max(self.words, default=0) + 1, dtype=np.int64)
        self.lengths[list(self.words)] = list(map(len, self.words.values()))
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        pairs = {
            (self.ranks[piece[:i]] << 32) | self.ranks[piece[i:]]: rank
            for piece, rank in self.ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in self.ranks and piece[i:] in self.ranks
        }
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pairs.tolist()], dtype=np.int64)

    def learn(self, pieces: set[bytes]) -> None:
        """Give every piece its ids; the cache starts anew once it is full."""
        if len(self) > CACHE_PIECES:
            self.clear()
        new = pieces.difference(self)
        widths: dict[int, list[bytes]] = {}
        for piece in new:
            rank = self.ranks.get(piece)
            if rank is not None:
                self[piece] = rank.to_bytes(4, "little")
            elif len(piece) > MERGED_TOGETHER:
                self[piece] = self._merge_long(piece)
            else:
                widths.setdefault(-(-len(piece) // 4) * 4, []).append(piece)
        for width, group in widths.items():
            self._merge_together(group, width)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right  # a pad is -1, so its key is in no table
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], NEVER)

    def _merge_together(self, group: list[bytes], width: int) -> None:
        """Merge many short pieces at once: each round joins the best pair of every piece."""
        raw = np.frombuffer(b"".join([piece.ljust(width, b"\0") for piece in group]), dtype=np.uint8)
        lengths = np.fromiter(map(len, group), dtype=np.int64, count=len(group))
        ids = self.of_byte[raw.reshape(-1, width)]
        ids[np.arange(width)[None, :] >= lengths[:, None]] = -1
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(group))
        while len(rows):
            best = ranks.argmin(axis=1)
            here = np.arange(len(rows))
            rank = ranks[here, best]
            done = rank == NEVER
            for k, found in zip(rows[done].tolist(), ids[done].astype("<i4"), strict=True):
                self[group[k]] = found[: lengths[k]].tobytes()
            go = ~done
            rows, best, rank, ids, ranks = rows[go], best[go], rank[go], ids[go], ranks[go]
            if not len(rows):
                break
            lengths[rows] -= 1
            here = np.arange(len(rows))
            places = np.arange(width)[None, :]
            ids = np.take_along_axis(ids, np.minimum(places + (places > best[:, None]), width - 1), axis=1)
            ids[here, best] = rank
            ids[:, -1] = -1
            places = places[:, :-1]
            ranks = np.take_along_axis(ranks, np.minimum(places + (places >= best[:, None]), width - 2), axis=1)
            ranks[:, -1] = NEVER
            ranks[here, best] = np.where(
                best < width - 1, self._rank(rank, ids[here, np.minimum(best + 1, width - 1)]), NEVER
            )
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self._rank(ids[left, best[left] - 1], rank[left])

    def _merge_long(self, piece: bytes) -> bytes:
        """The same order of merges from a heap of (rank, place), for a long piece."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                rank = ranks.get(piece[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return np.array(ids, dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        words = self.words
        return b"".join([words[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def decode_span(self, ids: bytes, offsets: bytes, start: int, stop: int) -> tuple[int, bytes]:
        """The pre-tokens that hold a byte from ``start`` up to ``stop``, and the offset of the first of them."""
        begins = np.frombuffer(offsets, dtype="<u4")
        tokens = np.frombuffer(ids, dtype="<u4")
        byte_at = np.concatenate([[0], np.cumsum(self.lengths[tokens])])  # where each token starts
        start, stop = max(start, 0), min(stop, int(byte_at[-1]))
        if start >= stop:
            return start, b""
        first = int(begins[np.searchsorted(begins, start, "right") - 1])
        later = np.searchsorted(begins, stop, "left")
        last = int(begins[later]) if later < len(begins) else int(byte_at[-1])
        low, high = np.searchsorted(byte_at, [first, last])
        return first, self.decode(tokens[low:high].tobytes())


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of the slices modulo 2**64, as differences of one running sum."""
    powers = np.full(len(data) + 1, base, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * powers[len(data) - ends]  # all at one power


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A first place of every distinct slice, and each slice's number among them.

    Two independent 64-bit hashes must agree; long slices stay apart, each on its own.
    """
    hashes = _hashes(data, starts, ends, HASH_BASES[0])
    checks = _hashes(data, starts, ends, HASH_BASES[1])
    long = np.flatnonzero(ends - starts > MERGED_TOGETHER)
    hashes[long] = checks[long] = starts[long]
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    if (checks != checks[first][number]).any():
        both = np.stack([hashes, checks], axis=1)
        _, first, number = np.unique(both, axis=0, return_index=True, return_inverse=True)
    return first, number.ravel()


def _ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of slices of given offsets and lengths, one after another."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(offsets - total + lengths, lengths)


def encode_texts(texts: list[bytes], path: str) -> list[tuple[bytes, bytes]]:
    """For each text: ids, and the byte offsets at which its pre-tokens start, both packed."""
    raw = b"\xff".join([*texts, b""])
    if not raw:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    starts = token_starts(data)
    ends = np.append(starts[1:], len(raw))
    first, number = _distinct(data, starts, ends)
    pieces = list(map(raw.__getitem__, map(slice, starts[first].tolist(), ends[first].tolist())))
    known = merger(path)
    known.learn(set(pieces) - {b"\xff"})
    found = [b"" if piece == b"\xff" else known[piece] for piece in pieces]
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
    table = np.frombuffer(b"".join(found), dtype="<u4")
    ids = table[_ragged((np.cumsum(lengths) - lengths)[number], lengths[number])]
    begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
    piece_at = np.searchsorted(starts, begins)
    id_at = np.concatenate([[0], np.cumsum(lengths[number])])[piece_at].tolist()
    piece_at = piece_at.tolist()
    out = []
    for k in range(len(texts)):
        own = starts[piece_at[k] : piece_at[k + 1] - 1]  # the last start is the separator's
        out.append((ids[id_at[k] : id_at[k + 1]].tobytes(), (own - begins[k]).astype("<u4").tobytes()))
    return out


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key, ids binary, offsets binary``: token ids and pre-token byte offsets as packed 32-bit
    little-endian integers. With ``decoded`` also the bytes the ids stand for."""
    kind = docs.schema[key].dataType.simpleString()
    last = ["decoded"] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = merger(path)
        for block in blocks(batches, "_text"):
            rows = encode_texts(as_bytes(block.column("_text")), path)
            packed = [[row[0] for row in rows], [row[1] for row in rows]]
            if decoded:
                packed.append([pieces.decode(ids) for ids in packed[0]])
            yield pa.RecordBatch.from_arrays(
                [block.column("_key"), *(pa.array(values, pa.binary()) for values in packed)],
                names=[key, "ids", "offsets", *last],
            )

    chosen = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    return chosen.mapInArrow(run, ", ".join([f"`{key}` {kind}", *(f"{name} binary" for name in ["ids", "offsets", *last])]))


def decode_spans(
    encoded: DataFrame, path: str, start: str = "start", stop: str = "stop", key: str = "doc_id"
) -> DataFrame:
    """``key, start, stop, offset, text binary``: of each row's ``ids`` and ``offsets`` the whole pre-tokens
    that hold a byte from ``start`` up to ``stop``, from byte ``offset`` of the text on.

    A span beyond the text is cut to it, an empty one gives no bytes; any null gives a null ``text``.
    """
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = merger(path)
        for block in blocks(batches, "ids"):
            asked = zip(*(block.column(name).to_pylist() for name in ("ids", "offsets", "start", "stop")), strict=True)
            found = [(None, None) if None in row else pieces.decode_span(*row) for row in asked]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column("start"), block.column("stop"),
                 pa.array([at for at, _ in found], pa.int64()), pa.array([text for _, text in found], pa.binary())],
                names=[key, "start", "stop", "offset", "text"],
            )

    bounds = [encoded[name].cast("long").alias(alias) for name, alias in ((start, "start"), (stop, "stop"))]
    return encoded.select(key, "ids", "offsets", *bounds).mapInArrow(
        run, f"`{key}` {kind}, start long, stop long, offset long, text binary"
    )


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key, text binary`` from ``ids``; null ids give null."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = merger(path)
        for block in blocks(batches, "ids"):
            texts = [None if x is None else pieces.decode(x) for x in block.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(texts, pa.binary())], names=[key, "text"]
            )

    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text binary")
