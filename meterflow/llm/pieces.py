"""SentencePiece (merge type) encoding and decoding by exact backtracking.

A text gets a leading space where the model says so, spaces become U+2581, and
the text is cut where no piece of the vocabulary reaches across. Each distinct
slice is then encoded once per cache:

* Aho-Corasick over the reversed pieces gives, in one pass over the reversed
  slice, every piece that starts at each place, the longest first.
* The encoder takes the longest piece that fits the token before it, and goes
  back where none does. Two neighbours fit if merging their joined text again
  gives exactly these two. Places from which no way led to the end are
  marked in a bitfield, so none is tried twice and the work stays linear.

A sequence whose neighbours all fit is the one the merges give, provided no two
pieces share a score. Slices that hold pieces of equal score (runs of spaces in
common models) are therefore merged directly, best score first, leftmost among
equals, from a heap.

Characters without a piece become their UTF-8 bytes' pieces, or the unknown
piece in a model without them. Decoding joins the pieces, turns U+2581 into
spaces, drops the leading space that encoding added and control pieces, and
joins byte pieces to characters.

Null and empty texts have the begin and end ids only. Texts are encoded whole;
a slice of n characters takes time in proportion to n (n log n if merged).
Repeated rows and rows without a key each give a row; an empty table gives
none. Only the named columns are read, so further columns may have any name.

Models with user-defined or unused pieces, another normaliser than ``identity``,
or trained as another type are refused.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_bytes, blocks

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2  # the model type
SHORT = 24  # letters up to which merging looks at all pairs in every round
CACHED_LETTERS = 64  # longer slices are not kept
CACHED_SLICES = 400_000
CACHED_PAIRS = 1_000_000
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        if size is None:
            size = number()
        yield tag >> 3, data[at : at + size]
        at += size


class Vocabulary(dict):
    """The pieces of a model file, and a cache of encoded slices: slice -> packed ids."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normalizer: dict = {}
        with open(path, "rb") as file:
            for field, value in _fields(file.read()):
                if field == 1:
                    piece = dict(_fields(value))
                    score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
                    self.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
                elif field == 2:
                    trainer = dict(_fields(value))
                elif field == 3:
                    normalizer = dict(_fields(value))
        kinds = {kind for _, _, kind in self.pieces}
        if trainer.get(3) != MERGES or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: only merge-type models of plain pieces are read")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError(f"{path}: only models with the identity normaliser are read")
        self.lead = SPACE if normalizer.get(3, 1) else ""
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.unknown = next(i for i, piece in enumerate(self.pieces) if piece[2] == UNKNOWN)
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.bytes = {int(BYTE_PIECE.fullmatch(p)[1], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.scores = {p: score for p, score, kind in self.pieces if kind == NORMAL}
        by_score: dict[float, list[str]] = {}
        for piece, score in self.scores.items():
            if len(piece) > 1:
                by_score.setdefault(score, []).append(piece)
        tied = {piece for group in by_score.values() if len(group) > 1 for piece in group}
        # Pieces that hold a piece of equal score as a start: where none of these is longest, none of those occurs.
        self.tied_starts = {p for p in self.ids if any(p[:k] in tied for k in range(2, len(p) + 1))}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece[::-1], piece)
        self.automaton.make_automaton()
        # If no piece holds a space behind another character, merges never reach across such a place.
        cuts = not any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        self.slices = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if cuts else "(?s).+").findall
        self.fitting: dict[tuple[str, str], bool] = {}
        self.next_shorter: dict[str, str] = {}

    def merge(self, text: str) -> list[str]:
        """The tokens of ``text`` by definition: the best-scored pair is joined first, the leftmost of equals."""
        n, scores = len(text), self.scores
        if n <= SHORT:
            return self._merge_short(text)
        stop = list(range(1, n + 1))  # end of the token that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(i: int) -> None:
            j = stop[i]
            if j < n:
                score = scores.get(text[i : stop[j]])
                if score is not None:
                    heapq.heappush(heap, (-score, i, stop[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = stop[i]
            if not j or j >= n or stop[j] != end:
                continue
            stop[i], stop[j] = end, 0
            if end < n:
                before[end] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        tokens, i = [], 0
        while i < n:
            tokens.append(text[i : stop[i]])
            i = stop[i]
        return tokens

    def _merge_short(self, text: str) -> list[str]:
        """The same by looking at all pairs in every round."""
        tokens, known = list(text), self.scores.get
        ranks = [known(a + b) for a, b in zip(tokens, tokens[1:])]
        while True:
            best, place = None, 0
            for i, rank in enumerate(ranks):
                if rank is not None and (best is None or rank > best):
                    best, place = rank, i
            if best is None:
                return tokens
            tokens[place : place + 2] = [tokens[place] + tokens[place + 1]]
            del ranks[place]
            if place:
                ranks[place - 1] = known(tokens[place - 1] + tokens[place])
            if place < len(ranks):
                ranks[place] = known(tokens[place] + tokens[place + 1])

    def fits(self, first: str, second: str) -> bool:
        """Whether the two tokens stay as they are if their joined text is merged again."""
        if len(self.fitting) >= CACHED_PAIRS:
            self.fitting.clear()
        known = self.merge(first + second) == ([first, second] if first else [second])
        self.fitting[first, second] = known
        return known

    def shorter(self, token: str) -> str:
        """The longest piece that starts ``token`` and is shorter, or its first character; empty for one character."""
        known = self.next_shorter.get(token)
        if known is None:
            known = token[:-1]
            while len(known) > 1 and known not in self.ids:
                known = known[:-1]
            self.next_shorter[token] = known
        return known

    def longest(self, text: str) -> list[str]:
        """The longest token that can start at each place; a character without a piece is a token of its own."""
        found, last = list(text), -1
        for at, piece in self.automaton.iter(text[::-1]):  # at one place the longest comes first
            if at != last:
                found[-1 - at] = piece
                last = at
        return found

    def tokens(self, text: str) -> list[str]:
        """The tokens of a slice by backtracking."""
        longest = self.longest(text)
        if not self.tied_starts.isdisjoint(longest):
            return self.merge(text)
        n, known, fits, shorter = len(text), self.fitting, self.fits, self.shorter
        open_places = bytearray(b"\1") * (n + 1)
        tokens: list[str] = []
        at, last, token = 0, "", longest[0]
        while at < n:
            while token:
                if open_places[at + len(token)]:
                    fit = known.get((last, token))
                    if fit is None:
                        fit = fits(last, token)
                    if fit:
                        break
                token = shorter(token)
            if token:
                tokens.append(token)
                at += len(token)
                last = token
                if at < n:
                    token = longest[at]
            else:
                open_places[at] = 0
                at -= len(last)
                token = shorter(tokens.pop())
                last = tokens[-1] if tokens else ""
        return tokens

    def __missing__(self, text: str) -> bytes:
        tokens = self.tokens(text)
        try:
            ids = list(map(self.ids.__getitem__, tokens))
        except KeyError:
            ids = [i for token in tokens for i in self._spelled(token)]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= CACHED_LETTERS:
            if len(self) >= CACHED_SLICES:
                self.clear()
            self[text] = packed
        return packed

    def _spelled(self, token: str) -> list[int]:
        """The id of a token, or those of its bytes where it has none."""
        if token in self.ids:
            return [self.ids[token]]
        return [self.bytes[byte] for byte in token.encode()] if self.bytes else [self.unknown]

    def encode(self, text: str) -> bytes:
        """Begin, the text's ids and end as packed 32-bit little-endian integers."""
        first, last = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        if not text:
            return first + last
        slices = self.slices(self.lead + text.replace(" ", SPACE))
        return b"".join([first, *map(self.__getitem__, slices), last])

    @property
    def surfaces(self) -> list[bytes | None]:
        """What each id stands for; None for a byte's piece."""
        if not hasattr(self, "_surfaces"):
            self._surfaces: list[bytes | None] = []
            for piece, _, kind in self.pieces:
                if kind == BYTE:
                    self._surfaces.append(None)
                elif kind == CONTROL:
                    self._surfaces.append(b"")
                elif kind == UNKNOWN:
                    self._surfaces.append(self.unknown_text.encode())
                else:
                    self._surfaces.append(piece.replace(SPACE, " ").encode())
            self.values = {i: value for value, i in self.bytes.items()}
        return self._surfaces

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no character give U+FFFD each."""
        surfaces, parts, run = self.surfaces, [], bytearray()
        leading = bool(self.lead)

        def close() -> None:
            parts.append(_characters(bytes(run)))
            run.clear()

        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        at = 0
        # Only the first token that is not empty can hold the space that encoding added.
        while leading and at < len(numbers) and surfaces[numbers[at]] is not None:
            own = surfaces[numbers[at]]
            at += 1
            if own:
                plain = self.pieces[numbers[at - 1]][2] == NORMAL
                parts.append(own[1:] if plain and own.startswith(b" ") else own)
                break
        for number in numbers[at:]:
            own = surfaces[number]
            if own is None:
                run.append(self.values[number])
                continue
            if run:
                close()
            parts.append(own)
        if run:
            close()
        return b"".join(parts).decode()


def _characters(data: bytes) -> bytes:
    """UTF-8 as it is; every byte outside a whole character becomes U+FFFD."""
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at : at + width].decode().encode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key, ids binary``: token ids, begin and end included, as packed 32-bit little-endian integers.

    With ``decoded`` also ``decoded string``, the text the ids stand for.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for block in blocks(batches, "_text"):
            ids = [known.encode(value.decode()) for value in as_bytes(block.column("_text"))]
            arrays, names = [block.column("_key"), pa.array(ids, pa.binary())], [key, "ids"]
            if decoded:
                arrays.append(pa.array(map(known.decode, ids), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    return chosen.mapInArrow(run, f"`{key}` {kind}, ids binary{', decoded string' if decoded else ''}")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key, text string`` from ``ids``; null ids give null."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for block in blocks(batches, "ids"):
            texts = [None if ids is None else known.decode(ids) for ids in block.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")
