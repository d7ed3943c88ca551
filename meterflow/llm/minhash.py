"""Near-duplicate groups by b-bit MinHash.

A text's set is hashed 120 times and the minima are kept. Groups of five whole
minima are band keys; the low four bits of all minima are packed into eight
integers as the signature. Texts that share a band are candidates; equal low
bits, corrected for chance agreement, estimate their similarity, and pairs that
can reach the threshold are confirmed on the full sets of their texts.

At similarity 0.85 a pair shares none of 24 bands of 5 with a chance of 8e-7;
the estimate's error is 0.035, so the margin of 0.2 loses a pair with 1e-8.

Texts of equal sets are one class, found by grouping; only its smallest
document goes on. In a band every member is compared with one centre, the
member that meets most others in all bands. Where members remain outside the
centre's component, they are compared with the band's members in blocks, each
pair in the first band it shares, and a block returns the links that join
components. So a group of copies costs a pair per member, a family that its
centre does not hold together costs its outsiders times its size in bit counts,
and no link that joins different texts is lost.

Null and empty texts, and texts without words, have the empty set and link with
nothing. Rows without a key are kept and link with nothing. Rows of one key are
told apart by a number of their own: each is judged by its own text and gets
one result, and of equal rows one is kept. Texts are read whole, a block of
about two megabytes or one longer text at a time. Only the named columns are
read; others may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.session import stage, stage_folder

from .common import as_bytes, blocks, salted_join
from .components import connected_components

SHINGLE = 5
BANDS, ROWS = 24, 5
MINIMA = BANDS * ROWS
LOW_BITS = 4
PER_LONG = 15
LONGS = MINIMA // PER_LONG
MARGIN = 0.2
CHUNK = 1024
_RNG = np.random.default_rng(606)
FACTORS = _RNG.integers(0, 2**32, size=(MINIMA, 2), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BACK = np.uint64(pow(int(WORD_BASE), -1, 2**64))
PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts, one after another, and each set's size."""
    raw = b"\n".join([*(t.lower() for t in texts), b""])  # of bytes: A-Z only
    data = np.frombuffer(raw, dtype=np.uint8)
    space = SPACES[data]
    word = ~space
    starts = np.flatnonzero(word & np.concatenate([[True], space[:-1]])) if len(data) else np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(space & np.concatenate([[False], word[:-1]])) if len(data) else starts
    powers = np.full(len(data) + 1, WORD_BASE, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    back = np.full(len(data) + 1, WORD_BACK, dtype=np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)  # undoes the power of a word's place in the block
    words = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, begins)
    n_words = np.diff(first)
    n_windows = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    windows = np.zeros(n_windows.sum(), dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(n_windows)])
    owner = np.repeat(np.arange(len(texts)), n_windows)
    place = np.arange(len(windows)) - at[owner] + first[owner]
    size = np.minimum(n_words, SHINGLE)[owner]
    padded = np.concatenate([words, np.zeros(SHINGLE, dtype=np.uint64)])
    for k in range(SHINGLE):
        windows += np.where(k < size, padded[place + k] * PLACE[k], np.uint64(0))
    windows = _mix(windows + size.astype(np.uint64))
    order = np.lexsort((windows, owner))
    windows, owner = windows[order], owner[order]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (windows[1:] != windows[:-1]) | (owner[1:] != owner[:-1])
    return windows[new], np.bincount(owner[new], minlength=len(texts))


def sketches(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set: two fingerprints, the band keys, the packed signature; rows of empty sets are 0."""
    n = len(sizes)
    some = np.flatnonzero(sizes)
    prints = np.zeros((n, 2), dtype=np.uint64)
    bands = np.zeros((n, BANDS), dtype=np.uint64)
    packed = np.zeros((n, LONGS), dtype=np.uint64)
    if not len(some):
        return prints.view(np.int64), bands.view(np.int64), packed.view(np.int64)
    starts = (np.cumsum(sizes) - sizes)[some]
    prints[some, 0] = np.add.reduceat(_mix(hashes ^ PLACE[0]), starts)
    prints[some, 1] = np.add.reduceat(_mix(hashes ^ PLACE[1]), starts)
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((MINIMA, len(some)), dtype=np.uint32)
    for k, (a, b) in enumerate(FACTORS):
        minima[k] = np.minimum.reduceat(low * a + high * b, starts)
    for band in range(BANDS):
        key = np.full(len(some), band + 1, dtype=np.uint64)
        for row in range(ROWS):
            key = _mix(key * PLACE[2] + minima[band * ROWS + row])
        bands[some, band] = key
    bits = (minima & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64)
    for k in range(MINIMA):
        packed[some, k // PER_LONG] |= bits[k] << np.uint64(LOW_BITS * (k % PER_LONG))
    return prints.view(np.int64), bands.view(np.int64), packed.view(np.int64)


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text", also: str | None = None) -> DataFrame:
    """``id, n_shingles, print1, print2, bands, signature`` of every row, and the column ``also`` as ``_key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_text"):
            hashes, sizes = shingle_sets(as_bytes(block.column("_text")))
            prints, bands, packed = sketches(hashes, sizes)
            long_list = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"), pa.array(sizes.astype(np.int64)),
                    pa.array(np.ascontiguousarray(prints[:, 0])), pa.array(np.ascontiguousarray(prints[:, 1])),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(long_list),
                    pa.FixedSizeListArray.from_arrays(pa.array(packed.ravel()), LONGS).cast(long_list),
                    block.column("_key"),
                ],
                names=["id", "n_shingles", "print1", "print2", "bands", "signature", "_key"],
            )

    chosen = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("_text"), F.col(also or key).cast("long").alias("_key"))
    found = chosen.mapInArrow(
        run, "id long, n_shingles long, print1 long, print2 long, bands array<long>, signature array<long>, _key long"
    )
    return found if also else found.drop("_key")


def estimate(a: Column, b: Column) -> Column:
    """Similarity by equal low bits, corrected for bits that agree by chance."""
    ones = F.lit(sum(1 << (LOW_BITS * k) for k in range(PER_LONG)))
    differing = F.lit(0)
    for k in range(LONGS):
        x = a[k].bitwiseXOR(b[k])
        spread = x
        for shift in range(1, LOW_BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(x, shift))
        differing = differing + F.bit_count(spread.bitwiseAND(ones))
    chance = 1 / (1 << LOW_BITS)
    return (1 - differing / MINIMA - chance) / (1 - chance)


def _jaccard_reached(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _links_in_block(percent: int):
    """Links that join components among one block of a band: its left rows against its right rows.

    Pairs of the same component, pairs that an earlier band has too, and pairs whose estimate is too
    low are passed over; the rest are compared on full sets, the likeliest first, until a link joins
    their components. So a block gives fewer links than it has components.
    """
    most = int(MINIMA * (1 - (1 / 16 + (percent / 100 - MARGIN) * 15 / 16)) + 1e-9)
    ones = np.uint64(sum(1 << (LOW_BITS * k) for k in range(PER_LONG)))

    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        signature = _matrix(table, "signature", LONGS).view(np.uint64)
        bands = _matrix(table, "bands", BANDS)
        here = table.column("band")[0].as_py()
        ids = table.column("id").to_numpy()
        left = table.column("left").to_numpy(zero_copy_only=False)
        names, component = np.unique(table.column("component").to_numpy(), return_inverse=True)
        component = component.ravel()
        right = np.flatnonzero(~left)
        a, b, off = [], [], []
        for i in np.flatnonzero(left):
            others = right[component[right] != component[i]]
            x = signature[others] ^ signature[i]
            x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & ones
            differing = np.bitwise_count(x).sum(axis=1)
            near = differing <= most
            near[near] = bands[i][(bands[others[near]] == bands[i]).argmax(axis=1)] == here
            a.append(np.full(near.sum(), i))
            b.append(others[near])
            off.append(differing[near])
        links: list[tuple[int, int]] = []
        if a and len(first := np.concatenate(a)):
            second = np.concatenate(b)
            order = np.argsort(np.concatenate(off), kind="stable")
            asked = np.unique(np.concatenate([first, second]))
            texts = as_bytes(table.column("_text").take(pa.array(asked)).combine_chunks())
            hashes, sizes = shingle_sets(texts)
            ends = dict(zip(asked.tolist(), np.cumsum(sizes).tolist(), strict=True))
            size = dict(zip(asked.tolist(), sizes.tolist(), strict=True))
            parent = list(range(len(names)))

            def root(k: int) -> int:
                while parent[k] != k:
                    parent[k] = k = parent[parent[k]]
                return k

            for i, j in zip(first[order].tolist(), second[order].tolist(), strict=True):
                x, y = root(component[i]), root(component[j])
                if x != y and _jaccard_reached(
                    hashes[ends[i] - size[i] : ends[i]], hashes[ends[j] - size[j] : ends[j]], percent
                ):
                    parent[x] = y
                    links.append((int(ids[i]), int(ids[j])))
        return pa.table({
            "a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64()),
        })

    return run


def _matrix(table: pa.Table, column: str, width: int) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy().reshape(table.num_rows, width)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold: 100 * common >= percent * union."""
    first = texts.select(F.col("id").alias("a"), F.col("_text").alias("_first"))
    second = texts.select(F.col("id").alias("b"), F.col("_text").alias("_second"))
    both = pairs.hint("merge").join(second, "b").hint("merge").join(first, "a")  # rows of one a come together

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for part in blocks(batches, "_second", 1 << 20):
            a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
            hashes, sizes = shingle_sets(as_bytes(part.column("_second")))
            ends = np.cumsum(sizes)
            good = np.zeros(len(a), dtype=bool)
            for k in range(len(a)):
                if a[k] != last:
                    last, held = a[k], shingle_sets([part.column("_first")[k].as_py().encode()])[0]
                good[k] = _jaccard_reached(hashes[ends[k] - sizes[k] : ends[k]], held, percent)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a[good]), "b": pa.array(b[good])})

    return both.mapInArrow(run, "a long, b long")


def _rest_of_bands(spots: DataFrame, components: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between components that still meet in a band.

    In every such band the members outside its centre's component (left) are compared with all
    members (right), in blocks of chunks. What the star has settled costs no pair any more.
    """
    known = spots.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    main = components.select(F.col("id").alias("center"), F.col("component").alias("_main"))
    known = known.join(main, "center", "left").withColumn("_out", F.col("component") != F.coalesce("_main", "center"))
    sizes = known.groupBy("band").agg(F.count(F.lit(1)).alias("_size"), F.sum(F.col("_out").cast("long")).alias("_n_out"))
    still = sizes.filter("_n_out > 0 AND _size > 2").select(
        "band", F.ceil(F.col("_n_out") / CHUNK).cast("int").alias("_lefts"), F.ceil(F.col("_size") / CHUNK).cast("int").alias("_rights")
    )
    rows = known.select("id", "band", "component", "_out").join(still, "band")
    number = F.xxhash64("id", F.lit(7))
    own_left = F.pmod(number, F.col("_lefts")).cast("int")
    own_right = F.pmod(number, F.col("_rights")).cast("int")
    every_left, every_right = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("_lefts", "_rights"))
    as_right = rows.select("*", F.lit(False).alias("left"), F.explode(every_left).alias("i"), own_right.alias("j"))
    as_left = rows.filter("_out").select("*", F.lit(True).alias("left"), own_left.alias("i"), F.explode(every_right).alias("j"))
    dealt = as_right.union(as_left).select("id", "band", "component", "left", "i", "j")
    full = dealt.hint("merge").join(texts, "id").join(reps, "id")
    return full.groupBy("band", "i", "j").applyInArrow(_links_in_block(percent), "a long, b long")


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, _key, _text``: each row with a number of its own, as rows may share a key; no number without a key."""
    number = F.when(docs[key].isNotNull(), F.monotonically_increasing_id())
    return docs.select(number.alias("id"), docs[key].cast("long").alias("_key"), docs[text].alias("_text"))


def _grouped(rows: DataFrame, folder: str, percent: int) -> DataFrame:
    """``id, _key, n_shingles, least`` of every row of :func:`_numbered`, written before.

    ``least`` is the smallest key of the row's group and the number of its first row.
    """
    marks = stage(sketch(rows, "id", "_text", "_key"), folder, "marks")
    plain = rows.select("id", "_text").filter("id IS NOT NULL")
    same = ["n_shingles", "print1", "print2"]
    classes = marks.filter("n_shingles > 0 AND id IS NOT NULL").groupBy(*same).agg(F.min("id").alias("rep"))
    # Hot classes meet in this join; both sides are shuffled for it, so the planner splits their rows.
    members = stage(
        marks.select("id", "_key", *same).join(classes, same, "left").select(
            "id", "_key", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")
        ),
        folder, "members",
    )
    only = members.filter("rep = id AND n_shingles > 0").select("id").distinct()
    reps = stage(marks.join(only, "id", "left_semi").select("id", "bands", "signature").dropDuplicates(["id"]), folder, "reps")

    # The centre of a band is the member that meets most others in all its bands.
    spots = reps.select("id", F.explode("bands").alias("band"))
    crowds = stage(spots.groupBy("band").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1"), folder, "crowds")
    shared = stage(spots.join(crowds, "band"), folder, "shared")
    fame = shared.groupBy("id").agg(F.sum("_size").alias("_fame"))
    centers = shared.select("id", "band").join(fame, "id").groupBy("band").agg(
        F.max_by("id", F.struct("_fame", -F.col("id"))).alias("center")
    )
    spots = stage(shared.select("id", "band").join(centers, "band"), folder, "spots")
    texts = stage(
        plain.join(spots.select("id").distinct().hint("merge"), "id", "left_semi").dropDuplicates(["id"]), folder, "texts"
    )
    pairs = spots.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    signed = reps.select("id", "signature")
    near = pairs.join(signed.select(F.col("id").alias("b"), F.col("signature").alias("_b")), "b").join(
        signed.select(F.col("id").alias("a"), F.col("signature").alias("_a")), "a"
    ).filter(estimate(F.col("_a"), F.col("_b")) >= percent / 100 - MARGIN)
    links = stage(confirm(near.select("a", "b"), texts, percent), folder, "links0")
    found = connected_components(links, f"{folder}/components0").withColumnRenamed("node", "id")
    more = stage(_rest_of_bands(spots, found, reps, texts, percent), folder, "links1")
    found = connected_components(links.union(more), f"{folder}/components1").withColumnRenamed("node", "rep")
    done = salted_join(members, found.withColumnRenamed("component", "_component"), ["rep"], F.xxhash64("id"))
    done = stage(done.select("id", "_key", "n_shingles", F.coalesce("_component", "rep").alias("component")), folder, "done")
    least = done.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("_key", "id")).alias("least"))
    return salted_join(done, least, ["component"], F.xxhash64("id")).select("id", "_key", "n_shingles", "least")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row."""
    folder = stage_folder(docs.sparkSession)
    found = _grouped(stage(_numbered(docs, key, text), folder, "rows"), folder, percent)
    return found.select(
        F.col("_key").alias(key), "n_shingles", F.col("least._key").alias("component_id"),
        F.coalesce(F.col("_key") == F.col("least._key"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row of each group, that of the smallest key, and the rows without a key."""
    folder = stage_folder(docs.sparkSession)
    number = "_row"
    while number in docs.columns:
        number += "_"
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), folder, "documents")
    numbered = rows.select(
        F.when(F.col(key).isNotNull(), F.col(number)).alias("id"), F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")
    )
    first = _grouped(numbered, folder, percent).filter("id = least.id").select(F.col("id").alias(number))
    chosen = rows.join(first, number, "left_semi").select(*docs.columns)
    return chosen.union(rows.filter(F.col(key).isNull()).select(*docs.columns))
