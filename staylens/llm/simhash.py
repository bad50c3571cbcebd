"""SimHash near copies with bit-sliced distance counting.

Fingerprints within ``radius`` bits agree on at least two of ``radius + 2``
bands, so every pair of bands gives one table of candidate buckets and no link
is missed. Inside the buckets, fingerprints are stored as 64 bit planes: one
machine word holds the same bit of 64 fingerprints. Shifting the planes by d
rows and xor-ing them gives the differing bits of every pair (i, i + d) at once;
carry-save adders count them, and words in which every pair has passed the
radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.components import connected_components
from staylens.llm.text import lookup_join
from staylens.session import keep

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
# Rows of a bucket compared in one unit; larger buckets are cut into pairs of blocks.
BLOCK_ROWS = 2048
BUFFER_ROWS = 1 << 17
COUNT_CHUNK = 1 << 16

_UPPER = bytes(range(65, 91))
_LOWER_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())


def shingle_hashes(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every run of ``shingle`` blank-separated words, repeats included."""
    words = text.translate(_LOWER_TABLE).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[b:e], SEED) for b, e in zip(begins, ends[shingle - 1 :].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, as a signed 64-bit number."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNT_CHUNK):
        part = hashes[at : at + COUNT_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a bigint; zero for NULL."""

    @F.arrow_udf("bigint")
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(shingle_hashes(t.as_py() or b"", shingle)) for t in texts], pa.int64())

    return mark(text.cast("binary"))


def band_keys(fp: Column, bands: int) -> Column:
    """One bucket key for each pair of bands, the pair's number in the high bits."""
    edges = [round(i * BITS / bands) for i in range(bands + 1)]
    parts = [
        F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])
    ]
    width = max(hi - lo for lo, hi in zip(edges, edges[1:]))
    keys = [
        F.lit(n << (2 * width)).bitwiseOR(F.shiftleft(parts[i], width)).bitwiseOR(parts[j])
        for n, (i, j) in enumerate(combinations(range(bands), 2))
    ]
    return F.array(*keys)


def _save(a, b, c):
    """Carry-save adder: (carry, sum) of three bit vectors."""
    u = a ^ b
    return (a & b) | (u & c), u ^ c


def _beyond(ones, twos, fours, over, radius):
    """Pairs whose counted distance exceeds ``radius`` (at most 7)."""
    more, equal = over.copy(), ~np.zeros_like(over)
    for bit, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            equal &= plane
        else:
            more |= equal & plane
            equal &= ~plane
    return more


def planes_of(fps: np.ndarray, spare: int) -> np.ndarray:
    """64 rows of words; bit i of row p is bit p of fingerprint i."""
    bits = np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    words = (len(fps) + 63) // 64 + spare
    out = np.zeros((BITS, words * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view("<u8")


def _bit_words(flags: np.ndarray) -> np.ndarray:
    out = np.zeros((len(flags) + 63) // 64 * 8, np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[: len(packed)] = packed
    return out.view("<u8")


def close_at(planes: np.ndarray, valid: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """Rows i with a valid pair (i, i + shift) of at most ``radius`` differing bits."""
    skip, turn = divmod(shift, 64)
    at = np.flatnonzero(valid)
    alive = valid[at]
    ones, twos, fours, over = (np.zeros_like(alive) for _ in range(4))
    left, right = np.uint64(64 - turn), np.uint64(turn)

    def differing(p):
        row = planes[p]
        other = row[at + skip] >> right
        if turn:
            other |= row[at + skip + 1] << left
        return row[at] ^ other

    for p in range(0, BITS, 8):
        for q in (p, p + 4):
            carry_a, ones = _save(ones, differing(q), differing(q + 1))
            carry_b, ones = _save(ones, differing(q + 2), differing(q + 3))
            carry, twos = _save(twos, carry_a, carry_b)
            over |= fours & carry
            fours ^= carry
        alive &= ~_beyond(ones, twos, fours, over, radius)
        live = np.flatnonzero(alive)
        if not len(live):
            return live
        if 2 * len(live) < len(at):
            at, alive, ones, twos, fours, over = (x[live] for x in (at, alive, ones, twos, fours, over))
    word, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return at[word] * 64 + bit


def linked_pairs(groups: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each group; equal groups stand together."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    size_of = np.repeat(sizes, sizes)
    order = np.argsort(-size_of, kind="stable")
    order = order[: np.count_nonzero(size_of > 1)]
    fps, size_of = fps[order], size_of[order]
    place = (np.arange(len(groups)) - np.repeat(starts, sizes))[order]
    n = len(fps)
    if not n:
        return fps, fps
    planes = planes_of(fps, int(sizes.max()) // 64 + 2)
    root = np.arange(n)
    left, right = [], []

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for d in range(1, int(sizes.max())):
        reach = np.searchsorted(-size_of, -d, side="left")  # groups larger than d come first
        i = close_at(planes, _bit_words(place[:reach] + d < size_of[:reach]), d, radius)
        i = i[root[i] != root[i + d]]
        if not len(i):
            continue
        for a in i.tolist():
            x, y = find(a), find(a + d)
            if x != y:
                root[max(x, y)] = min(x, y)
                left.append(a)
                right.append(a + d)
        while True:
            flat = root[root]
            if np.array_equal(flat, root):
                break
            root = flat
    return fps[np.array(left, np.int64)], fps[np.array(right, np.int64)]


def _link_batches(radius: int, buffer_rows: int):
    def run(batches):
        held = np.empty((0, 3), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.column_stack([batch.column(i).to_numpy() for i in range(3)])])
            if len(held) < buffer_rows:
                continue
            changes = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1))
            if len(changes):
                cut = changes[-1] + 1
                yield links(held[:cut])
                held = held[cut:]
        if len(held):
            yield links(held)

    def links(rows):
        fresh = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
        a, b = linked_pairs(np.cumsum(fresh), rows[:, 2], radius)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def link_edges(distinct_fps: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between fingerprints that connect all that are within ``radius``."""
    rows = distinct_fps.select("fp", F.explode(band_keys(F.col("fp"), radius + 2)).alias("key"))
    large = keep(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows)
        .select("key", F.ceil(F.col("n") / block_rows).cast("bigint").alias("blocks")),
        "large-buckets",
    )
    rows = lookup_join(rows, large, "key", "left", large.count(), 32)
    own = F.pmod(F.xxhash64("fp"), "blocks")
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: k != F.col("own"))
    pairs = F.transform(others, lambda k: F.least(k, F.col("own")) * F.col("blocks") + F.greatest(k, F.col("own")))
    units = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(pairs)
    rows = rows.withColumn("own", own).select("key", F.explode(units).alias("unit"), "fp")
    dealt = rows.repartition("key", "unit").sortWithinPartitions("key", "unit", "fp")
    return dealt.mapInArrow(_link_batches(radius, BUFFER_ROWS), "a bigint, b bigint")


def fingerprint_roots(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Columns fp, root for every distinct ``fp`` of ``marked``: the least linked fingerprint."""
    distinct = keep(marked.select("fp").distinct(), "distinct-fingerprints")
    stars = connected_components(link_edges(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(stars, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return keep(rooted, "roots")


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """Columns doc_id, fingerprint, component_id; one row per row of ``docs``.

    Links join fingerprints with at most ``radius`` differing bits; component_id
    is the least doc_id reachable. Texts without words (NULL, empty, blanks) have
    fingerprint zero and link like any other. Equal texts share a fingerprint and
    are compared once, so copies cost nothing. A NULL doc_id passes links on but
    is never the least; a component of NULL ids only has a NULL component_id.
    Repeated rows repeat; other columns are not read.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the bit counters hold distances up to 7")
    marked = docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), shingle).alias("fp"))
    marked = keep(marked, "fingerprints")
    roots = fingerprint_roots(marked, radius)
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(roots, "fp")
    least = firsts.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = keep(roots.join(least, "root").select("fp", "component_id"), "components")
    joined = lookup_join(marked, named, "fp", "inner", named.count(), 48)
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row of each component, that of the least id; all columns stay.

    Of repeated ids one row stays; a component without any id keeps one row too.
    """
    marked = docs.select(
        F.struct("*").alias("doc"),
        F.col(doc_id).alias("id"),
        fingerprint_column(F.col(text), shingle).alias("fp"),
        F.monotonically_increasing_id().alias("row"),
    )
    marked = keep(marked, "marked-texts")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    firsts = marked.groupBy("fp").agg(F.min(at).alias("at"))
    roots = fingerprint_roots(firsts, radius)
    chosen = firsts.join(roots, "fp").groupBy("root").agg(F.min("at").alias("at")).select("at.row")
    chosen = keep(chosen, "chosen-rows")
    return lookup_join(marked, chosen, "row", "left_semi", chosen.count(), 24).select("doc.*")
