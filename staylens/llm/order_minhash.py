"""Document fingerprints that follow edit distance: Order MinHash.

Every run of ``k`` code points is numbered by how often it has occurred before in
the text. For each of ``m`` hash orders the ``l`` least numbered runs are selected,
put back into text order and hashed as one tuple. Two texts agree in a component
when the same runs are least *and* stand in the same order, so moving passages
costs likeness, which an unordered sketch would not see.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Length of a run, runs per tuple, tuples per signature.
RUN, TUPLE, TUPLES = 8, 2, 64
SEED = 42
# Cells of one product of seeds and runs, so that a block stays in the cache.
CELLS = 1 << 15
# Expected candidates of one hash order.
CANDIDATES = 12
BUCKETS_PER_PARTITION, KEYS_PER_BUCKET = 8, 24

_ODD_A, _ODD_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD_A
    x = (x ^ (x >> np.uint64(27))) * _ODD_B
    return x ^ (x >> np.uint64(31))


def run_hashes(points: np.ndarray, run: int) -> np.ndarray:
    """A 64-bit hash of every run of ``run`` code points; a shorter text is one run."""
    run = min(run, len(points))
    if not run:
        return np.empty(0, np.uint64)
    size = len(points) - run + 1
    out = np.zeros(size, np.uint64)
    for j in range(run):
        out *= _BASE
        out += points[j : j + size]
        out += np.uint64(1)
    return _mixed(out)


def occurrence_numbers(hashes: np.ndarray) -> np.ndarray:
    """How many equal runs stand before each run of the text."""
    size = len(hashes)
    bits = np.uint64(max(size - 1, 1).bit_length())
    places = np.arange(size, dtype=np.uint64)
    # Hash and place in one word sort faster than an argsort and stay in text order.
    keys = np.sort((hashes << bits) | places)
    at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    groups = keys >> bits
    first = np.r_[True, groups[1:] != groups[:-1]]
    steps = np.arange(size)
    numbers = np.empty(size, np.int64)
    numbers[at] = steps - np.maximum.accumulate(np.where(first, steps, 0))
    return numbers


@dataclass(frozen=True)
class OrderMinHash:
    """The sketch's parameters; ``signature`` gives ``tuples`` 32-bit numbers."""

    run: int = RUN
    size: int = TUPLE
    tuples: int = TUPLES
    seed: int = SEED

    def seeds(self) -> np.ndarray:
        return _mixed(np.arange(1, self.tuples + 1, dtype=np.uint64) * _BASE + np.uint64(self.seed)) | np.uint64(1)

    def signature(self, points: np.ndarray) -> np.ndarray:
        hashes = run_hashes(points, self.run)
        return self._packed(hashes, self._least(self._base(hashes), [(0, len(hashes))], 0)[0])

    def signatures(self, points: np.ndarray, edited: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of two texts whose first ``kept`` code points are equal.

        A run is numbered by what stands before it, so the runs inside the common start
        have the same keys in both texts and are looked at once.
        """
        own, changed = run_hashes(points, self.run), run_hashes(edited, self.run)
        # A text shorter than a run is hashed at its own length.
        common = max(kept - self.run + 1, 0)
        base = np.concatenate([self._base(own), self._base(changed)[common:]])
        least = self._least(base, [(0, len(own)), (len(own), len(base))], common)
        return self._packed(own, least[0]), self._packed(changed, least[1])

    def _base(self, hashes: np.ndarray) -> np.ndarray:
        """One key for each run and its number."""
        if not len(hashes):
            return hashes
        numbers = occurrence_numbers(hashes).astype(np.uint64)
        return _mixed(hashes + _mixed(numbers * _BASE + np.uint64(self.seed)))

    def _packed(self, hashes: np.ndarray, least: np.ndarray) -> np.ndarray:
        out = np.zeros(self.tuples, np.uint64)
        if not len(hashes):
            return out.astype(np.uint32)
        chosen = np.sort(least, axis=1)
        for j in range(chosen.shape[1]):
            out = _mixed(out * _BASE + hashes[chosen[:, j]])
        return (out >> np.uint64(32)).astype(np.uint32)

    def _least(self, base: np.ndarray, spans: list[tuple[int, int]], common: int) -> list[np.ndarray]:
        """Places of the least products, one row per hash order; earlier places win ties.

        One table of places for each text, which consists of the first ``common`` keys
        and those of its span.
        """
        sizes = [stop - max(start, common) + common for start, stop in spans]
        wants = [min(self.size, size) for size in sizes]
        seeds = self.seeds()
        out = [np.empty((self.tuples, want), np.int64) for want in wants]
        least = min((size for size in sizes if size), default=0)
        if not least:
            return out
        open_rows = np.arange(self.tuples)
        share = CANDIDATES * self.size / 2 / least
        while len(open_rows):
            limit = np.uint64(2**64 - 1) if share >= 1 else np.uint64(int(share * 2**64))
            rows, places, values = self._below(base, seeds[open_rows], limit)
            # Places ascend within a row, and the sort is stable.
            order = np.lexsort((values, rows))
            rows, places = rows[order], places[order]
            done = np.ones(len(open_rows), bool)
            for (start, stop), want, table in zip(spans, wants, out):
                mine = (places < common) | ((places >= start) & (places < stop))
                at, found = rows[mine], places[mine]
                counts = np.bincount(at, minlength=len(open_rows))
                enough = counts >= want
                picked = found[(np.cumsum(counts) - counts)[enough, None] + np.arange(want)]
                # A span's own keys follow the common ones in its text.
                table[open_rows[enough]] = np.where(picked < common, picked, picked - max(start - common, 0))
                done &= enough
            open_rows = open_rows[~done]
            share *= 16
        return out

    @staticmethod
    def _below(base: np.ndarray, seeds: np.ndarray, limit: np.uint64):
        found = []
        width = min(len(base), CELLS)
        height = max(CELLS // width, 1)
        for at in range(0, len(base), width):
            part = base[None, at : at + width]
            for top in range(0, len(seeds), height):
                products = part * seeds[top : top + height, None]
                flat = np.flatnonzero(products <= limit)
                rows, places = np.divmod(flat, part.shape[1])
                found.append((rows + top, places + at, products.ravel()[flat]))
        return tuple(np.concatenate(x) for x in zip(*found))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components."""
    return float((a == b).mean())


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def bucket_cuts(docs: DataFrame, buckets: int) -> list[tuple]:
    """First keys of ``buckets`` contiguous ranges, each the key of a row that exists.

    A key is (id present, id, hash of the text). The cuts come from a bounded
    sample of keys, about ``KEYS_PER_BUCKET`` for each bucket, chosen by a hash;
    they steer only where rows go. The first is the least key of all rows.
    """
    keys = docs.select(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", F.xxhash64("text").alias("tie")).alias("key"))
    step = max(docs.count() // (buckets * KEYS_PER_BUCKET), 1)
    drawn = F.pmod(F.xxhash64("key.doc_id", "key.tie", F.lit(SEED)), F.lit(step)) == 0
    least = keys.agg(F.min("key").alias("key"))
    rows = least.union(keys.filter(drawn).distinct()).filter("key IS NOT NULL").collect()
    found = sorted({_key(*r["key"]) for r in rows})
    places = {len(found) * i // buckets for i in range(buckets)} if found else set()
    return [found[i] for i in sorted(places)]


def _key(has, doc_id, tie) -> tuple:
    return (1, doc_id, tie) if has else (0, 0, tie)


def _packer(cuts: list[tuple]):
    """Rows with their bucket and packed text; a bucket's first row also goes to the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        lent = set()
        for batch in batches:
            ids, ties, texts = (batch.column(i).to_pylist() for i in range(3))
            out = {"bucket": [], "guest": [], "doc_id": [], "tie": [], "size": [], "packed": []}
            for doc_id, tie, text in zip(ids, ties, texts):
                raw = (text or "").encode("utf-8", "surrogatepass")
                packed = codec.compress(raw, asbytes=True) if raw else b""
                key = _key(doc_id is not None, doc_id, tie)
                bucket = bisect_right(cuts, key) - 1
                homes = [(bucket, False)]
                if key == cuts[bucket] and bucket not in lent:
                    lent.add(bucket)
                    homes.append(((bucket - 1) % len(cuts), True))
                for home, guest in homes:
                    for name, value in zip(out, (home, guest, doc_id, tie, len(raw), packed)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(out["bucket"], pa.int32()),
                    "guest": pa.array(out["guest"], pa.bool_()),
                    "doc_id": pa.array(out["doc_id"], batch.schema.field(0).type),
                    "tie": pa.array(out["tie"], pa.int64()),
                    "size": pa.array(out["size"], pa.int64()),
                    "packed": pa.array(out["packed"], pa.binary()),
                }
            )

    return run


OUT_ROWS = 1_000


def _fingerprinter(sketch: OrderMinHash, id_type: pa.DataType):
    """Walk sorted buckets with one text of look-ahead; a bucket's guest comes last."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def rows(batches):
        codec = pa.Codec("zstd")
        bucket, held, waiting, ended = None, None, None, False
        for batch in batches:
            columns = (batch.column(n) for n in ("bucket", "guest", "doc_id", "size", "packed"))
            for home, guest, doc_id, size, packed in zip(*(c.to_pylist() for c in columns)):
                if home != bucket:
                    bucket, held, waiting, ended = home, None, None, False
                if ended:
                    continue  # another copy of the guest
                raw = codec.decompress(packed, size, asbytes=True) if size else b""
                text = raw.decode("utf-8", "surrogatepass")
                if held is not None:
                    # A text's signature is made with that of its edited text, and completes the row before.
                    own, found = row(*held, text)
                    if waiting is not None:
                        yield completed(*waiting, own)
                    waiting = found, own
                held, ended = (doc_id, text), guest
                if guest and waiting is not None:
                    yield completed(*waiting, sketch.signature(code_points(text)))

    def row(doc_id, text, following):
        edited = edited_text(text, following)
        own, changed = sketch.signatures(code_points(text), code_points(edited), len(text) - len(text) // 4)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return own, (doc_id, len(text), digest, _hex(own), _hex(changed), likeness(own, changed))

    def completed(found, own, next_own):
        return *found, likeness(own, next_own)

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for r in rows(batches):
            found.append(r)
            if len(found) == OUT_ROWS:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    return run


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sketch: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Signature of every text and of its edited text, and their likeness.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; one row per row of ``docs``. The edited text is the
    text with its last quarter replaced by the start of the next document's; the
    next document is the one with the next larger id, the first for the last.

    Whole texts move once, packed, into many contiguous ranges of ids, so each
    meets its successor in its own task; the first row of a range is lent to the
    range before. A task holds two texts at a time. NULL texts are empty; an empty
    text has the all-zero signature; one shorter than a run is a single run. NULL
    ids come first; rows of one id (or none) follow in the order of a hash of the
    text, then the packed text, and repeated rows repeat. A single row is its own
    next one. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = bucket_cuts(rows, partitions * BUCKETS_PER_PARTITION)
    kind = rows.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not cuts:
        return docs.sparkSession.createDataFrame([], result)
    packed = rows.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        _packer(cuts), f"bucket int, guest boolean, doc_id {kind}, tie bigint, size bigint, packed binary"
    )
    dealt = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "tie", "packed")
    return dealt.mapInArrow(_fingerprinter(sketch, _arrow_type(rows)), result)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)
