"""Order MinHash against a plain version that sorts every numbered run."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from staylens.llm.order_minhash import OrderMinHash, _fingerprinter, _mixed, code_points, edited_text, fingerprint_documents, likeness, occurrence_numbers, run_hashes
from tests.llm.words import AWKWARD, awkward_docs, collected

MASK = 2**64 - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


BASE = 0x9E3779B97F4A7C15


def plain_signature(text, run=8, size=2, tuples=64, seed=42):
    run = min(run, len(text))
    if not run:
        return "0" * 8 * tuples
    hashes, seen, pairs = [], Counter(), []
    for i in range(len(text) - run + 1):
        h = 0
        for c in text[i : i + run]:
            h = (h * BASE + ord(c) + 1) & MASK
        h = mix(h)
        hashes.append(h)
        pairs.append(mix((h + mix((seen[h] * BASE + seed) & MASK)) & MASK))
        seen[h] += 1
    out = ""
    for t in range(1, tuples + 1):
        odd = mix((t * BASE + seed) & MASK) | 1
        least = sorted(sorted(range(len(pairs)), key=lambda i: ((pairs[i] * odd) & MASK, i))[:size])
        v = 0
        for i in least:
            v = mix((v * BASE + hashes[i]) & MASK)
        out += f"{v >> 32:08x}"
    return out


def plain_rows(rows):
    """Rows of (doc_id, text) with distinct ids."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in ordered]
    out = []
    for n, (doc_id, _) in enumerate(ordered):
        text, following = texts[n], texts[(n + 1) % len(texts)]
        edited = edited_text(text, following)
        prints = [plain_signature(t) for t in (text, edited, following)]
        near = [sum(prints[0][i : i + 8] == p[i : i + 8] for i in range(0, 512, 8)) / 64 for p in prints[1:]]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], *near))
    return sorted(out, key=repr)


def test_whole_query_equals_plain_version(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd é\U0001F600") for _ in range(rng.choice([0, 1, 3, 7, 8, 9, 40, 700]))) for _ in range(120)]
    rows = [(rng.choice([1, -1]) * (i * 37 + 5), t) for i, t in enumerate(texts)] + [(None, "no id"), (10**15, None), (10**15 + 1, "x" * 2000)]
    rows += [(10**16 + i, "the same text again and again") for i in range(40)]
    assert collected(fingerprint_documents(awkward_docs(spark, rows).repartition(7))) == plain_rows(rows)


def test_awkward_rows(spark):
    got = collected(fingerprint_documents(awkward_docs(spark)))
    assert len(got) == len(AWKWARD)
    unique = [r for r in AWKWARD if r[0] not in (8,)]
    assert {r[0] for r in got} == {r[0] for r in AWKWARD}
    by_text = {}
    for doc_id, text in unique:
        by_text[doc_id] = plain_signature(text or "") if len(text or "") < 5000 else None
    for r in got:
        assert 0 <= r[5] <= 1 and 0 <= r[6] <= 1
        if by_text.get(r[0]):
            assert r[3] == by_text[r[0]]


def test_small_tables(spark):
    assert fingerprint_documents(awkward_docs(spark, [])).collect() == []
    (row,) = fingerprint_documents(awkward_docs(spark, [(5, "alone in the table")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"alone in the talon").hexdigest() and row.near_next == 1.0
    twins = collected(fingerprint_documents(awkward_docs(spark, [(5, "twin"), (5, "twin")])))
    assert twins[0] == twins[1] and len(twins) == 2


def test_layout_and_partitions_change_nothing(spark):
    rows = [(i, f"document {i % 50} holds words {i % 7} and more " * 5) for i in range(600)]
    want = collected(fingerprint_documents(awkward_docs(spark, rows).coalesce(1)))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert collected(fingerprint_documents(awkward_docs(spark, rows).repartition(11))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_occurrence_numbers():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 500):
        hashes = _mixed(rng.integers(0, 5, size).astype(np.uint64))
        seen, want = Counter(), []
        for h in hashes.tolist():
            want.append(seen[h])
            seen[h] += 1
        assert occurrence_numbers(hashes).tolist() == want


def test_order_counts():
    """Swapping halves keeps the runs but costs likeness; a small edit costs little."""
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(4000))
    sketch = OrderMinHash()
    own = sketch.signature(code_points(text))
    swapped = sketch.signature(code_points(text[2000:] + text[:2000]))
    small = sketch.signature(code_points(text[:1000] + "changed" + text[1007:]))
    other = sketch.signature(code_points("".join(rng.choice("abcdefghijklmnop ") for _ in range(4000))))
    assert likeness(own, small) > 0.9 and likeness(own, swapped) < 0.75 and likeness(own, other) < 0.1
    edited = sketch.signature(code_points(edited_text(text, text[::-1])))
    assert 0.15 < likeness(own, edited) < 0.6


def test_very_long_texts():
    sketch = OrderMinHash()
    for text in ("x" * 1_000_000, " \n" * 500_000, "0" * 300_000 + "1"):
        assert len(sketch.signature(code_points(text))) == 64
    assert len(run_hashes(code_points("abc"), 8)) == 1


def test_signatures_of_both_texts_equal_those_made_apart():
    drawn = random.Random(5)
    texts = ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "x" * 300, "ab" * 9] + ["".join(drawn.choices("abc", k=drawn.randint(0, 80))) for _ in range(200)]
    sketch = OrderMinHash()
    for text, following in zip(texts, texts[1:] + texts[:1]):
        edited = edited_text(text, following)
        found = sketch.signatures(code_points(text), code_points(edited), len(text) - len(text) // 4)
        assert [f.astype(">u4").tobytes().hex() for f in found] == [plain_signature(text), plain_signature(edited)]


def test_common_start_is_looked_at_once(monkeypatch):
    drawn = random.Random(6)
    texts = ["".join(drawn.choices("abcdefgh ", k=2_000)) for _ in range(5)]
    seen, below = [], OrderMinHash._below

    def counted(base, seeds, limit):
        seen.append(len(base) * len(seeds))
        return below(base, seeds, limit)

    monkeypatch.setattr(OrderMinHash, "_below", staticmethod(counted))
    raw = [t.encode() for t in texts]
    codec = pa.Codec("zstd")
    batch = pa.RecordBatch.from_pydict(
        {"bucket": [0] * 5, "guest": [False] * 4 + [True], "doc_id": [1, 2, 3, 4, 5], "size": [len(r) for r in raw], "packed": [codec.compress(r, asbytes=True) for r in raw]}
    )
    (out,) = _fingerprinter(OrderMinHash(), pa.int64())(iter([batch]))
    assert out.to_pylist() == [dict(zip(out.schema.names, r)) for r in plain_rows(list(zip(range(1, 6), texts)))[:4]]
    # Four texts with a changed quarter each, and the guest; nothing about 7 runs around a cut.
    assert sum(seen) < 64 * 2_000 * 1.05 * (4 * 1.25 + 1)
