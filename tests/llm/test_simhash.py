import random
import re

import numpy as np
import xxhash

from staylens.llm.components import connected_components
from staylens.llm.simhash import keep_one_of_each, link_edges, linked_pairs, simhash_components

from .words import awkward_docs


def marks(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, close):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if close(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def flipped(rng, fps, copies, most):
    out = list(fps)
    for fp in fps:
        for _ in range(rng.randint(0, copies)):
            for bit in rng.sample(range(64), rng.randint(1, most)):
                fp ^= 1 << bit
            out.append(fp)
    return [x - (1 << 64) if x >> 63 else x for x in dict.fromkeys(out)]


def differing(a, b):
    return bin((a ^ b) & ((1 << 64) - 1)).count("1")


def test_linked_pairs_find_every_link_inside_groups():
    rng = random.Random(5)
    for radius in (0, 3, 4, 7):
        fps = flipped(rng, [rng.getrandbits(64) for _ in range(40)], 6, radius + 2)
        group = sorted(rng.randint(0, 3) for _ in fps)
        a, b = linked_pairs(np.array(group), np.array(fps, np.int64), radius)
        at = {fp: i for i, fp in enumerate(fps)}
        edges = {frozenset((at[int(x)], at[int(y)])) for x, y in zip(a, b)}
        assert all(differing(*(fps[i] for i in e)) <= radius for e in edges)
        want = groups(len(fps), lambda i, j: group[i] == group[j] and differing(fps[i], fps[j]) <= radius)
        assert groups(len(fps), lambda i, j: frozenset((i, j)) in edges) == want


def test_large_buckets_are_cut_and_lose_no_link(spark):
    rng = random.Random(6)
    fps = flipped(rng, [rng.getrandbits(64) for _ in range(3)], 60, 6)
    table = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    edges = link_edges(table, 4, block_rows=8)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    ordered = sorted(fps)
    want = groups(len(ordered), lambda i, j: differing(ordered[i], ordered[j]) <= 4)
    assert [roots.get(f, f) for f in ordered] == [ordered[i] for i in want]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    fps = [marks(r.text) for r in rows]
    roots = groups(len(rows), lambda i, j: differing(fps[i], fps[j]) <= 4)
    want = [(r.doc_id, f"{f:016x}", rows[k].doc_id) for r, f, k in zip(rows, fps, roots)]
    assert sorted(tuple(r) for r in simhash_components(docs).collect()) == want
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == sorted({w[2] for w in want})


def test_awkward_rows_and_empty_table(spark):
    docs = awkward_docs(spark)
    found = simhash_components(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].fingerprint == "0" * 16 and by_id[4].component_id == 2
    assert by_id[8].component_id == 1 and by_id[None].component_id is None
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 5, 6, 7, 9]
    assert simhash_components(docs.limit(0)).count() == 0 and keep_one_of_each(docs.limit(0)).count() == 0
