"""The trie of conversation beginnings against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from staylens.llm.prefix_trie import TernaryTree, prefix_trie
from tests.llm.words import collected

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq string, key string, node string, h string"


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(parts)


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        below = kids.get(n, [])
        leaves[n] = sum(leaves[k] for k in below) if below else 1
        saved[n] = (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0) + sum(saved[k] for k in below)
    out = []
    for n, members in nodes.items():
        ends = sorted(c for c in members if len(rebuilt[c]) == len(n))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(nodes[n[:-1]]) if n else None
        out.append((min(members), len(n), parent, len(members), len(kids.get(n, [])), leaves[n], saved[n], sha))
    return sorted(out, key=repr)


def random_rows(seed, convs, words):
    rng = random.Random(seed)
    rows = []
    for c in range(-120, convs):
        for t in range(rng.randint(0, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice([None, "", *words])))
    return rows


@pytest.mark.parametrize("seed, convs, words", [(1, 400, ["a", "bb"]), (2, 250, ["é\U0001F600", "b", "c", "d", "e"]), (3, 60, ["same"])])
def test_equals_brute_force(spark, seed, convs, words):
    rows = random_rows(seed, convs, words)
    assert collected(prefix_trie(table(spark, rows))) == brute(rows)


def test_one_first_turn_and_one_conversation_for_all(spark):
    rows = [(c, t, "user", "hello" if t < 2 else ("twin" if c % 2 else f"own {c}")) for c in range(1500) for t in range(4)]
    assert collected(prefix_trie(table(spark, rows, 9))) == brute(rows)


def test_awkward_turns(spark):
    rows = [
        (None, 0, "user", "no id"),
        (100, None, "user", "first"),
        (100, 0, None, None),
        (100, 0, "user", "tie b"),
        (100, 0, "user", "tie a"),
        (100, 0, "user", "tie a"),
        (101, 9, "user", "x" * 300_000),
        (205, 0, "user", "base is missing"),
        (1 << 60, 0, "a:b", "c"),
        ((1 << 60) + 1, 0, "a", "b:c"),
    ]
    assert collected(prefix_trie(table(spark, rows))) == brute(rows)


def test_long_conversation(spark):
    rows = [(7, t, "user", f"t{t % 3}") for t in range(3_000)] + [(c, 0, "user", "z") for c in range(300)]
    assert collected(prefix_trie(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie(table(spark, [])).collect() == []


def test_median_insertion_balances():
    tree = TernaryTree()
    tree.insert_sorted([[i] for i in range(1023)])

    def height(at):
        return 0 if at == -1 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.equal[0]) == 10
