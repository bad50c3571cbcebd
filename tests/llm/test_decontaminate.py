import hashlib
import random
import re

import pytest

from staylens.llm import text as tx
from staylens.llm.decontaminate import decontaminate, drop_contaminated

from .words import LONG, awkward_docs, collected

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(text)


def brute(docs, items):
    windows = set()
    for item, text in items:
        w = words(text)
        windows |= {(item, tuple(w[i : i + 13])) for i in range(max(1, len(w) - 12)) if w}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, part in windows:
            for i in range(len(w) - len(part) + 1):
                if tuple(w[i : i + len(part)]) == part:
                    hit |= set(range(i, i + len(part)))
                    if item is not None:
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [tx.BROADCAST_BYTES, 4_000, 0])
def test_equals_brute_force(spark, monkeypatch, bound):
    """In place, by a shuffle of what a Bloom filter passes, and by a shuffle of all places."""
    monkeypatch.setattr(tx, "BROADCAST_BYTES", bound)
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "é1", "É1", "x", "y9"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 13, 15, 20])))) for i in range(25)]
    items += [(3, items[3][1]), (90, items[4][1]), (None, "only nameless"), (91, None), (92, ""), (93, "--")]
    docs = []
    for i in range(60):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))
        if i % 3 == 0:
            text += ", " + rng.choice(items[:25])[1].upper().replace("É", "é") + "! " + text
        docs.append((i, text))
    docs += [(60, None), (61, "NAMELESS only nameless"), (0, docs[0][1])]
    found = decontaminate(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert collected(found) == brute(docs, items)


@pytest.mark.parametrize("bound", [tx.BROADCAST_BYTES, 0])
def test_awkward_rows_and_empty_tables(spark, monkeypatch, bound):
    monkeypatch.setattr(tx, "BROADCAST_BYTES", bound)
    docs = awkward_docs(spark)
    items = spark.createDataFrame([(1, " ".join(LONG.split()[100:140]), "z")], "item_id bigint, text string, row string")
    rows = {r.doc_id: r for r in decontaminate(docs, items).collect()}
    assert rows[5].n_items == 1 and rows[2].n_words == 0 and not rows[2].contaminated
    assert decontaminate(docs, items).count() == docs.count()
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).filter("n_hit > 0 or contaminated").count() == 0


@pytest.mark.parametrize("bound", [tx.BROADCAST_BYTES, 0])
def test_drop_keeps_clean_rows_and_columns(spark, monkeypatch, bound):
    monkeypatch.setattr(tx, "BROADCAST_BYTES", bound)
    docs = awkward_docs(spark)
    items = spark.createDataFrame([(1, "quick brown fox the lazy dog sleeps")], "item_id bigint, text string")
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 3, 4, 5, 6, 7, 9]
