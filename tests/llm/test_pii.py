import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import pii
from staylens.llm.crf import Decoder, fit_crf, luhn, viterbi, word_shape

from .words import awkward_docs

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    parts = ["a@b.c", "@", ".", "x_y", "1.2.3.4", "256", "4111111111111111", "4111 1111-1111 1111", "+1 (2", "34) 5678901", " ", "-", "é", "a@b", "%", "00"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000):
        pii.base_spans(text)


def test_long_numbers_in_every_pattern(spark):
    zeros, digits = "0" * 1_000_000, "7" * 1_000_000
    for run in (zeros, digits):
        for text in (f"{run}.1.2.3", f"1.{run}.2.3", f"1.2.3.{run}", f"+{run}", f"a@{run}.{run}", run, f"{run} {run}-{run}", f"+1 ({run}) {run}"):
            spans = pii.base_spans(text)
            assert [s[1] for s in spans if s[1] == 1] == ([1] if run == zeros and ".1.2.3" in text or run == zeros and "1." in text else [])
    assert pii.base_spans("000.00000.0255.1") == [(0, 1, 16)]
    assert pii.base_spans("0.0.0.0256") == []
    got = pii.find_pii(awkward_docs(spark, [(1, f"{zeros}.1.2.3"), (2, "mail a@b.cd or 10.0.0.1")])).collect()
    assert {r.doc_id: r.n_ip for r in got} == {1: 1, 2: 1}


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    for steps in (1, 2, 4):
        scores, moves = rng.normal(size=(5, steps, 3)), rng.normal(size=(3, 3))
        for row, path in zip(scores, viterbi(scores, moves)):
            def total(p):
                ends = (0, *p, 0)
                return sum(moves[a, b] for a, b in zip(ends, ends[1:])) + sum(row[t, y] for t, y in enumerate(p))

            assert tuple(path) == max(itertools.product(range(3), repeat=steps), key=total)


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_settled_words_do_not_change_the_best_path(model):
    text = b"call +1 (415) 555-2671 or mail a.b@c.org , card 4111 1111 1111 1111 and words at the end"
    decoder = Decoder(model)
    ids = decoder.ids(text.split())
    at, labels = decoder.decode([ids])[0]
    full = np.zeros(len(ids), int)
    full[at] = labels
    scores = decoder._scores(ids, 0, len(ids))[None]
    assert np.array_equal(viterbi(scores, model.moves)[0], full)
    assert {pii.LABELS[i] for i in full} > {"O", "B-phone", "B-email"}


def test_field_learns_and_finds_what_patterns_miss(model):
    decoder = Decoder(model)
    text = "numbers 4111111111111111 5555555555554444 here"
    base = pii.base_spans(text)
    assert base == []
    tagged = decoder.decode([decoder.ids(text.encode().split())])[0]
    assert pii.listed(pii._added(text, base, tagged)) == "card:8:24,card:25:41"


def test_fit_separates_shapes():
    rows = [([word_shape(w) for w in t.split()], l.split()) for t, l in (("see 12-34 ok", "O B O"), ("see it ok", "O O O"))] * 5
    decoder = Decoder(fit_crf(rows, ["O", "B"]))
    assert decoder.decode([decoder.ids(b"see 56-78 ok".split())])[0][0].tolist() == [1]


def test_query_equals_patterns_and_awkward_rows(spark):
    docs = awkward_docs(spark)
    found = pii.find_pii(docs).collect()
    assert len(found) == docs.count() and all(r.spans == "" for r in found)
    assert pii.find_pii(docs.limit(0)).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(pii.listed(base).split(",")) <= set(r.spans.split(","))


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (415) 555-2671."), (2, None)], "doc_id bigint, text string")
    assert [r.text for r in pii.mask_pii(docs).orderBy("doc_id").collect()] == ["mail [EMAIL] or [PHONE].", None]


def test_masked_texts_leave_a_batch_in_small_parts(model):
    texts = [f"mail a{i}@b.co" if i % 3 else None for i in range(600)]
    parts = list(pii._finder(model, True)(iter([pa.array(texts), pa.array([], pa.string())])))
    assert max(map(len, parts)) <= 256
    assert [r["masked"] for p in parts for r in p.to_pylist()] == ["mail [EMAIL]" if t else "" for t in texts]


def test_more_shapes_than_the_limit(model, monkeypatch):
    rng = random.Random(3)
    known = ["4111111111111111", "415-555-2671", "(415)", "555-2671", "jane@localhost", "word", "of", "10.0.0.7"]
    odd = lambda: hashlib.sha1(str(rng.random()).encode()).hexdigest()
    texts = [" ".join(rng.choice(known) if rng.random() < 0.6 else odd() for _ in range(n)) for n in (0, 3, 30, 400, 7, 12, 13, 1, 90)]
    words = [t.encode().split() for t in texts]
    wide = Decoder(model)
    wanted = wide.decode([wide.ids(w) for w in words])
    assert len(wide.shapes) > 150 and sum(len(at) for at, _ in wanted) > 50
    small = Decoder(model, limit=50)
    for _ in range(2):
        for got, want in zip(small.tag(words), wanted, strict=True):
            assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])
        assert len(small.shapes) <= 50
    whole = list(pii._finder(model, True)(iter([pa.array(texts)])))
    monkeypatch.setattr(pii, "Decoder", lambda m: Decoder(m, limit=50))
    assert list(pii._finder(model, True)(iter([pa.array(texts)]))) == whole


def test_unspaced_text_is_cut_for_the_field(model):
    def added(text):
        words = pii.field_words(text)
        assert words == [text[a:b].encode() for a, b in pii.word_places(text)]
        return [text[s:e] for s, _, e in pii._added(text, pii.base_spans(text), Decoder(model).tag([words])[0])]

    card = "4111111111111111"
    json = '{"name":"some","items":[{"kind":"abcdef","value":"abcdefabcdef"}],"phone":"415-555-2671","rest":"abcdef"}'
    assert len(json) > 80 and "415-555-2671" in added(json)
    assert "415-555-2671" in added("\u6211" * 60 + "415-555-2671" + "\u4f60" * 60)
    assert "(415)555-2671" in [t.decode() for t in pii.field_words("word," * 30 + "(415)555-2671")]
    assert "jane@localhost" in [t.decode() for t in pii.field_words("https://x.org/" + "a/" * 60 + "?to=jane@localhost&b=1")]
    assert added("see " + "a1" * 60 + " there") == [] and pii.field_words("a1" * 60) == [b"a1" * 60]
    assert pii.field_words("a.b-" * 40 + "1.2") == [b"a", b"b"] * 40 + [b"1.2"]
    spaced = f"numbers {card} 5555555555554444 here"
    assert added(spaced) == [card, "5555555555554444"]
    for text in ("a," * 200_000, "(1" * 200_000, "1." * 200_000, "+1" * 200_000, "=" * 400_000, ""):
        pii.field_words(text)
