import zlib

import numpy as np

from staylens.llm import language
from staylens.llm.language import codewords, identify, ngrams

from .words import awkward_docs


def test_pieces_of_a_text_give_all_ngrams_once(monkeypatch):
    text = "Héllo wörld, 42 Ab cd. ÀÉ" * 9
    whole = np.sort(np.concatenate(list(ngrams(text))))
    monkeypatch.setattr(language, "CHUNK", 7)
    assert np.array_equal(np.sort(np.concatenate(list(ngrams(text)))), whole)


def test_case_and_other_characters_do_not_matter():
    a, b = (np.sort(np.concatenate(list(ngrams(t)))) for t in ("Das Ende", "das\x00ENDE"))
    assert np.array_equal(a, b)


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 40, 300):
        code = codewords(n)
        assert len(np.unique(code, axis=0)) == n and set(np.unique(code)) == {-1.0, 1.0}
        assert (code.min(axis=0) < code.max(axis=0)).all()
    assert codewords(4).shape == (4, 7)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward_docs(spark)
    rows = identify(docs).collect()
    assert len(rows) == docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 5, 7)} == {"en"}
    assert identify(docs.limit(0)).count() == 0
    nothing = identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
