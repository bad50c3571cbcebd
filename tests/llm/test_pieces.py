import random
from functools import lru_cache

import pyarrow as pa
import sentencepiece

from staylens.llm.pieces import MODEL_PATH, Coder, Vocabulary, _encoded, decode_texts, encode_texts, load_vocabulary, piece_digests
from staylens.llm.text import SLICE_ROWS

from .words import AWKWARD, awkward_docs

PIECES = [" ", "a", "b", " a", "ab", "ba", "aba", "bb", " ab", "abab", "b a", "\n"]


def best_score(coder, scores, text):
    @lru_cache(None)
    def rest(i):
        if i == len(text):
            return 0.0
        steps = [s + rest(i + len(p)) for p, s in scores.items() if text.startswith(p, i)]
        if text[i] not in coder.single:
            steps.append(coder.byte_score * len(text[i].encode()) + rest(i + 1))
        return max(steps)

    return rest(0)


def test_path_is_the_best_of_all():
    rng = random.Random(1)
    for cut in (len(PIECES), len(PIECES) - 1, len(PIECES) - 2):  # with and without pieces across the cuts
        vocabulary = Vocabulary(
            tuple((p, -float(rng.randint(1, 9)), k) for k, p in enumerate(PIECES[:cut])), tuple(range(100, 356))
        )
        coder = Coder(vocabulary)
        scores, by_id = {p: s for p, s, _ in vocabulary.pieces}, {k: s for _, s, k in vocabulary.pieces}
        for _ in range(400):
            text = "".join(rng.choices("ab a\né", k=rng.randint(1, 14)))
            ids = coder.encode(text).tolist()
            assert coder.decode(ids) == text
            assert abs(sum(by_id.get(i, coder.byte_score) for i in ids) - best_score(coder, scores, " " + text)) < 1e-9


def test_ids_are_those_of_the_model_file():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    coder = Coder(load_vocabulary())
    for text in ("the cat sat", "Größe  und\nmehr", "日本語 text", "▁ mark"):
        ids = coder.encode(text).tolist()
        assert coder.decode(ids) == text
        if "▁" not in text:
            assert model.decode(ids) == text


def test_round_trip_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    encoded = encode_texts(docs)
    assert encoded.columns == [*docs.columns, "token_ids"]
    texts = decode_texts(encoded).collect()
    assert sorted((r.text or "") for r in texts) == sorted((t or "") for _, t in AWKWARD)
    digests = piece_digests(docs).collect()
    assert len(digests) == len(AWKWARD) and all(r.restored for r in digests)
    assert {r.n_tokens for r in digests if r.doc_id in (2, 3)} == {0}
    assert piece_digests(docs.limit(0)).count() == 0


def test_round_trip_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert piece_digests(docs).filter("not restored").count() == 0


def test_ids_leave_a_batch_in_small_parts():
    coder = Coder(Vocabulary(tuple((p, -1.0, k) for k, p in enumerate(PIECES)), tuple(range(100, 356))))
    texts = ["a" * (i % 7) for i in range(3 * SLICE_ROWS + 5)] + [None]
    parts = list(_encoded(iter([pa.array(texts), pa.array([], pa.string())]), lambda: coder))
    assert [len(p) for p in parts] == [SLICE_ROWS] * 3 + [6]
    assert [ids for p in parts for ids in p.to_pylist()] == [coder.encode(t or "").tolist() for t in texts]
