import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from staylens.llm.token_counts import PATTERN, Counter, count_sections, load_ranks

from .words import AWKWARD, awkward_docs

ENCODING = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=load_ranks(), special_tokens={})


def naive_starts(text):
    """Character of each token's first byte, byte by byte."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    at, out = 0, []
    for token in ENCODING.encode_ordinary(text):
        out.append(owner[at])
        at += len(ENCODING.decode_single_token_bytes(token))
    return out


def test_lines_cover_every_token(spark):
    rows = count_sections(awkward_docs(spark)).collect()
    texts = [t or "" for _, t in AWKWARD]
    assert sum(r.n_tokens for r in rows) == sum(len(ENCODING.encode_ordinary(t)) for t in texts)
    odd = next(t for i, t in AWKWARD if i == 7)
    starts = naive_starts(odd)
    for r in rows:
        if r.doc_id == 7:
            assert r.n_tokens == sum(r.start <= s < r.stop for s in starts)
            assert r.stop == len(odd) or odd[r.stop - 1] == "\n"
    assert [(r.section, r.doc_tokens, r.n_tokens) for r in rows if r.doc_id == 2] == [(None, 0, 0)]
    assert count_sections(awkward_docs(spark).limit(0)).count() == 0


def test_own_sections_may_overlap_and_leave_gaps(spark):
    text = "Größe straße \U0001F600 tokenization crosses borders"
    borders = [(0, 4), (2, 9), (13, 14), (20, 25), (30, 20), (5, None), (0, len(text))]
    docs = spark.createDataFrame([(1, text, borders), (2, text, None), (3, None, [(0, 5)])], "doc_id int, text string, parts array<struct<start:int,stop:int>>")
    rows = count_sections(docs, sections="parts").collect()
    starts = naive_starts(text)
    got = [r.n_tokens for r in sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.section)]
    assert got == [sum(lo <= s < (lo if hi is None else hi) for s in starts) for lo, hi in borders]
    assert {(r.doc_id, r.section, r.n_tokens) for r in rows if r.doc_id > 1} == {(2, None, 0), (3, 0, 0)}


def test_documents_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sums = count_sections(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.first("doc_tokens").alias("d"))
    found = {r.doc_id: (r.n, r.d) for r in sums.collect()}
    want = {r.doc_id: len(ENCODING.encode_ordinary(r.text or "")) for r in docs.collect()}
    assert found == {i: (n, n) for i, n in want.items()}


def test_runs_apart_give_the_same_tokens():
    rng = random.Random(6)
    ranks = load_ranks()
    counters = [Counter(ranks, long_run=n) for n in (1, 2, 5)]
    for _ in range(3_000):
        text = "".join(rng.choice(["a", "é", "1", "!", "'s", " ", "  ", "\n", "\t", "\x85", "\u3000", "\x1c", "\r\n", " " * 9]) for _ in range(rng.randint(0, 14)))
        want = ENCODING.encode_ordinary(text)
        assert all(c.tokens(text) == want for c in counters), repr(text)


@pytest.mark.parametrize("run", [" ", "\n", "\t", " \n\t", "\u3000"])
def test_millions_of_blanks(run):
    counter = Counter(load_ranks())
    for text in (run * 1_000_000, "a" + run * 5_000_000 + "b"):
        tokens = counter.tokens(text)
        assert counter.encoding.decode_bytes(tokens) == text.encode()
        assert counter.starts(text)[-1] <= len(text)


def test_long_blanks_in_the_query(spark):
    docs = spark.createDataFrame([(1, " " * 20_000_000), (2, "a" + "\n" * 400_000 + "b")], "doc_id int, text string")
    rows = {r.doc_id: r for r in count_sections(docs).groupBy("doc_id", "doc_tokens").agg(F.sum("n_tokens").alias("n")).collect()}
    assert all(r.n == r.doc_tokens > 0 for r in rows.values())
