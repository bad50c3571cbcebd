import corpus_pipeline
from staylens.llm import pii
from staylens.llm.decontaminate import decontaminate
from staylens.llm.pieces import decode_texts
from staylens.llm.quality_model import score_quality
from staylens.llm.simhash import simhash_components
from staylens.llm.text import read_table
from staylens.session import keep

from .words import awkward_docs

SF = "/root/testdata/sf0.01"


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_each_stage_keeps_what_its_operator_says(spark):
    docs = read_table(spark, SF, "documents")
    good = keep(corpus_pipeline.quality(spark, docs, SF), "t")
    assert good.columns == docs.columns
    want = score_quality(docs, read_table(spark, SF, "labels")).filter("predicted = 1")
    assert len(set(ids(good)) ^ set(ids(want))) <= 0.005 * docs.count()

    single = keep(corpus_pipeline.near_copies(spark, good, SF), "t")
    assert single.columns == docs.columns
    assert ids(single) == ids(simhash_components(good).filter("doc_id = component_id"))

    clean = keep(corpus_pipeline.decontamination(spark, single, SF), "t")
    assert clean.columns == docs.columns
    assert ids(clean) == ids(decontaminate(single, read_table(spark, SF, "benchmark")).filter("not contaminated"))

    masked = keep(corpus_pipeline.personal_data(spark, clean, SF), "t")
    assert masked.columns == docs.columns and ids(masked) == ids(clean)
    assert all(not pii.base_spans(r.text) and r.n_chars == len(r.text) for r in masked.collect())

    coded = keep(corpus_pipeline.pieces(spark, masked, SF), "t")
    back = {r.doc_id: r.text for r in decode_texts(coded).collect()}
    assert back == {r.doc_id: r.text for r in masked.collect()}


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward_docs(spark), awkward_docs(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, SF)
            assert left.columns == docs.columns, name
            assert left.count() <= docs.count()
        assert corpus_pipeline.pieces(spark, docs, SF).count() == docs.count()


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"] and out.count() > 100
