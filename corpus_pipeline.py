"""A training corpus from the documents: judge, drop copies, decontaminate, mask, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.decontaminate import drop_contaminated
from staylens.llm.pieces import encode_texts
from staylens.llm.pii import mask_pii
from staylens.llm.quality_model import drop_rejected
from staylens.llm.simhash import keep_one_of_each
from staylens.llm.text import read_table
from staylens.session import keep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_rejected(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_pii(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_texts(docs)
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

# Trained stages and Python coders have no SQL form; tests compare small runs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
