"""Small text and table helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Everything that is neither a digit, a-z nor outside ASCII separates item words.
ITEM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.01
# Texts that a Python function holds results of; a batch of Spark may have thousands.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column, separators: str) -> Column:
    """Words between ``separators``; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def item_words(text: Column) -> Column:
    return split_words(lower_ascii(text), ITEM_SEPARATORS)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def count_matching(text: Column, pattern: str) -> Column:
    """Number of characters of ``text`` inside matches of ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def crc_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def in_slices(batches: Iterable[pa.Array], rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """The batches in parts of at most ``rows`` rows, so that results leave a worker part by part."""
    for batch in batches:
        for low in range(0, len(batch), rows):
            yield batch.slice(low, rows)


def fits_broadcast(size: int) -> bool:
    return size <= BROADCAST_BYTES


def text_bytes(df: DataFrame, text: Column, per_row: int) -> int:
    """Counted bytes of a table with one text and ``per_row`` bytes besides."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) + F.count(F.lit(1)) * per_row).first()[0]


def lookup_join(facts: DataFrame, lookup: DataFrame, on, how: str, rows: int, row_bytes: int) -> DataFrame:
    """Join with ``lookup``, broadcast only where its counted size is below the bound.

    Beyond the bound both sides shuffle; adaptive execution splits hot keys.
    """
    side = F.broadcast(lookup) if fits_broadcast(rows * row_bytes) else lookup
    return facts.join(side, on, how)
