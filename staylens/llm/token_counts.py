"""Token counts per section by offset-mapped attribution.

A whole document is encoded once, so merges across section borders are those a
model would see. Token byte lengths give every token's place, bytes are mapped
to characters, and the sorted token starts are joined with the section intervals
by binary search.

Allocation rule: a token belongs to the section that holds the character its
first byte is part of, also where it runs over the section's end. Sections may
overlap or leave gaps; each counts what starts in it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The split pattern these ranks were made with (a fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Runs of so many blanks are encoded outside the pattern, whose look-ahead steps
# back through them one by one. These are the characters that its \s stands for.
LONG_RUN = 1_000
_BLANKS = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

SECTIONS = "array<struct<start:bigint,stop:bigint,n_tokens:bigint>>"


def load_ranks(path: str = RANKS_PATH) -> dict[bytes, int]:
    """Read a rank file on the driver; its size bounds what is broadcast."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Counter:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, long_run: int = LONG_RUN):
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("runs", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.runs = re.compile(f"{_BLANKS}{{{long_run},}}") if pattern == PATTERN else None
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def tokens(self, text: str) -> list[int]:
        """Token ids of the whole text.

        The pattern cuts a run of blanks before its last one, or after the run where
        the text ends, and never across its start. So a long run is one piece of its
        own, and what is before and after it can be encoded apart.
        """
        out, at = [], 0
        for m in self.runs.finditer(text) if self.runs else ():
            stop = m.end() - (m.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : m.start()])
            out += self.whole.encode_ordinary(text[m.start() : stop])
            at = stop
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def starts(self, text: str) -> np.ndarray:
        """Character in which each token of the whole text starts, ascending."""
        ids = np.array(self.tokens(text), np.int64)
        sizes = self.sizes[ids]
        at = np.cumsum(sizes) - sizes
        raw = text.encode()
        if len(raw) == len(text):
            return at
        characters = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
        return characters[at]

    def count(self, text: str, lows: np.ndarray, highs: np.ndarray) -> tuple[int, np.ndarray]:
        """Tokens of the text, and of each section [low, high)."""
        starts = self.starts(text)
        inside = np.searchsorted(starts, highs) - np.searchsorted(starts, lows)
        return len(starts), np.maximum(inside, 0)


def line_borders(text: str) -> np.ndarray:
    """Starts of the lines, each with its line feed, and the end of the text."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 10) + 1
    return np.unique(np.r_[0, ends, len(text)])


def count_sections(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sections: str | None = None,
    path: str = RANKS_PATH,
    pattern: str = PATTERN,
) -> DataFrame:
    """Rows (doc_id, doc_tokens, section, start, stop, n_tokens), section from 0.

    ``sections`` names an array column of structs with ``start`` and ``stop`` in
    code points; without it the sections are the lines, which cover every token.
    A NULL section list, a NULL or an empty text has no sections and still gives
    one row with NULL section and no tokens in it. NULL or reversed borders give
    an empty section. Repeated rows repeat; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    counters: list[Counter] = []

    def counted(texts, borders):
        if not counters:
            counters.append(Counter(shared.value, pattern))
        totals, offsets, lows, highs, counts = [], [0], [], [], []
        for n, t in enumerate(texts):
            wording = t.as_py() or ""
            if borders is None:
                edges = line_borders(wording)
                low, high = edges[:-1], edges[1:]
            else:
                rows = [r or {"start": None, "stop": None} for r in borders[n].as_py() or []]
                low = np.array([r["start"] or 0 for r in rows], np.int64)
                high = np.array([low[i] if r["stop"] is None else r["stop"] for i, r in enumerate(rows)], np.int64)
            total, inside = counters[0].count(wording, low, high)
            totals.append(total)
            offsets.append(offsets[-1] + len(low))
            lows.append(low)
            highs.append(high)
            counts.append(inside)
        flat = [np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64) for c in (lows, highs, counts)]
        structs = pa.StructArray.from_arrays([pa.array(c) for c in flat], ["start", "stop", "n_tokens"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
        return pa.StructArray.from_arrays([pa.array(totals, pa.int64()), lists], ["doc_tokens", "sections"])

    kind = f"struct<doc_tokens:bigint,sections:{SECTIONS}>"
    if sections is None:

        @F.arrow_udf(kind)
        def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield counted(texts, None)

        found = count(F.col(text))
    else:

        @F.arrow_udf(kind)
        def count_in(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, borders in batches:
                yield counted(texts, borders)

        places = F.transform(
            F.col(sections), lambda s: F.struct(s["start"].cast("bigint").alias("start"), s["stop"].cast("bigint").alias("stop"))
        )
        found = count_in(F.col(text), places)
    rows = docs.select(F.col(doc_id).alias("doc_id"), found.alias("f"))
    rows = rows.select("doc_id", F.col("f.doc_tokens").alias("doc_tokens"), F.posexplode_outer("f.sections").alias("section", "s"))
    return rows.select("doc_id", "doc_tokens", "section", "s.start", "s.stop", F.coalesce("s.n_tokens", F.lit(0)).alias("n_tokens"))
