"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit tells the
languages with a one from those with a zero by character n-grams. A text's bit
margins are compared with all codewords under the logistic loss, each bit
weighted by how well it separates the languages; the nearest codeword wins and a
close second flags the text as ambiguous.

The classifiers need only n-gram counts per language. Those are summed over all
training texts by mergeable partial counts, so no text is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.text import crc_remainder

BUCKETS = 1 << 13
SIZES = (2, 3)
SMOOTHING = 0.5
SHARPNESS = 6.0
# This many n-grams without evidence are added, so short texts stay less certain.
PRIOR = 20
AMBIGUOUS = 0.15
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2
# Up to this many languages all useful columns are used, then random ones.
EXHAUSTIVE = 6
RANDOM_BITS = 8  # times the bits needed to number the languages
SEED = 7
# Languages whose counts one task holds before it passes them on.
HELD_LANGUAGES = 256
# Characters hashed at a time.
CHUNK = 1 << 20

_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point to its lower-case letter, 32 for everything that is no letter."""
    if not _fold:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            char = chr(c)
            if char.isalpha():
                table[c] = ord(char.lower()[0])
        _fold.append(table)
    return _fold[0]


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the whole text, in pieces of bounded size.

    Letters are lower-cased, runs of other characters count as one blank, and
    n-grams are taken of the text with a blank on both sides.
    """
    table = fold_table()
    for at in range(0, len(text), CHUNK):
        # Pieces overlap by the longest n-gram so that none is lost or repeated.
        part = text[max(0, at - max(SIZES) + 1) : at + CHUNK]
        codes = table[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.uint64)
        lead = min(at, max(SIZES) - 1)
        first, last = at == 0, at + CHUNK >= len(text)
        codes = np.r_[[np.uint64(32)] * first, codes, [np.uint64(32)] * last].astype(np.uint64)
        for n in SIZES:
            begin = max(0, lead - n + 1)
            window = codes[begin:]
            if len(window) < n:
                continue
            key = np.zeros(len(window) - n + 1, np.uint64)
            letters = np.zeros(len(key), bool)
            for i in range(n):
                column = window[i : len(window) - n + 1 + i]
                key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
                letters |= column != 32
            yield (key[letters] & np.uint64(BUCKETS - 1)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Columns lang, bucket, n over all given texts."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            for name, counts in held.items():
                at = np.flatnonzero(counts)
                columns = [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for name, t in zip(batch.column(0), batch.column(1)):
                counts = held.setdefault(name.as_py(), np.zeros(BUCKETS, np.int64))
                for part in ngrams(t.as_py() or ""):
                    counts += np.bincount(part, minlength=BUCKETS)
                if len(held) > HELD_LANGUAGES:
                    yield from flush()
        yield from flush()

    narrow = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    partial = narrow.mapInArrow(run, "lang string, bucket bigint, n bigint")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(count: int) -> np.ndarray:
    """One row of -1/1 per language; columns differ and separate some languages."""
    if count <= 1:
        return np.ones((count, 1))
    if count <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in product((1, -1), repeat=count - 1)]
        return np.array([c for c in columns if min(c) < 0], float).T
    rng = np.random.default_rng(SEED)
    bits = RANDOM_BITS * int(np.ceil(np.log2(count)))
    while True:
        code = rng.choice([-1.0, 1.0], (count, bits))
        code[:, np.all(code == code[0], axis=0)] *= np.where(np.arange(count) % 2, -1, 1)[:, None]
        if len(np.unique(code, axis=0)) == count:
            return code


@dataclass
class LanguageCodes:
    names: list[str]
    code: np.ndarray
    weights: np.ndarray  # bucket x bit: log odds of the bit being one
    bit_weights: np.ndarray

    def margins(self, text: str) -> np.ndarray | None:
        """Mean log odds per bit over all n-grams and PRIOR neutral ones; None without any."""
        total, n = np.zeros(self.code.shape[1]), 0
        for part in ngrams(text):
            if len(part):
                total += np.bincount(part, minlength=BUCKETS) @ self.weights
                n += len(part)
        return total / (n + PRIOR) if n else None

    def decide(self, text: str) -> tuple[str, float, bool]:
        """Language, its share of the codewords' likelihoods, and a close second."""
        margins = self.margins(text) if self.names and has_letter(text) else None
        if margins is None:
            return UNDETERMINED, 0.0, True
        losses = np.logaddexp(0, -SHARPNESS * self.code * margins) @ self.bit_weights
        odds = np.exp(losses.min() - losses)
        shares = odds / odds.sum()
        best = int(losses.argmin())
        second = np.partition(shares, -2)[-2] if len(shares) > 1 else 0.0
        return self.names[best], float(shares[best]), bool(shares[best] - second < AMBIGUOUS)


def fit_codes(counts: DataFrame) -> LanguageCodes:
    """From n-gram counts: at most BUCKETS rows per language reach the driver."""
    rows = counts.toPandas()
    names = sorted(rows["lang"].unique())
    table = np.zeros((len(names), BUCKETS))
    table[[names.index(x) for x in rows["lang"]], rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    rates = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    code = codewords(len(names))
    weights = np.zeros((BUCKETS, code.shape[1]))
    spread = np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        one, zero = code[:, bit] > 0, code[:, bit] < 0
        if one.any() and zero.any():
            weights[:, bit] = np.log(rates[one].mean(axis=0)) - np.log(rates[zero].mean(axis=0))
            # Mean margin of the languages towards their own side.
            spread[bit] = (code[:, bit] * (rates @ weights[:, bit])).mean()
    spread = np.maximum(spread, 1e-6)
    return LanguageCodes(names, code, weights, len(spread) * spread / spread.sum())


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score, ambiguous; a row per row of ``docs``.

    Learns from texts with a language whose id is not in the held-out quarter;
    only the text enters a prediction. A text that is NULL or has no letter is
    "und" with score 0, as is every text where nothing could be learned. Equal
    scores go to the language first by name. Repeated rows repeat.
    """
    held_out = crc_remainder(F.col(doc_id), FOLDS) == HELD_OUT
    model = fit_codes(ngram_counts(docs.filter(~held_out & F.col(lang).isNotNull()), lang, text))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = list(zip(*(shared.value.decide(t.as_py() or "") for t in texts))) or [[], [], []]
            arrays = [pa.array(list(c), t) for c, t in zip(found, (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(arrays, ["lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), decide(F.col(text)).alias("d"))
    return rows.select("doc_id", "held_out", "d.*")
