"""Personal data: fixed patterns plus a conditional random field over word shapes.

The patterns give the base spans. The field is trained from a small table of
labelled word windows, cut from a bounded sample of the texts around base spans
and completed by the rows of ``EXAMPLES``; it adds spans that the patterns miss
(joined card numbers, numbers without a country sign, broken punctuation).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.crf import LONG, Crf, Decoder, fit_crf, luhn, word_shape
from staylens.llm.text import in_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{place}-{kind}" for kind in KINDS for place in "BI")]

# Bounds of the labelled table.
SAMPLE_TEXTS = 3000
SAMPLE_WINDOWS = 1500
WINDOW_SIDE = 5
# How often each fixed row enters the table, so that rare forms count.
EXAMPLE_COPIES = 12

# Fixed rows of the labelled table: text, then kind and exact wording of each span.
EXAMPLES = (
    ("write to jane.doe@mail.example.org today", (("email", "jane.doe@mail.example.org"),)),
    ("mail <first_last+tag@example.com>, please", (("email", "first_last+tag@example.com"),)),
    ("ask j.smith@example.edu or lee@example.net for it", (("email", "j.smith@example.edu"), ("email", "lee@example.net"))),
    ("the host 10.0.12.7 answered twice", (("ip", "10.0.12.7"),)),
    ("from 192.168.1.20 to 172.16.254.1 only", (("ip", "192.168.1.20"), ("ip", "172.16.254.1"))),
    ("version 10.12.3 of the file 1.2 is out", ()),
    ("card 4111 1111 1111 1111 was used", (("card", "4111 1111 1111 1111"),)),
    ("card 5500-0000-0000-0004, then 378282246310005 again", (("card", "5500-0000-0000-0004"), ("card", "378282246310005"))),
    ("numbers 4111111111111111 5555555555554444 were listed", (("card", "4111111111111111"), ("card", "5555555555554444"))),
    ("call +1 (415) 555-2671 or +44 20 7946 0958 now", (("phone", "+1 (415) 555-2671"), ("phone", "+44 20 7946 0958"))),
    ("call (415) 555-2671 now", (("phone", "(415) 555-2671"),)),
    ("phone 415-555-2671 and 415.555.2671 work", (("phone", "415-555-2671"), ("phone", "415.555.2671"))),
    ("in 2019 there were 12 of 345 items, 1,250 in all", ()),
    ("the order 1234567 of 2021-04-05 at 10:30 came (3) late", ()),
    ("key 00ffab12cd34ef5678 and id 20240101123456 are no numbers to call", ()),
)

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# How words of more than LONG characters are cut, and pieces that stay as long: at
# marks and at borders between ASCII and other letters, with area codes in brackets
# kept; then at marks that do not join numbers; then at all marks.
_CUTS = (
    re.compile(r"(?:\+[0-9]{1,3})?\([0-9]{1,4}\)[0-9.-]+|[A-Za-z0-9._%+@-]+|[^\x00-\x7F]+"),
    re.compile(r"[0-9]+(?:[._%+-][0-9]+)+|[A-Za-z0-9@]+|[^\x00-\x7F]+"),
    re.compile(r"[A-Za-z0-9]+|[^\x00-\x7F]+"),
)
_EDGE = "\"'<>()[]{}.,;:!?*#%$&|"


def _emails(text: str):
    """Matches of local@domain from left to right; linear in the text's length."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [
        (m.start(), 1, m.end())
        for m in _IP.finditer(text)
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split(".")))
    ]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() < 64 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _pieces(text: str, start: int, end: int, cuts=_CUTS) -> Iterator[tuple[int, int]]:
    if end - start <= LONG or not cuts:
        yield start, end
    else:
        for m in cuts[0].finditer(text, start, end):
            yield from _pieces(text, *m.span(), cuts[1:])


def word_places(text: str) -> list[tuple[int, int]]:
    """Places of the words as the field takes them: unspaced runs in short pieces."""
    return [p for m in _WORD.finditer(text) for p in _pieces(text, *m.span())]


def field_words(text: str) -> list[bytes]:
    """The words at ``word_places``; cut one by one only where a word is long."""
    words = text.encode().split()
    if max(map(len, words), default=0) > LONG:
        words = [text[a:b].encode() for a, b in word_places(text)]
    return words


def tag_words(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], list[str], list[tuple[int, int]]]:
    """Words, their labels by the spans they touch, and their places."""
    words, tags, places, k, last = [], [], [], 0, -1
    for start, end in word_places(text):
        while k < len(spans) and spans[k][2] <= start:
            k += 1
        tag = "O"
        if k < len(spans) and spans[k][0] < end:
            tag = ("I-" if last == k else "B-") + KINDS[spans[k][1]]
            last = k
        words.append(text[start:end])
        tags.append(tag)
        places.append((start, end))
    return words, tags, places


def _card_like(word: str) -> bool:
    digits = re.sub(r"[^0-9]", "", word)
    return 14 <= len(digits) <= 19 and luhn(digits)


def labelled_windows(text: str) -> list[tuple[list[str], list[str]]]:
    """(shapes, labels) around every base span, and the first words of the text.

    A window with an unlabelled number that passes the card check is left out:
    whether it is one is what the field has to find out.
    """
    words, tags, _ = tag_words(text, base_spans(text))
    marked = [i for i, t in enumerate(tags) if t[0] == "B"]
    windows = [(0, 2 * WINDOW_SIDE)] + [(max(0, i - WINDOW_SIDE), i + WINDOW_SIDE) for i in marked]
    out = []
    for lo, hi in windows:
        part = words[lo:hi], tags[lo:hi]
        if not any(t == "O" and _card_like(w) for w, t in zip(*part)):
            out.append(([word_shape(w) for w in part[0]], part[1]))
    return out


def labelled_table(docs: DataFrame, doc_id: str, text: str) -> list[tuple[list[str], list[str]]]:
    """At most SAMPLE_WINDOWS windows of about SAMPLE_TEXTS texts, and EXAMPLES."""
    total = docs.count()
    share = min(1.0, SAMPLE_TEXTS / max(total, 1))
    order = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 30))
    sample = docs.filter(order < int(share * (1 << 30))).select(order.alias("at"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            rows = [
                (at, n, *window)
                for at, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for n, window in enumerate(labelled_windows(t or ""))
            ]
            columns = list(zip(*rows)) or [[], [], [], []]
            types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, ["at", "n", "shapes", "labels"])

    windows = sample.mapInArrow(run, "at bigint, n bigint, shapes array<string>, labels array<string>")
    # Half with spans and half without, in a repeatable order.
    plain = F.forall("labels", lambda t: t == "O").cast("int")
    rows = windows.filter(plain == 0).orderBy("at", "n").limit(SAMPLE_WINDOWS // 2).collect()
    rows += windows.filter(plain == 1).orderBy("at", "n").limit(SAMPLE_WINDOWS // 2).collect()
    table = [(list(r.shapes), list(r.labels)) for r in rows]
    for line, wanted in EXAMPLES:
        spans, at = [], 0
        for kind, words in wanted:
            at = line.index(words, at)
            spans.append((at, KINDS.index(kind), at + len(words)))
            at += len(words)
        words, tags, _ = tag_words(line, spans)
        table += [([word_shape(w) for w in words], tags)] * EXAMPLE_COPIES
    return table


def plausible(kind: int, wording: str) -> bool:
    """Whether an added span can be of its kind at all; keeps stray numbers clean."""
    digits = re.sub(r"[^0-9]", "", wording)
    if kind == 0:
        return "@" in wording[1:-1]
    if kind == 1:
        parts = re.findall(r"[0-9]+", wording)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _added(text: str, base: list[tuple[int, int, int]], tagged) -> list[tuple[int, int, int]]:
    """Spans of the field that touch no base span, without marks at their edges."""
    at, labels = tagged
    if not len(at):
        return []
    places = word_places(text)
    runs: list[list[int]] = []
    for i, label in zip(at.tolist(), labels.tolist()):
        kind, begins = (label - 1) // 2, label % 2 == 1
        # Pieces of one word are parted by marks or by nothing, words by blanks.
        begins = begins or not text[places[i - 1][1] : places[i][0]].isspace()
        if runs and not begins and runs[-1][2] == i - 1 and runs[-1][0] == kind:
            runs[-1][2] = i
        else:
            runs.append([kind, i, i])
    out = []
    for kind, first, last in runs:
        start, end = places[first][0], places[last][1]
        while start < end and text[start] in _EDGE and text[start] != "(":
            start += 1
        while end > start and text[end - 1] in _EDGE:
            end -= 1
        free = all(e <= start or s >= end for s, _, e in base)
        if start < end and free and plausible(kind, text[start:end]):
            out.append((start, kind, end))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its kind."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _finder(model: Crf, masking: bool):
    decoders: list[Decoder] = []

    def find(batches):
        if not decoders:
            decoders.append(Decoder(model))
        # Word lists and results of a few texts at a time keep the memory of a batch small.
        for column in in_slices(batches):
            rows, texts = [], [t or "" for t in column.to_pylist()]
            for text, tagged in zip(texts, decoders[0].tag([field_words(t) for t in texts])):
                base = base_spans(text)
                spans = sorted(base + _added(text, base, tagged))
                counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*counts, digest, listed(spans), masked(text, spans) if masking else None))
            names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked"]
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.StructArray.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    return find


_RESULT = "struct<n_email:bigint,n_ip:bigint,n_card:bigint,n_phone:bigint,base_sha256:string,spans:string,masked:string>"


def pii_of(text: Column, model: Crf, masking: bool = False) -> Column:
    """Counts, digest and spans of a text column as one struct."""
    find = _finder(model, masking)

    @F.arrow_udf(_RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return find(batches)

    return scan(text)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Crf:
    return fit_crf(labelled_table(docs, doc_id, text), LABELS)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; a row per row.

    The counts and the digest cover the base spans; ``spans`` lists base and added
    ones by start, as kind:start:end in code points. NULL and empty texts have
    none. Repeated rows repeat; other columns are not read. An empty table gives
    an empty result.
    """
    model = train(docs, doc_id, text)
    found = docs.select(F.col(doc_id).alias("doc_id"), pii_of(F.col(text), model).alias("pii"))
    return found.select("doc_id", *(f"pii.n_{k}" for k in KINDS), "pii.base_sha256", "pii.spans")


def mask_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns and every found span replaced by [KIND]; NULL stays NULL."""
    model = train(docs, doc_id, text)
    clean = F.when(F.col(text).isNotNull(), pii_of(F.col(text), model, masking=True)["masked"])
    return docs.withColumn(text, clean)
