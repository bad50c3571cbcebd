"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of 13 consecutive words. A window can only occur in
a document that holds all its shingles, so one necessary prefix shingle per
window is enough to find every candidate. Shingles are ordered by how often they
occur in the whole corpus and the rarest one becomes the prefix. The place of
the shingle in the window fixes where the window would have to start (positional
bound) and the window's length must fit the document (length bound). What
remains is compared word by word, so hash collisions never count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.bloom import BLOCK_BYTES, block_count, build_bloom, probe_bloom
from staylens.llm.text import fits_broadcast, item_words, lookup_join, text_bytes
from staylens.session import keep

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
HIT_SHARE = 20  # contaminated from one word in twenty

TOTAL_KEY = 0


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW_WORDS) -> DataFrame:
    """Rows (words, item_id): ``window`` consecutive words, or all of a shorter item."""
    words = items.select(F.col(id_col).alias("item_id"), item_words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (
        words.select("item_id", "w", F.explode(starts).alias("at"))
        .select(F.slice("w", F.col("at") + 1, window).alias("words"), "item_id")
        .distinct()
    )


def _size(words: str) -> Column:
    return F.least(F.size(words), F.lit(SHINGLE_WORDS))


def _shingle(words: str, at: Column, size: Column) -> Column:
    """Hash of the shingle of ``size`` words; words past its end do not enter."""
    parts = [F.when(F.lit(i) < size, F.get(words, at + i)) for i in range(SHINGLE_WORDS)]
    return F.xxhash64(size, *parts)


def _shingle_rows(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per document and shingle, plus one row at -1 that carries its totals.

    The word array rides along by reference inside the generated code; only rows
    that meet the window table are ever copied.
    """
    places = F.explode(F.sequence(F.lit(-1), F.size("w") - 1))
    rows = docs.select("*", places.alias("at"))
    if len(sizes) == 1:
        return rows.withColumn("size", F.lit(sizes[0]))
    return rows.select("*", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"))


def rarest_prefix(windows: DataFrame, docs: DataFrame, sizes: list[int]) -> DataFrame:
    """For each window the shingle that occurs least often in ``docs`` (w = words)."""
    candidates = windows.select("window_id", "words", _size("words").alias("size"))
    candidates = candidates.select(
        "*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("offset")
    )
    candidates = candidates.select("window_id", "offset", _shingle("words", F.col("offset"), F.col("size")).alias("key"))
    candidates = keep(candidates, "window-shingles")
    vocabulary = candidates.select("key").distinct()
    n = vocabulary.count()
    rows = _shingle_rows(docs, sizes).filter(F.col("at") >= 0)
    keys = rows.select(_shingle("w", F.col("at"), F.col("size")).alias("key"))
    if fits_broadcast(16 * n):
        counts = keys.join(F.broadcast(vocabulary), "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "key")
    order = Window.partitionBy("window_id").orderBy(F.coalesce("n", F.lit(0)), "offset")
    return (
        candidates.join(counts, "key", "left")
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .select("window_id", "offset", "key")
    )


def _covered(spans: Column) -> Column:
    """Number of words inside the union of (start, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    merged = F.aggregate(
        F.array_sort(spans),
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], s["stop"]).alias("upto"),
        ),
    )
    return merged["n"]


def _start() -> Column:
    return F.col("at") - F.col("offset")


def _hits_in_place(worded: DataFrame, table: DataFrame, sizes: list[int], carry: tuple[str, ...]) -> DataFrame:
    """doc_id, carry, n_words, spans, found: every place meets the broadcast windows.

    The row at -1 of every document meets one row without a window. A shingle whose
    hash is 0 meets it too and only repeats the document's total.
    """
    total = table.sparkSession.range(1).select(
        F.lit(TOTAL_KEY).cast("bigint").alias("key"),
        F.lit(None).cast("bigint").alias("window_id"),
        F.lit(None).cast("int").alias("offset"),
        F.lit(None).cast("array<string>").alias("words"),
    )
    rows = _shingle_rows(worded.withColumn("row", F.monotonically_increasing_id()), sizes)
    rows = rows.withColumn(
        "key", F.when(F.col("at") < 0, F.lit(TOTAL_KEY)).otherwise(_shingle("w", F.col("at"), F.col("size")))
    )
    start, length = _start(), F.size("words")
    fits = (start >= 0) & (start + length <= F.size("w"))
    same = F.slice("w", F.greatest(start, F.lit(0)) + 1, length) == F.col("words")
    met = (
        rows.join(F.broadcast(table.unionByName(total)), "key")
        .filter(F.col("window_id").isNull() | (fits & same))
        .select("row", "doc_id", *carry, F.size("w").alias("n_words"), "window_id", start.alias("start"), (start + length).alias("stop"))
    )
    per_doc = met.groupBy("row", "doc_id", *carry).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("window_id").isNotNull(), F.struct("start", "stop"))).alias("spans"),
        F.collect_set("window_id").alias("found"),
    )
    return per_doc.drop("row")


def _hits_by_shuffle(
    named: DataFrame, table: DataFrame, windows: DataFrame, sizes: list[int], carry: tuple[str, ...]
) -> DataFrame:
    """The same for a window table of any size; words never travel with a place.

    Places that pass a Bloom filter of the prefix keys (where that filter fits a
    broadcast) shuffle as (document hash, place, key). Texts of documents with a
    candidate are then joined once and compared word by word. Documents with equal id
    and text share a result; should two others share the hash, each is compared itself.
    """
    ids = F.xxhash64("doc_id", "_text").alias("h")
    own = F.xxhash64("_text", F.lit(1)).alias("t")
    worded = named.select(ids, item_words(F.col("_text")).alias("w"))
    places = _shingle_rows(worded, sizes).filter(F.col("at") >= 0)
    places = places.select("h", "at", _shingle("w", F.col("at"), F.col("size")).alias("key"))
    keys = keep(table.select("key", "window_id", "offset", F.size("words").alias("length")), "prefix-table")
    blocks = block_count(keys.count())
    if fits_broadcast(blocks * BLOCK_BYTES):
        bloom = build_bloom(keys.select("key").distinct(), "key", blocks)
        places = probe_bloom(places, "key", bloom, blocks).filter("possible").drop("possible")
    candidates = places.join(keys, "key").filter(_start() >= 0).select("h", F.struct("window_id", _start().alias("start"), "length").alias("c"))
    candidates = keep(candidates.groupBy("h").agg(F.collect_set("c").alias("c")), "candidates")
    holders = lookup_join(named.select(ids, own, "_text"), candidates.select("h"), "h", "left_semi", candidates.count(), 24)
    holders = holders.dropDuplicates(["h", "t"]).join(candidates, "h").withColumn("w", item_words(F.col("_text")))
    # Each place takes only its own words along.
    fitting = F.filter("c", lambda c: c["start"] + c["length"] <= F.size("w"))
    cut = F.transform(fitting, lambda c: F.struct(c["window_id"].alias("window_id"), c["start"].alias("start"), F.slice("w", c["start"] + 1, c["length"]).alias("words")))
    checked = holders.select("h", "t", F.explode(cut).alias("x")).select("h", "t", "x.*").join(windows, ["window_id", "words"])
    hits = checked.groupBy("h", "t").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.size("words")).alias("stop"))).alias("spans"), F.collect_set("window_id").alias("found")
    )
    hits = keep(hits, "document-hits")
    size = F.size(item_words(F.col("_text"))).cast("long").alias("n_words")
    rows = named.select("doc_id", *carry, ids, own, size)
    # The spans of the documents with a hit: 16 bytes each.
    width = text_bytes(hits, F.lit(""), 64) + 32 * (hits.agg(F.sum(F.size("spans") + F.size("found"))).first()[0] or 0)
    side = F.broadcast(hits) if fits_broadcast(width) else hits
    none = (F.array().cast(hits.schema[n].dataType) for n in ("spans", "found"))
    spans, found = (F.coalesce(F.col(n), e).alias(n) for n, e in zip(("spans", "found"), none))
    return rows.join(side, ["h", "t"], "left").select("doc_id", *carry, "n_words", spans, found)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    hit_share: int = HIT_SHARE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: how much of it stems from ``items``.

    Columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the
    narrow columns of ``docs`` named in ``carry``. NULL or
    empty texts have no words and are clean. An item without words is ignored; an
    item without an id hits words but is not counted or listed. Repeated
    documents each get a row, repeated items count once, and other columns of
    either table are not read. An empty table of items leaves everything clean.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), *carry, F.col(text).alias("_text"))
    worded = named.select("doc_id", *carry, item_words(F.col("_text")).alias("w"))
    cut = keep(item_windows(items, item_id, item_text, window), "item-windows")
    windows = keep(cut.select("words").distinct().withColumn("window_id", F.monotonically_increasing_id()), "windows")
    listed = keep(
        cut.filter(F.col("item_id").isNotNull()).join(windows, "words").select("window_id", "item_id"), "listed"
    )
    # At most SHINGLE_WORDS different sizes.
    sizes = sorted(r[0] for r in windows.select(_size("words")).distinct().collect()) or [SHINGLE_WORDS]
    prefixes = keep(rarest_prefix(windows, worded, sizes), "prefixes")
    table = prefixes.join(windows, "window_id").select("key", "window_id", "offset", "words")
    # A word in the broadcast table takes some 16 bytes besides its text.
    if fits_broadcast(text_bytes(windows, F.array_join("words", " "), 64 + 16 * window)):
        per_doc = _hits_in_place(worded, table, sizes, carry)
    else:
        per_doc = _hits_by_shuffle(named, table, windows, sizes, carry)
    per_doc = keep(per_doc.withColumn("row", F.monotonically_increasing_id()), "hits")
    found = per_doc.filter(F.size("found") > 0).select("row", F.explode("found").alias("window_id"))
    named_items = (
        lookup_join(found, listed, "window_id", "inner", listed.count(), 32)
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    out = per_doc.join(named_items, "row", "left").select(
        "doc_id",
        *carry,
        "n_words",
        F.when(F.size("spans") > 0, _covered(F.col("spans"))).otherwise(F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
    )
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * hit_share >= F.col("n_words"))
    return out.withColumn("contaminated", bad)


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay.

    Rows are told apart by id and text, so of two texts with one id only the
    contaminated one goes.
    """
    key = F.xxhash64(F.col(text)).alias("_text_hash")
    judged = decontaminate(docs.select(doc_id, text, key), items, doc_id, text, carry=("_text_hash",), **names)
    bad = keep(judged.filter("contaminated").select(F.col("doc_id").alias("_contaminated_id"), F.col("_text_hash").alias("_contaminated_hash")).distinct(), "contaminated")
    same = F.col(doc_id).eqNullSafe(F.col("_contaminated_id")) & (F.xxhash64(F.col(text)) == F.col("_contaminated_hash"))
    return lookup_join(docs, bad, same, "left_anti", bad.count(), 48)
