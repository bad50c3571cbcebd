"""A trie of shared conversation beginnings, from ternary search trees per range shard.

Conversations become sequences of turn tokens, equal sequences are counted, and the
distinct ones are dealt in contiguous ranges. A shard numbers its tokens, inserts its
sequences by medians into a ternary search tree and sums members, leaves and savings
bottom up. Only beginnings of a shard's first or last sequence can lie in another
shard too; those boundary nodes are merged afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.text import lookup_join
from staylens.session import keep

BASE_EVERY, SHARED_TURNS = 100, 6
# A token: 16 bytes of the SHA-256 of role and text, 4 bytes for the code points of the text.
TOKEN, DIGEST = 20, 16
# Ids that differ in these low bits only are joined into one text before the end digests are streamed.
ID_BITS = 8
NO_ENDS = hashlib.sha256(b"").hexdigest()
NIL = -1


def turn_token(role: Column, text: Column) -> Column:
    """Fixed-width key of a turn; equal tokens are equal roles and texts."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(F.length(text).cast("bigint")), 8, "0")))


def _joined(tokens: Column) -> Column:
    return F.unhex(F.array_join(F.transform(tokens, lambda t: F.hex(t)), ""))


def rebuilt_sequences(turns: DataFrame, base_every: int = BASE_EVERY, shared: int = SHARED_TURNS) -> DataFrame:
    """Columns conv_id, seq: the tokens of every rebuilt conversation, joined.

    ``turns`` has conv_id, turn, role, text. The first h turns come from the base
    conversation (h = crc32 of the id modulo ``shared``), the rest are the
    conversation's own after its first h.
    """
    tokens = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", turn_token(F.col("role"), F.col("text")).alias("token"))
    own = keep(tokens.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "token"))).alias("turns")), "turn-tokens")
    own = own.select("conv_id", F.col("turns.token").alias("tokens"))
    base = own.filter(F.col("conv_id") % base_every == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("tokens", 1, shared - 1).alias("first")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    led = own.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % base_every, "h": h}).join(base, "base_id", "left")
    none = F.array().cast("array<binary>")
    lead = F.when(F.col("h") > 0, F.slice(F.coalesce("first", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
    rest = F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens"), F.lit(1)))
    return led.select("conv_id", _joined(F.concat(lead, rest)).alias("seq"))


def _end_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """SHA-256 over the id blocks of each sequence, which arrive sorted."""
    key, digest, total, least = None, None, 0, None
    for batch in batches:
        for k, ids, n, first in zip(*(batch.column(c).to_pylist() for c in ("key", "ids", "n", "least"))):
            if k != key:
                if key is not None:
                    yield key, total, least, digest.hexdigest()
                key, digest, total, least = k, hashlib.sha256(), 0, first
            else:
                digest.update(b",")
            digest.update(ids.encode())
            total += n
    if key is not None:
        yield key, total, least, digest.hexdigest()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(_end_rows(batches), ["key", "n", "least", "ends"], [pa.binary(), pa.int64(), pa.int64(), pa.string()])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """Columns seq, n, least, ends: every distinct sequence with its conversations.

    Ids are joined in blocks of 256 and then streamed in order through one
    digest, so a sequence that very many conversations share is never held at once.
    """
    rows = keep(sequences.withColumn("key", F.unhex(F.sha2("seq", 256))), "sequences")
    block = F.shiftright("conv_id", ID_BITS)
    blocks = rows.groupBy("key", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = blocks.select(
        "key", "block", F.array_join("ids", ",").alias("ids"), F.size("ids").cast("bigint").alias("n"), F.array_min("ids").alias("least")
    )
    ended = joined.repartition("key").sortWithinPartitions("key", "block").select("key", "ids", "n", "least")
    ends = ended.mapInArrow(_end_digests, "key binary, n bigint, least bigint, ends string")
    unique = rows.groupBy("key").agg(F.first("seq").alias("seq"))
    return unique.join(ends, "key").select("seq", "n", "least", "ends")


class TernaryTree:
    """Ternary search tree over numbered tokens; every node is one node of the trie.

    ``low`` and ``high`` lead to smaller and larger tokens of the same parent,
    ``equal`` to the first child. Node 0 is the textless root.
    """

    def __init__(self):
        self.token, self.low, self.high, self.equal, self.parent = [NIL], [NIL], [NIL], [NIL], [NIL]

    def _new(self, token: int, parent: int) -> int:
        for links, value in ((self.token, token), (self.low, NIL), (self.high, NIL), (self.equal, NIL), (self.parent, parent)):
            links.append(value)
        return len(self.token) - 1

    def child(self, parent: int, token: int) -> int:
        at = self.equal[parent]
        if at == NIL:
            self.equal[parent] = self._new(token, parent)
            return self.equal[parent]
        while self.token[at] != token:
            side = self.low if token < self.token[at] else self.high
            if side[at] == NIL:
                side[at] = self._new(token, parent)
                return side[at]
            at = side[at]
        return at

    def insert(self, tokens: list[int]) -> int:
        at = 0
        for token in tokens:
            at = self.child(at, token)
        return at

    def insert_sorted(self, sequences: list[list[int]]) -> list[int]:
        """End node of each of the sorted ``sequences``; medians go first, so siblings balance."""
        ends = [0] * len(sequences)
        ranges = [(0, len(sequences))]
        while ranges:
            low, high = ranges.pop()
            if low < high:
                middle = (low + high) // 2
                ends[middle] = self.insert(sequences[middle])
                ranges += [(low, middle), (middle + 1, high)]
        return ends

    def bottom_up(self) -> range:
        """Nodes in an order that has every child before its parent."""
        return range(len(self.token) - 1, -1, -1)


def _tokens(seq: bytes) -> list[bytes]:
    return [seq[i : i + TOKEN] for i in range(0, len(seq), TOKEN)]


def _node_key(parent: bytes, token: bytes) -> bytes:
    return hashlib.sha256(parent + token).digest()


SHARD = (
    "edge boolean, node binary, up binary, points bigint, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
OUT_ROWS = 10_000
_SHARD_TYPES = [pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]


def _batches(rows, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def shard_nodes(sequences: list[bytes], counts: list[int], least: list[int], ends: list[str]) -> Iterator[tuple]:
    """The nodes of one shard of sorted distinct sequences, as rows of ``SHARD``.

    Inner nodes are complete but for the parent id of those below an edge. An edge
    node has the sums of its inner branches only: its own members and the branches
    through other edge nodes are added when the shards are merged.
    """
    split = [_tokens(s) for s in sequences]
    dictionary = {t: i for i, t in enumerate(sorted({t for s in split for t in s}))}
    names = list(dictionary)
    tree = TernaryTree()
    stops = tree.insert_sorted([[dictionary[t] for t in s] for s in split])
    size = len(tree.token)
    points = [0] + [int.from_bytes(names[t][DIGEST:], "big") for t in tree.token[1:]]
    members, first, ended = [0] * size, [None] * size, [None] * size
    for node, n, conv, digest in zip(stops, counts, least, ends):
        members[node], first[node], ended[node] = n, conv, digest
    keys = {0: _node_key(b"", b"")}
    for side in (split[0], split[-1]):
        at = 0
        for token in side:
            below = tree.child(at, dictionary[token])
            keys[below] = _node_key(keys[at], token)
            at = below
    children, leaves, saved, depth = [0] * size, [0] * size, [0] * size, [0] * size
    for node in range(1, size):
        depth[node] = depth[tree.parent[node]] + 1
    for node in tree.bottom_up():
        if node not in keys:
            saved[node] += (members[node] - 1) * points[node]
            leaves[node] += not children[node]
        up = tree.parent[node]
        if up == NIL:
            continue
        members[up] += members[node]
        first[up] = first[node] if first[up] is None else min(first[up], first[node])
        if node not in keys:
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in range(size):
        up = tree.parent[node]
        inner = node not in keys and up not in keys
        yield (
            node in keys,
            keys.get(node),
            keys.get(up),
            points[node],
            first[node],
            depth[node],
            first[up] if inner else None,
            members[node],
            children[node],
            leaves[node],
            saved[node],
            ended[node] or (NO_ENDS if node not in keys else None),
        )


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = [[], [], [], []]
    for batch in batches:
        for values, name in zip(columns, ("seq", "n", "least", "ends")):
            values += batch.column(name).to_pylist()
    if columns[0]:
        yield from _batches(shard_nodes(*columns), [part.split()[0] for part in SHARD.split(", ")], _SHARD_TYPES)


def _merge_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the merged edge nodes bottom up; deeper nodes come first."""
    names = ["node", "up", "points", *RESULT]
    rows = [dict(zip(batch.schema.names, r)) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
    by_key = {r["node"]: r for r in rows}
    for r in rows:
        r["saved_tokens"] += (r["n_convs"] - 1) * r["points"]
        r["n_leaves"] += not r["n_children"]
        above = by_key.get(r["up"])
        if above:
            r["parent_conv_id"] = above["conv_id"]
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
    found = ((r["node"], *(r[n] for n in RESULT)) for r in rows)
    yield from _batches(found, ["node", *names[3:]], [pa.binary(), *[pa.int64()] * 7, pa.string()])


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations.

    Columns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Turns are ordered by turn (NULL first), equal ones by
    the SHA-256 of role and text, so repeated rows are repeated turns; NULL roles and
    texts are empty; rows without a conv_id belong to no conversation and are left
    out. An empty table has no conversation and gives no rows, not even a root.
    Other columns are not read.

    Bounds: a conversation is one row (24 bytes a turn), a shard's distinct sequences
    are one partition of a range exchange, and the last merge holds only the
    beginnings of each shard's first and last sequence. A common beginning does not
    gather: ranges cut whole sequences, and equal ones were counted before.
    """
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    rows = conversations.select(*[F.col(c).alias(n) for n, c in names.items()]).withColumn("conv_id", F.col("conv_id").cast("bigint"))
    distinct = keep(distinct_sequences(rebuilt_sequences(rows)), "distinct-sequences")
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = distinct.repartitionByRange(partitions, "seq").sortWithinPartitions("seq")
    nodes = keep(shards.mapInArrow(_shard, SHARD), "trie-nodes")
    edges = nodes.filter("edge").groupBy("node").agg(
        F.first("up").alias("up"),
        F.first("points").alias("points"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    merged_type = "node binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    merged = edges.repartition(1).sortWithinPartitions(F.desc("depth")).mapInArrow(_merge_edges, merged_type)
    merged = keep(merged, "trie-edges")
    above = merged.select(F.col("node").alias("up"), F.col("conv_id").alias("_above"))
    inner = lookup_join(nodes.filter("NOT edge"), above, "up", "left", merged.count(), 64)
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return inner.select(*RESULT).union(merged.select(*RESULT))
