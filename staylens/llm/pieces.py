"""SentencePiece encoding and decoding with a piece automaton and Viterbi.

An Aho-Corasick automaton over all pieces reads a text once. At every position
the chain of output links lists the pieces that end there, longest first, and
each relaxes the best score of that position. Texts are cut where no piece can
reach across (before a run of blanks that follows another character, and at line
feeds), which leaves the best path unchanged and lets equal parts be coded once.

Blanks stand for the piece mark, and one blank is put before the text. Nothing
else is changed. A character that is no piece is written as its UTF-8 bytes, also
the mark itself where a text holds it, so decoding gives back the exact text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.text import in_slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_PARTS = 300_000
LONG_PART = 10_000
CACHED_CHARS = 48
# Remembered moves over failure links.
JUMPS = 500_000
# A byte costs this much more than the least likely ordinary piece.
BYTE_PENALTY = 10.0
NEVER = -1e8  # pieces scored below this do not set the price of a byte


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces with scores (blank for the mark) and the ids of the 256 bytes."""

    pieces: tuple[tuple[str, float, int], ...]
    byte_ids: tuple[int, ...]


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    """Read a model file on the driver; its size bounds what is broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append((piece.replace(MARK, " "), model.get_score(i), i))
    if min(byte_ids) < 0:
        raise ValueError("the model has no piece for some byte")
    return Vocabulary(tuple(pieces), tuple(byte_ids))


class Automaton:
    """States as numbers; one table of moves, failure links and output links."""

    def __init__(self, vocabulary: Vocabulary):
        self.moves: dict[int, int] = {}
        self.size, self.score, self.piece = [0], [0.0], [-1]
        children: list[list[tuple[int, int]]] = [[]]
        for text, score, number in vocabulary.pieces:
            state = 0
            for c in map(ord, text):
                key = state << 21 | c
                if key not in self.moves:
                    self.moves[key] = len(self.size)
                    children[state].append((c, len(self.size)))
                    children.append([])
                    for column, empty in ((self.size, 0), (self.score, 0.0), (self.piece, -1)):
                        column.append(empty)
                state = self.moves[key]
            self.size[state], self.score[state], self.piece[state] = len(text), score, number
        self.fail = [0] * len(self.size)
        self.output = [0] * len(self.size)  # nearest shorter piece that ends here; 0: none
        queue = deque(child for _, child in children[0])
        while queue:
            state = queue.popleft()
            back = self.fail[state]
            self.output[state] = back if self.piece[back] >= 0 else self.output[back]
            for c, child in children[state]:
                target = back
                while target and target << 21 | c not in self.moves:
                    target = self.fail[target]
                self.fail[child] = self.moves.get(target << 21 | c, 0)
                queue.append(child)

        # What ends in a state, longest first, by following its output links once.
        self.ends = [self._chain(state) for state in range(len(self.size))]
        self.jumps: dict[int, int] = {}

    def _chain(self, state: int) -> tuple[tuple[int, float, int], ...]:
        out = []
        node = state if self.piece[state] >= 0 else self.output[state]
        while node:
            out.append((self.size[node], self.score[node], self.piece[node]))
            node = self.output[node]
        return tuple(out)

    def jump(self, key: int) -> int:
        """Target of (state, character) over failure links, remembered for known characters."""
        moves, fail = self.moves, self.fail
        state, c = key >> 21, key & 0x1FFFFF
        while state and state << 21 | c not in moves:
            state = fail[state]
        found = moves.get(state << 21 | c, 0)
        if found and len(self.jumps) < JUMPS:
            self.jumps[key] = found
        return found


class Coder:
    """Encodes and decodes; remembers at most CACHE_PARTS short parts."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = Automaton(vocabulary)
        self.byte_ids = vocabulary.byte_ids
        self.single = {text for text, _, _ in vocabulary.pieces if len(text) == 1}
        ordinary = [score for _, score, _ in vocabulary.pieces if score > NEVER]
        self.byte_score = min(ordinary, default=0.0) - BYTE_PENALTY
        last = max([number for _, _, number in vocabulary.pieces] + list(self.byte_ids))
        self.wording = [b""] * (last + 1)
        for text, _, number in vocabulary.pieces:
            self.wording[number] = text.encode()
        for value, number in enumerate(self.byte_ids):
            self.wording[number] = bytes([value])
        whole = any(re.search("[^ ] ", text) for text, _, _ in vocabulary.pieces)
        feeds = any("\n" in text for text, _, _ in vocabulary.pieces)
        self.parts = re.compile("(?s).+" if whole else " +[^ ]*|[^ ]+" if feeds else " +[^ \n]*|[^ \n]+|\n")
        self.known: dict[str, bytes] = {}

    def best_path(self, text: str) -> list[int]:
        """Ids of the best scored segmentation; of equals, the longer last piece."""
        a = self.automaton
        moves, jumps, ends, single = a.moves, a.jumps, a.ends, self.single
        # Where the best last piece starts and which it is. Typed arrays keep a long
        # unspaced part at 16 bytes a character; lists are faster for the short ones.
        best, starts, numbers = [0.0], [0], [-1]
        if len(text) > LONG_PART:
            best, starts, numbers = array("d", best), array("i", starts), array("i", numbers)
        state, lowest = 0, -np.inf
        for end, char in enumerate(text, 1):
            key = state << 21 | ord(char)
            state = moves.get(key) or jumps.get(key) or a.jump(key)
            top, start, number = lowest, end - 1, -1
            if char not in single:
                top = best[end - 1] + self.byte_score * len(char.encode())
            for size, score, piece in ends[state]:
                value = best[end - size] + score
                if value > top:
                    top, start, number = value, end - size, piece
            best.append(top)
            starts.append(start)
            numbers.append(number)
        ids: list[int] = []
        end = len(text)
        while end:
            start, number = starts[end], numbers[end]
            ids += [number] if number >= 0 else [self.byte_ids[b] for b in reversed(text[start:end].encode())]
            end = start
        return ids[::-1]

    def _part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = array("i", self.best_path(part)).tobytes()
            if len(part) <= CACHED_CHARS:
                if len(self.known) >= CACHE_PARTS:
                    self.known.clear()
                self.known[part] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        parts = self.parts.findall(" " + text) if text else []
        return np.frombuffer(b"".join(map(self._part, parts)), "<i4")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.wording.__getitem__, ids)).decode()[1:]


def _on_workers(spark, vocabulary: Vocabulary):
    """A function that gives each Python worker one coder."""
    shared = spark.sparkContext.broadcast(vocabulary)
    coders: list[Coder] = []

    def coder() -> Coder:
        if not coders:
            coders.append(Coder(shared.value))
        return coders[0]

    return coder


def encode_column(spark, text: Column, vocabulary: Vocabulary) -> Column:
    """array<int> of piece ids; empty for NULL and empty texts."""
    coder = _on_workers(spark, vocabulary)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _encoded(batches, coder)

    return encode(text)


def _encoded(batches: Iterator[pa.Array], coder) -> Iterator[pa.Array]:
    for texts in in_slices(batches):
        found = [coder().encode(t.as_py() or "") for t in texts]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *found])))


def decode_column(spark, ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of an array of ids; NULL for NULL."""
    coder = _on_workers(spark, vocabulary)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in in_slices(batches):
            yield pa.array([None if not r.is_valid else coder().decode(r.as_py()) for r in rows], pa.string())

    return decode(ids)


def encode_texts(docs: DataFrame, text: str = "text", path: str = MODEL_PATH, into: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of the pieces of every whole text in column ``into``.

    NULL and empty texts have no pieces. Every row is coded on its own, so
    repeated rows repeat; a column already called ``into`` is replaced.
    """
    return docs.withColumn(into, encode_column(docs.sparkSession, F.col(text), load_vocabulary(path)))


def decode_texts(tokens: DataFrame, ids: str = "token_ids", path: str = MODEL_PATH, into: str = "text") -> DataFrame:
    """``tokens`` with the exact text of its ids in column ``into``."""
    return tokens.withColumn(into, decode_column(tokens.sparkSession, F.col(ids), load_vocabulary(path)))


def piece_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = MODEL_PATH) -> DataFrame:
    """Columns doc_id, n_tokens, ids_sha256, restored: the coding of every whole text.

    ``ids_sha256`` digests the ids as little-endian 32-bit numbers; ``restored``
    tells whether decoding gave back the exact text (NULL counts as empty).
    """
    coder = _on_workers(docs.sparkSession, load_vocabulary(path))

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,restored:boolean>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in in_slices(batches):
            sizes, digests, same = [], [], []
            for t in texts:
                wording = t.as_py() or ""
                ids = coder().encode(wording)
                sizes.append(len(ids))
                digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
                same.append(coder().decode(ids.tolist()) == wording)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                ["n_tokens", "ids_sha256", "restored"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("d")).select("doc_id", "d.*")
