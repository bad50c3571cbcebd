"""Linear-chain conditional random field over word shapes, in numpy.

A word enters only through its shape, so the scores of a word are a row of a
small table. Words that no neighbour and no transition could turn into anything
but "outside" are settled by that table alone; Viterbi runs over the stretches
between them, in batches of equal length. Both ends of a stretch border on an
outside word or on the end of the text, which counts as one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

OUTSIDE = 0
SETTLING_ROUNDS = 6
RATE, ROUNDS, PENALTY = 0.2, 200, 1e-5

# Longer words are cut before the field sees them.
LONG = 80

_RUN = re.compile(r"[0-9]+|[A-Z]+|[a-z]+|[^\x00-\x7F]+|[^0-9A-Za-z]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def word_shape(word: str) -> str:
    """Runs of characters by kind: 555-7713 becomes d3-d4, Ab becomes Xx."""
    if len(word) > LONG:
        return "long"
    parts = []
    for run in _RUN.findall(word):
        c = run[0]
        if c.isdigit():
            parts.append(f"d{min(len(run), 20)}")
        elif c.isalpha() or c > "\x7f":
            parts.append("X" if c.isupper() else "x")
        else:
            parts.append(c)
    digits = re.sub(r"[^0-9]", "", word)
    checks = "L" if 14 <= len(digits) <= 19 and luhn(digits) else ""
    return f"{''.join(parts)}/{min(len(digits), 20)}{checks}"


def shape_features(shape: str) -> list[str]:
    """Binary features of a shape: itself, without run lengths, digits, marks."""
    form, _, tail = shape.rpartition("/")
    core = form.strip(".,;:!?\"'*#%$&|<>")
    features = ["any", f"form={re.sub('[0-9]+', '', core)}"]
    if tail != "0":
        features += [f"digits={tail}", "digits"]
    if form[:1] not in ("x", "X", ""):
        features.append(f"first={form[:1]}")
    if "@" in form[1:]:
        features.append("at")
    if re.fullmatch(r"d[123]([.]d[123]){3}", core):
        features.append("quad")
    return features


def context_feature(shape: str) -> str:
    return re.sub("[0-9]+", "", shape.rpartition("/")[0]).strip(".,;:!?\"'*#%$&|<>")


@dataclass
class Crf:
    """Weights by feature name; ``labels[0]`` is outside."""

    labels: list[str]
    own: dict[str, np.ndarray] = field(default_factory=dict)
    before: dict[str, np.ndarray] = field(default_factory=dict)
    after: dict[str, np.ndarray] = field(default_factory=dict)
    moves: np.ndarray | None = None

    def rows(self, shape: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of a shape for its own place and for the places after and before it."""
        zero = np.zeros(len(self.labels))
        near = context_feature(shape)
        own = sum((self.own[f] for f in shape_features(shape) if f in self.own), zero)
        return own, self.before.get(near, zero), self.after.get(near, zero)


def _sequence_sums(scores: np.ndarray, moves: np.ndarray):
    """Log partition, label and move expectations of equally long sequences."""
    n, steps, k = scores.shape
    forward = np.empty_like(scores)
    forward[:, 0] = scores[:, 0] + moves[OUTSIDE]
    for t in range(1, steps):
        grid = forward[:, t - 1, :, None] + moves
        top = grid.max(axis=1)
        forward[:, t] = top + np.log(np.exp(grid - top[:, None]).sum(axis=1)) + scores[:, t]
    backward = np.empty_like(scores)
    backward[:, -1] = moves[:, OUTSIDE]
    for t in range(steps - 2, -1, -1):
        grid = moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        top = grid.max(axis=2)
        backward[:, t] = top + np.log(np.exp(grid - top[..., None]).sum(axis=2))
    last = forward[:, -1] + moves[:, OUTSIDE]
    top = last.max(axis=1)
    log_z = top + np.log(np.exp(last - top[:, None]).sum(axis=1))
    label = np.exp(forward + backward - log_z[:, None, None])
    expected = np.zeros((k, k))
    expected[OUTSIDE] += label[:, 0].sum(axis=0)
    expected[:, OUTSIDE] += label[:, -1].sum(axis=0)
    for t in range(1, steps):
        grid = forward[:, t - 1, :, None] + moves + (scores[:, t] + backward[:, t])[:, None, :]
        expected += np.exp(grid - log_z[:, None, None]).sum(axis=0)
    return log_z, label, expected


def fit_crf(sequences: list[tuple[list[str], list[str]]], labels: list[str]) -> Crf:
    """Maximum penalised likelihood by Adam over all sequences of (shapes, labels)."""
    k = len(labels)
    index = {name: i for i, name in enumerate(labels)}
    sequences = [s for s in sequences if s[0]]
    shapes = sorted({s for words, _ in sequences for s in words})
    at = {s: i for i, s in enumerate(shapes)}
    names = sorted({f for s in shapes for f in shape_features(s)})
    near = sorted({context_feature(s) for s in shapes})
    own_of = np.zeros((len(shapes), len(names)))
    near_of = np.zeros((len(shapes), len(near)))
    name_at, near_at = {f: i for i, f in enumerate(names)}, {f: i for i, f in enumerate(near)}
    for s, i in at.items():
        own_of[i, [name_at[f] for f in shape_features(s)]] = 1
        near_of[i, near_at[context_feature(s)]] = 1
    by_length: dict[int, list] = {}
    for words, tags in sequences:
        by_length.setdefault(len(words), []).append(([at[w] for w in words], [index[t] for t in tags]))
    batches = [(np.array([w for w, _ in rows]), np.array([t for _, t in rows])) for rows in by_length.values()]
    count = len(sequences)
    parts = [np.zeros((len(names), k)), np.zeros((len(near), k)), np.zeros((len(near), k)), np.zeros((k, k))]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, ROUNDS + 1):
        own, before, after = own_of @ parts[0], near_of @ parts[1], near_of @ parts[2]
        g_own, g_before, g_after = (np.zeros((len(shapes), k)) for _ in range(3))
        g_moves = np.zeros((k, k))
        for words, tags in batches:
            scores = own[words]
            scores[:, 1:] += before[words[:, :-1]]
            scores[:, :-1] += after[words[:, 1:]]
            _, label, expected = _sequence_sums(scores, parts[3])
            rest = label
            np.subtract.at(rest, (np.arange(len(words))[:, None], np.arange(words.shape[1])[None], tags), 1.0)
            np.add.at(g_own, words, rest)
            np.add.at(g_before, words[:, :-1], rest[:, 1:])
            np.add.at(g_after, words[:, 1:], rest[:, :-1])
            g_moves += expected
            ends = np.pad(tags, ((0, 0), (1, 1)), constant_values=OUTSIDE)
            np.subtract.at(g_moves, (ends[:, :-1], ends[:, 1:]), 1.0)
        slopes = [own_of.T @ g_own, near_of.T @ g_before, near_of.T @ g_after, g_moves]
        for p, g, m, v in zip(parts, slopes, first, second):
            g = g / count + 2 * PENALTY * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(
        labels,
        {f: parts[0][i] for f, i in name_at.items()},
        {f: parts[1][i] for f, i in near_at.items()},
        {f: parts[2][i] for f, i in near_at.items()},
        parts[3],
    )


class Decoder:
    """Viterbi for many texts given as words.

    ``tag`` keeps the scores of at most ``limit`` word shapes (of 20 or more) and
    forgets all of them when the next words could pass that; a longer text is
    scored in parts. Neither changes a label.
    """

    def __init__(self, model: Crf, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.part = max(1, limit // 4)  # words scored at once
        self._forget()
        zero = np.zeros(len(model.labels))

        def worst(rows):
            table = np.array([zero, *rows.values()])
            return (table[:, [OUTSIDE]] - table).min(axis=0)

        moves = model.moves
        # What replacing a label by outside gains at least on the move into it and
        # out of it: for any neighbours, and for neighbours that are outside.
        self.any_in, self.any_out = (moves[:, [OUTSIDE]] - moves).min(axis=0), (moves[[OUTSIDE]] - moves).min(axis=1)
        self.out_in, self.out_out = moves[OUTSIDE, OUTSIDE] - moves[OUTSIDE], moves[OUTSIDE, OUTSIDE] - moves[:, OUTSIDE]
        self.slack = worst(model.before) + worst(model.after) + self.any_in + self.any_out

    def _forget(self) -> None:
        """Empty tables; shape numbers given before no longer hold."""
        self.words: dict[bytes, int] = {}
        self.shapes: dict[str, int] = {}
        k = len(self.model.labels)
        self.own, self.before, self.after = (np.zeros((0, k)) for _ in range(3))
        self.settled = np.zeros(0, bool)
        self.border = self.shapes.setdefault("", 0)  # stands between texts, scores nothing

    def _make_room(self, words: int) -> None:
        if len(self.shapes) + words > self.limit:
            self._forget()

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Shape numbers of the words, good until the next ``tag``."""
        known = self.words
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            pass
        if len(known) > self.limit:
            known.clear()
        for word in words:
            if word not in known:
                shape = word_shape(word.decode("utf-8", "replace"))
                if shape not in self.shapes:
                    self.shapes[shape] = len(self.shapes)
                known[word] = self.shapes[shape]
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _grow(self) -> None:
        fresh = list(self.shapes)[len(self.own) :]
        if not fresh:
            return
        zero = np.zeros(len(self.model.labels))
        own, before, after = zip(*(self.model.rows(s) if s else (zero, zero, zero) for s in fresh))
        self.own, self.before, self.after = (
            np.concatenate([a, np.array(b)]) for a, b in ((self.own, own), (self.before, before), (self.after, after))
        )
        margin = self.own[:, [OUTSIDE]] - self.own + self.slack
        margin[:, OUTSIDE] = np.inf
        self.settled = margin.min(axis=1) > 0
        self.settled[self.border] = True

    def tag(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, given as words, the positions that are not outside, and their labels."""
        found, lo = [], 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= self.part:
                size += len(texts[hi])
                hi += 1
            if size > self.part:
                found.append(self._tag_in_parts(texts[lo]))
            else:
                self._make_room(size)
                found += self.decode([self.ids(words) for words in texts[lo:hi]])
            lo = hi
        return found

    def _tag_in_parts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``tag`` for one long text: only its open words keep scores between the parts."""
        settled = np.ones(len(words) + 2, bool)
        places, scores = [], []
        for lo in range(0, len(words), self.part):
            part = words[max(lo - 1, 0) : lo + self.part + 1]
            self._make_room(len(part))
            ids = self.ids(part)
            if lo == 0:
                ids = np.concatenate([[self.border], ids])
            if lo + self.part >= len(words):
                ids = np.concatenate([ids, [self.border]])
            self._grow()
            own, at, score = self._by_shape(ids)
            settled[lo + 1 : lo + len(ids) - 1] = own[1:-1]
            places.append(at + lo)
            scores.append(score)
        return self._paths(settled, np.concatenate(places), np.concatenate(scores), [len(words)])[0]

    def decode(self, texts: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``tag`` for texts given as shape numbers."""
        self._grow()
        border = np.array([self.border])
        ids = np.concatenate([border, *(x for t in texts for x in (t, border))])
        return self._paths(*self._by_shape(ids), [len(t) for t in texts])

    def _by_shape(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words their shape settles; places and scores of the others but the two ends."""
        settled = self.settled[ids]
        at = np.flatnonzero(~settled[1:-1]) + 1
        return settled, at, self.own[ids[at]] + self.before[ids[at - 1]] + self.after[ids[at + 1]]

    def _paths(self, settled: np.ndarray, at: np.ndarray, scores: np.ndarray, sizes: list[int]):
        """Labels of the texts of these sizes that lie in a row with a border around each."""
        open_ = self._open(settled, at, scores)
        at, scores = at[open_], scores[open_]
        starts = np.cumsum([1, *(n + 1 for n in sizes)])
        lengths: dict[int, list[int]] = {}
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 1) + 1):
            if len(part):
                lengths.setdefault(len(part), []).append(int(part[0]))
        labels = np.zeros(len(at), np.int64)
        for length, firsts in lengths.items():
            rows = np.array(firsts)[:, None] + np.arange(length)
            labels[rows] = viterbi(scores[rows], self.model.moves)
        at, labels = at[labels > 0], labels[labels > 0]
        cuts = np.searchsorted(at, starts)
        return [(at[a:b] - s, labels[a:b]) for a, b, s in zip(cuts, cuts[1:], starts)]

    def _open(self, settled: np.ndarray, at: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Which of the words ``at`` are not proven to be outside.

        With the scores of the actual neighbours, then with the knowledge that a
        neighbour is outside, as long as that settles more.
        """
        settled, kept = settled.copy(), np.arange(len(at))
        margin = scores[:, [OUTSIDE]] - scores
        for _ in range(SETTLING_ROUNDS):
            left = np.where(settled[at - 1][:, None], self.out_in, self.any_in)
            right = np.where(settled[at + 1][:, None], self.out_out, self.any_out)
            gain = margin + left + right
            gain[:, OUTSIDE] = np.inf
            sure = gain.min(axis=1) > 0
            if not sure.any():
                break
            settled[at[sure]] = True
            at, margin, kept = at[~sure], margin[~sure], kept[~sure]
        return kept

    def _scores(self, ids: np.ndarray, lo: int, hi: int) -> np.ndarray:
        scores = self.own[ids[lo:hi]].copy()
        left = max(lo, 1)
        scores[left - lo :] += self.before[ids[left - 1 : hi - 1]]
        right = min(hi, len(ids) - 1)
        scores[: right - lo] += self.after[ids[lo + 1 : right + 1]]
        return scores


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best label paths of equally long sequences that begin and end next to outside."""
    n, steps, k = scores.shape
    best = scores[:, 0] + moves[OUTSIDE]
    back = np.zeros((n, steps, k), np.int8)
    for t in range(1, steps):
        grid = best[:, :, None] + moves
        back[:, t] = grid.argmax(axis=1)
        best = grid.max(axis=1) + scores[:, t]
    path = np.empty((n, steps), np.int64)
    path[:, -1] = (best + moves[:, OUTSIDE]).argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = back[rows, t, path[:, t]]
    return path
