"""Split search on binned rows.

Sums are whole numbers held in doubles below 2**53, so they are exact and do not
depend on the order of rows, tasks or partitions. A node is named by its path: the
root is 1, the children of p are 2p (left) and 2p + 1.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np

# Bins of a feature; the last one holds missing values.
BINS, MISSING = 256, 255
# Below so many rows sorting beats filling histograms; both give the same split.
SORTED_ROWS = 128
HISTOGRAM_ROWS = 8192
# Below so many rows the cells of all features are counted at once.
FEW_ROWS = 1024
# Features with few bins are counted together, as one with at most so many cells, where
# the cells of all nodes are not more than the second bound.
BUNDLE_CELLS = 256
BUNDLED_CELLS = 1 << 21
# Growing keeps the cells of nodes above so many rows, to subtract a child's from them.
KEPT_ROWS = 1024
# Where all nodes are grown, those of at most so many rows are split together, in batches of so many cells.
BATCH_ROWS = 256
BATCH_CELLS = 1 << 20
# A gain below this share of the halves is rounding.
LEAST_GAIN = 1e-12
DEEPEST = 60


@dataclass(frozen=True)
class Growth:
    """How a tree grows; ``max_leaves`` makes it grow the best leaf first."""

    max_leaves: int | None = None
    max_depth: int | None = None
    min_leaf: int = 1
    l2: float = 0.0
    subset: str = "all"
    seed: int = 42

    def chosen(self, width: int, tree: int, path: int) -> np.ndarray | None:
        """Features that may split this node, drawn by seed, tree and path; None for all."""
        named = {"all": width, "sqrt": int(math.sqrt(width)), "log2": int(math.log2(width))}
        count = named[self.subset] if self.subset in named else int(float(self.subset) * width)
        if count >= width:
            return None
        drawn = np.random.default_rng([self.seed, tree, path]).permutation(width)
        return np.sort(drawn[: max(count, 1)])

    def may_split(self, path: int, n: float) -> bool:
        deepest = DEEPEST if self.max_depth is None else min(self.max_depth, DEEPEST)
        return path.bit_length() - 1 < deepest and n >= 2 * self.min_leaf


class Split(NamedTuple):
    """``left_total`` and ``left_n`` are the sum and weight of the left side."""

    gain: float
    feature: int
    bin: int
    missing_left: bool
    left_total: float
    left_n: float


class Node(NamedTuple):
    path: int
    total: float
    n: float
    split: Split | None


class Bundles:
    """Features counted together: the cells of a group are those of all its features at once."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.groups: list[tuple[list[int], int, int]] = []
        features, start, size = [], 0, 1
        for f in np.argsort(sizes, kind="stable").tolist():
            if features and size * int(sizes[f]) > limit:
                self.groups.append((features, start, size))
                features, start, size = [], start + size, 1
            features, size = [*features, f], size * int(sizes[f])
        if features:
            self.groups.append((features, start, size))
        self.cells = start + size if features else 0
        of: list[np.ndarray] = [np.empty(0, np.int64)] * len(sizes)
        for features, start, size in self.groups:
            stride = size
            for f in features:
                stride //= int(sizes[f])
                of[f] = start + np.argsort(np.arange(size) // stride % sizes[f], kind="stable")
        # Cells to add, and where those of each feature's bin begin.
        self.places = np.concatenate([np.empty(0, np.int64), *of])
        each = np.repeat([len(x) // max(int(n), 1) for x, n in zip(of, sizes)], sizes)
        self.starts = np.cumsum(each) - each

    def apart(self, joint: np.ndarray) -> np.ndarray:
        """Cells feature by feature, as a layout has them."""
        return np.add.reduceat(joint[..., self.places], self.starts, axis=-1) if len(self.starts) else joint


class Layout:
    """Where the bins of each feature lie in a flat histogram; the last cell counts missing values."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = np.asarray(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.cells = int(self.sizes.sum())
        self.caps = (self.sizes - 1).astype(np.uint8)

    @staticmethod
    def of(edges: list[np.ndarray]) -> Layout:
        """Only the bins that these edges can give."""
        return Layout([len(e) + 2 for e in edges])

    @staticmethod
    def full(width: int) -> Layout:
        return Layout(np.full(width, BINS))

    @cached_property
    def bundles(self) -> Bundles:
        return Bundles(self.sizes, BUNDLE_CELLS)

    @cached_property
    def alone(self) -> Bundles:
        return Bundles(self.sizes, 0)

    def take(self, features: np.ndarray) -> Layout:
        return Layout(self.sizes[features])

    def places(self, features: np.ndarray) -> np.ndarray:
        """Cells of some features, feature by feature."""
        return np.concatenate([np.arange(self.starts[f], self.ends[f]) for f in features])


def count_cells(bins: np.ndarray, sums: np.ndarray, weights: np.ndarray, layout: Layout, slots=None, count: int = 1) -> np.ndarray:
    """Sums and weights per slot and cell: shape (2, count, cells). ``slots`` numbers the rows' nodes."""
    width = len(layout.sizes)
    plain = len(weights) > 0 and weights.min() == weights.max() == 1
    if slots is None and len(bins) < FEW_ROWS:
        at = (np.minimum(bins, layout.caps) + layout.starts).ravel()
        found = [np.bincount(at, x, layout.cells) for x in (np.repeat(sums, width), None if plain else np.repeat(weights, width))]
        return np.array(found, np.float64)[:, None]
    bundles = layout.bundles if count * layout.bundles.cells <= BUNDLED_CELLS else layout.alone
    joint = np.zeros((2, count, bundles.cells))
    for low in range(0, len(bins), HISTOGRAM_ROWS):
        part = slice(low, low + HISTOGRAM_ROWS)
        s, w = sums[part], None if plain else weights[part]
        columns = np.ascontiguousarray(np.minimum(bins[part], layout.caps).T)
        for features, start, size in bundles.groups:
            at = columns[features[0]].astype(np.intp)
            for f in features[1:]:
                at *= layout.sizes[f]
                at += columns[f]
            if slots is not None:
                at += slots[part] * size
            joint[0, :, start : start + size] += np.bincount(at, s, count * size).reshape(count, size)
            joint[1, :, start : start + size] += np.bincount(at, w, count * size).reshape(count, size)
    return bundles.apart(joint)


def histogram(bins: np.ndarray, sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums and weights per feature and bin: shape (2, features, BINS)."""
    width = bins.shape[1]
    return count_cells(bins, sums, weights, Layout.full(width)).reshape(2, width, BINS)


def _gains(left, left_n, total, n, growth: Growth):
    right, right_n = total - left, n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        halves = left * left / (left_n + growth.l2) + right * right / (right_n + growth.l2)
    gain = halves - total * total / (n + growth.l2)
    least = max(growth.min_leaf, 1)
    allowed = (left_n >= least) & (right_n >= least) & (gain > LEAST_GAIN * halves)
    return np.where(allowed, gain, -np.inf)


def split_of_histogram(cells: np.ndarray, total: float, n: float, growth: Growth, chosen=None) -> Split | None:
    """Best split of a histogram with all bins of every feature."""
    return split_of_cells(cells.reshape(2, -1), Layout.full(cells.shape[1]), total, n, growth, chosen)


def split_of_cells(cells: np.ndarray, layout: Layout, total: float, n: float, growth: Growth, chosen=None) -> Split | None:
    """Best split; of equal gains the lowest feature, then bin, then missing to the right."""
    if chosen is not None:
        cells, layout = cells[:, layout.places(chosen)], layout.take(chosen)
    missing = cells[:, layout.ends - 1]
    # Every feature holds all rows: taking them off where the next one starts makes one running sum serve all.
    steps = cells.copy()
    steps[:, layout.starts[1:]] -= np.array([[total], [n]])
    sums, counts = np.cumsum(steps, axis=1)
    best = None
    for missing_left in (False, True) if missing[1].any() else (False,):
        left = sums + np.repeat(missing[0], layout.sizes) if missing_left else sums
        left_n = counts + np.repeat(missing[1], layout.sizes) if missing_left else counts
        gain = _gains(left, left_n, total, n, growth)
        # A split after the missing values is none.
        gain[layout.ends - 1] = -np.inf
        at = int(gain.argmax())
        if gain[at] > (best.gain if best else 0):
            f = int(np.searchsorted(layout.ends, at, side="right"))
            feature = int(f if chosen is None else chosen[f])
            best = Split(float(gain[at]), feature, at - int(layout.starts[f]), missing_left, float(left[at]), float(left_n[at]))
    return best


def split_of_rows(bins, sums, weights, total: float, n: float, growth: Growth, chosen=None, layout: Layout | None = None) -> Split | None:
    """The same split from the rows themselves; a feature with one value among them cannot split."""
    part = bins if chosen is None else bins[:, chosen]
    high = part.max(axis=0)
    varying = np.flatnonzero(part.min(axis=0) != high)
    if not len(varying):
        return None
    part, features = part[:, varying], varying if chosen is None else chosen[varying]
    if len(part) > SORTED_ROWS or high.max() == MISSING:
        own = Layout.full(len(features)) if layout is None else layout.take(features)
        found = split_of_cells(count_cells(part, sums, weights, own)[:, 0], own, total, n, growth)
        return found and found._replace(feature=int(features[found.feature]))
    # Bin and place in one number, so that sorting keeps both.
    ordered = np.sort((part.T.astype(np.uint16) << 8) | np.arange(len(part), dtype=np.uint16), axis=1)
    order, ordered = ordered & 255, ordered >> 8
    left, left_n = np.cumsum(sums[order], axis=1)[:, :-1], np.cumsum(weights[order], axis=1)[:, :-1]
    gain = np.where(ordered[:, 1:] != ordered[:, :-1], _gains(left, left_n, total, n, growth), -np.inf)
    f, at = np.unravel_index(gain.argmax(), gain.shape)
    if gain[f, at] <= 0:
        return None
    return Split(float(gain[f, at]), int(features[f]), int(ordered[f, at]), False, float(left[f, at]), float(left_n[f, at]))


def goes_left(split: Split, bins: np.ndarray) -> np.ndarray:
    values = bins[:, split.feature]
    return np.where(values == MISSING, split.missing_left, values <= split.bin)


def grow(bins, sums, weights, growth: Growth, tree: int, path: int = 1, layout: Layout | None = None) -> list[Node]:
    """All nodes below and at ``path`` that growing these rows can need.

    Best first up to ``max_leaves`` leaves, or everything that may split. The best
    leaves of a whole tree are, within one of its branches, the best of that branch,
    so branches can be grown apart and merged by ``best_first``.
    """
    found: list[Node] = []
    waiting: list[tuple] = []
    width = bins.shape[1]
    layout = Layout.full(width) if layout is None else layout
    # What a row adds for each time it is drawn: where all add the same, no split gains.
    each = sums / weights

    def counted(rows):
        """Cells of a large node, from which those of its children are subtracted."""
        return count_cells(bins[rows], sums[rows], weights[rows], layout)[:, 0] if len(rows) > KEPT_ROWS else None

    def visit(path, rows, cells):
        total, n = float(sums[rows].sum()), float(weights[rows].sum())
        split = None
        if growth.may_split(path, n) and len(rows) > 1 and each[rows].min() != each[rows].max():
            chosen = growth.chosen(width, tree, path)
            if cells is not None:
                split = split_of_cells(cells, layout, total, n, growth, chosen)
            else:
                split = split_of_rows(bins[rows], sums[rows], weights[rows], total, n, growth, chosen, layout)
        found.append(Node(path, total, n, split))
        if split:
            heapq.heappush(waiting, (-split.gain, path, rows, split, cells))

    gathered: list[tuple[int, np.ndarray]] = []

    def reach(path, rows, cells):
        if growth.max_leaves is None and len(rows) <= BATCH_ROWS:
            gathered.append((path, rows))
        else:
            visit(path, rows, cells)

    everything = np.arange(len(bins))
    # With few features a node, counting these alone is cheaper than keeping all.
    asked = growth.chosen(width, tree, path)
    keeps = asked is None or 3 * len(asked) >= width
    reach(path, everything, counted(everything) if keeps else None)
    budget = math.inf if growth.max_leaves is None else growth.max_leaves - 1
    while waiting and budget > 0:
        _, at, rows, split, cells = heapq.heappop(waiting)
        goes = goes_left(split, bins[rows])
        sides, parts = [rows[goes], rows[~goes]], [None, None]
        if cells is not None and max(len(r) for r in sides) > KEPT_ROWS:
            small = int(len(sides[1]) < len(sides[0]))
            less = count_cells(bins[sides[small]], sums[sides[small]], weights[sides[small]], layout)[:, 0]
            parts[small], parts[1 - small] = less, cells - less
            parts = [p if len(r) > KEPT_ROWS else None for p, r in zip(parts, sides)]
        reach(2 * at, sides[0], parts[0])
        reach(2 * at + 1, sides[1], parts[1])
        budget -= 1
    if gathered:
        found += _grow_small(gathered, bins, sums, weights, growth, tree, layout)
    return found


def _grow_small(nodes: list[tuple[int, np.ndarray]], bins, sums, weights, growth: Growth, tree: int, layout: Layout) -> list[Node]:
    """Everything at and below small nodes, which are split level by level, many at once."""
    found: list[Node] = []
    paths, sizes, rows = [p for p, _ in nodes], np.array([len(r) for _, r in nodes]), np.concatenate([r for _, r in nodes])
    most = max(BATCH_CELLS // max(bins.shape[1], 1), 1)
    while paths:
        batch = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(paths)]
        ends = np.r_[0, np.cumsum(sizes)]
        below = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            mine = rows[ends[a] : ends[b]]
            below.append(_split_batch(paths[a:b], sizes[a:b], mine, bins, sums, weights, growth, tree, layout, found))
        paths = [p for part in below for p in part[0]]
        sizes, rows = (np.concatenate([part[i] for part in below]) for i in (1, 2))
    return found


def _split_batch(paths, sizes, rows, bins, sums, weights, growth: Growth, tree: int, layout: Layout, found: list[Node]):
    """Split nodes whose rows follow one another; adds them to ``found`` and returns their children."""
    starts = np.cumsum(sizes) - sizes
    s, w = sums[rows], weights[rows]
    total, n = np.add.reduceat(s, starts), np.add.reduceat(w, starts)
    each = s / w
    mixed = np.minimum.reduceat(each, starts) != np.maximum.reduceat(each, starts)
    open_nodes = [k for k in np.flatnonzero(mixed).tolist() if growth.may_split(paths[k], n[k])]
    splits: list[Split | None] = [None] * len(paths)
    if open_nodes:
        kept = np.zeros(len(paths), bool)
        kept[open_nodes] = True
        at = np.repeat(kept, sizes)
        rows, s, w = rows[at], s[at], w[at]
        part, sizes = bins[rows], sizes[kept]
        best = _best_splits([paths[k] for k in open_nodes], sizes, part, s, w, total[kept], n[kept], growth, tree, layout)
        for k, split in zip(open_nodes, best):
            splits[k] = split
    found.extend(Node(p, t, m, split) for p, t, m, split in zip(paths, total.tolist(), n.tolist(), splits))
    done = [(paths[k], split) for k, split in enumerate(splits) if split]
    if not done:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.repeat(np.array([splits[k] is not None for k in open_nodes]), sizes)
    sizes = sizes[[splits[k] is not None for k in open_nodes]]
    rows, part = rows[at], part[at]
    feature, last, missing_left = (np.repeat([getattr(split, name) for _, split in done], sizes) for name in ("feature", "bin", "missing_left"))
    values = part[np.arange(len(part)), feature]
    right = ~np.where(values == MISSING, missing_left, values <= last)
    side = 2 * np.repeat(np.arange(len(done)), sizes) + right
    children = [c for path, _ in done for c in (2 * path, 2 * path + 1)]
    return children, np.bincount(side, minlength=len(children)), rows[np.argsort(side, kind="stable")]


def _best_splits(paths, sizes, part, s, w, total, n, growth: Growth, tree: int, layout: Layout) -> list[Split | None]:
    """``split_of_rows`` of several nodes.

    Features with two values are summed; pairs of node and other feature are sorted side by side.
    """
    starts = np.cumsum(sizes) - sizes
    drawn = [growth.chosen(part.shape[1], tree, p) for p in paths]
    asked = None
    if drawn[0] is not None:
        asked = np.zeros((len(paths), part.shape[1]), bool)
        np.put_along_axis(asked, np.array(drawn), True, axis=1)
    out: list[Split | None] = [None] * len(paths)
    two = np.flatnonzero(layout.sizes <= 3)
    two = two if len(two) and part[:, two].max() < MISSING else two[:0]
    if len(two):
        _two_valued(out, two, starts, part, s, w, total, n, growth, asked)
    more = np.setdiff1d(np.arange(part.shape[1]), two, assume_unique=True)
    if not len(more):
        return out
    few = part[:, more]
    high = np.maximum.reduceat(few, starts, axis=0)
    varying = np.minimum.reduceat(few, starts, axis=0) != high
    if asked is not None:
        varying &= asked[:, more]
    gaps = (varying & (high == MISSING)).any(axis=1)
    for k in np.flatnonzero(gaps).tolist():
        mine = slice(starts[k], starts[k] + sizes[k])
        out[k] = split_of_rows(part[mine], s[mine], w[mine], float(total[k]), float(n[k]), growth, drawn[k], layout)
    varying[gaps] = False
    node, feature = np.nonzero(varying)
    if not len(node):
        return out
    lengths = sizes[node]
    ends = np.cumsum(lengths)
    first = ends - lengths
    pair = np.repeat(np.arange(len(node)), lengths)
    # Pair, bin and place in one number, so that sorting keeps all three.
    place = np.arange(len(pair)) - first[pair]
    row = starts[node][pair] + place
    keys = (pair << 24) | (few[row, feature[pair]].astype(np.int64) << 16) | place
    keys.sort()
    values = keys >> 16
    row = starts[node][pair] + (keys & 0xFFFF)
    # Whole numbers; a running sum over all pairs may pass what a double holds exactly.
    left, left_n = np.cumsum(s.astype(np.int64)[row]), np.cumsum(w.astype(np.int64)[row])
    at = np.flatnonzero((values[1:] != values[:-1]) & (pair[1:] == pair[:-1]))
    pair = pair[at]
    node = node[pair]
    left, left_n = ((x[at] - np.where(first[pair] > 0, x[first[pair] - 1], 0)).astype(np.float64) for x in (left, left_n))
    gain = _gains(left, left_n, total[node], n[node], growth)
    begins = np.flatnonzero(np.diff(node, prepend=-1))
    most = np.maximum.reduceat(gain, begins)
    # The first of equal gains has the lowest feature, then bin.
    tops = np.flatnonzero(gain == np.repeat(most, np.diff(begins, append=len(node))))
    tops = tops[np.diff(node[tops], prepend=-1) > 0]
    chosen = zip(node[tops].tolist(), gain[tops].tolist(), more[feature[pair[tops]]].tolist(), (values[at[tops]] & 255).tolist(), left[tops].tolist(), left_n[tops].tolist())
    for k, gained, f, last, l, ln in chosen:
        if gained > 0 and (out[k] is None or (gained, -f) > (out[k].gain, -out[k].feature)):
            out[k] = Split(gained, f, last, False, l, ln)
    return out


def _two_valued(out: list[Split | None], two, starts, part, s, w, total, n, growth: Growth, asked) -> None:
    """Puts the best split by features of the bins 0 and 1 only, per node, into ``out``."""
    values = part[:, two]
    # Whole numbers, so no order of adding changes them.
    right, right_n = (np.add.reduceat(values * x.astype(np.int64)[:, None], starts, axis=0).astype(np.float64) for x in (s, w))
    left, left_n = total[:, None] - right, n[:, None] - right_n
    gain = _gains(left, left_n, total[:, None], n[:, None], growth)
    if asked is not None:
        gain[~asked[:, two]] = -np.inf
    at = gain.argmax(axis=1)
    nodes = np.arange(len(out))
    found = (x[nodes, at].tolist() for x in (gain, left, left_n))
    for k, f, gained, l, ln in zip(nodes.tolist(), two[at].tolist(), *found):
        if gained > 0:
            out[k] = Split(gained, f, 0, False, l, ln)


def best_first(known: dict[int, Node], growth: Growth) -> tuple[list[int], list[tuple[int, float]]]:
    """Paths to split, best gain first, and the (path, weight) of children not yet known."""
    taken, missing, waiting = [], [], []

    def push(path):
        node = known[path]
        if node.split:
            heapq.heappush(waiting, (-node.split.gain, path))

    push(1)
    budget = math.inf if growth.max_leaves is None else growth.max_leaves - 1
    while waiting and len(taken) < budget:
        _, path = heapq.heappop(waiting)
        taken.append(path)
        node = known[path]
        for child, n in ((2 * path, node.split.left_n), (2 * path + 1, node.n - node.split.left_n)):
            if child in known:
                push(child)
            else:
                missing.append((child, n))
    return taken, missing


class Tree:
    """A tree as arrays sorted by path; leaves have feature -1."""

    def __init__(self, path, feature, bin, missing_left, value):
        order = np.argsort(path)
        self.path = np.asarray(path, np.int64)[order]
        self.feature = np.asarray(feature, np.int32)[order]
        self.bin = np.asarray(bin, np.int16)[order]
        self.missing_left = np.asarray(missing_left, bool)[order]
        self.value = np.asarray(value, np.float64)[order]
        self.left = np.searchsorted(self.path, self.path * 2)

    @staticmethod
    def of(known: dict[int, Node], taken: list[int], value) -> Tree:
        """The nodes in ``taken`` split, their other children are leaves."""
        inner = set(taken)
        rows = []
        for path in [1, *(c for p in taken for c in (2 * p, 2 * p + 1))]:
            node = known.get(path)
            split = node.split if path in inner else None
            rows.append((path, split.feature if split else -1, split.bin if split else 0, bool(split and split.missing_left), value(node) if node else 0.0))
        return Tree(*zip(*rows))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Index of the leaf of each row."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins)) if len(self.path) > 1 else np.empty(0, np.int64)
        while len(rows):
            k = at[rows]
            values = bins[rows, self.feature[k]]
            left = np.where(values == MISSING, self.missing_left[k], values <= self.bin[k])
            at[rows] = self.left[k] + ~left
            rows = rows[self.feature[at[rows]] >= 0]
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(bins)]

    def whole(self, grid: float) -> np.ndarray:
        """The values as whole numbers of ``1 / grid``."""
        return np.rint(self.value * grid).astype(np.int64)
