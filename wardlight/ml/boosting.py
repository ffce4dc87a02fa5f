"""Gradient-boosted trees on histograms: one tree per class and round, grown level by level or best leaf first.

Features are cut into at most `BINS` bins. A tree sees its rows only through histograms: for a node, a feature and a bin
the sums of gradients and second derivatives and the number of rows. Gradients are rounded to whole multiples of
1 / `UNIT`, so sums are exact in any order and a tree does not depend on how rows are dealt out. Only the smaller child
of a split is summed up; the other is its parent less that.

`Growing` is one tree on its way. It keeps its leaves in a queue by gain and says which splits it needs histograms for;
who adds these up does not matter to it:

* `boosted` has all rows at hand, so many fits of a grid run side by side, each in a task of its own. It adds up packed
  columns (`Columns`), and keeps the rows of every leaf, so no row is sent down a tree again. A fit that is alone deals its
  rows out to processes (`Stripes`);
* `fit_table` leaves rows where they are: a Spark job for each depth of a round sums histograms inside every partition,
  adds them up by shuffle, and only they (nodes x features x bins) reach the driver. It asks for all leaves in the queue at
  once, those that may come to nothing included, so a tree that grows best leaf first takes as many jobs as it is deep.

Both give the same trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from copy import copy
from dataclasses import dataclass
from functools import partial
from heapq import heappop, heappush, nsmallest
from itertools import groupby, pairwise
from multiprocessing import get_context

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.workspace import stage

BINS = 64
UNIT = float(1 << 20)
#: Most combinations of bins in a packed column, so that its sums stay in the fastest cache.
COMBINATIONS = 4096
#: Rows that are worked on at a time: what is between stays in a near cache, and no fresh memory is asked for.
BLOCK = 8192


@dataclass(frozen=True)
class Settings:
    """How one ensemble is fitted; `classes` is 0 for a number."""
    classes: int
    n_estimators: int = 100
    learning_rate: float = 0.1
    subsample: float = 1.0
    max_depth: int | None = None
    num_leaves: int | None = None
    min_child_samples: int = 1
    min_child_weight: float = 1.0
    l2: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of depth, the root first; `feature` is -1 in a leaf. Rows with bin <= cut go left."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        node, every = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while True:
            split = self.feature[node]
            if (split < 0).all():
                return node
            down = np.where(codes[every, split] <= self.cut[node], self.left[node], self.right[node])
            node = np.where(split < 0, node, down)


def histograms(codes: np.ndarray, sums: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """[group, feature, bin, 3]: sums of the two columns of `sums`, and rows."""
    features = codes.shape[1]
    cells = (codes.astype(np.int64) + np.arange(features) * BINS + group[:, None] * (features * BINS)).ravel()
    size = groups * features * BINS
    columns = [np.bincount(cells, np.repeat(sums[:, k], features), size) for k in (0, 1)] + [np.bincount(cells, minlength=size)]
    return np.stack(columns, axis=1).reshape(groups, features, BINS, 3)


class Columns:
    """Binned rows at hand, by feature, and packed for adding up.

    Features whose bins occur in at most `COMBINATIONS` combinations share a column that numbers these. Rows are added up by
    combination, once for all features of the column, and combinations by bin; whole sums make that exact.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes.T, np.uint8)
        self.features = len(self.codes)
        packed: list[tuple[list[int], np.ndarray, np.ndarray]] = []  # features, column, [combination, feature]
        for f, own in enumerate(self.codes):
            options = []
            for k, (_, column, bins) in enumerate(packed):
                cells = column.astype(np.int64) * BINS + own
                found = np.flatnonzero(np.bincount(cells, minlength=len(bins) * BINS))
                if len(found) <= COMBINATIONS:
                    options.append((len(found) / max(1, len(bins)), k, found, cells))
            if not options:
                packed.append(([f], own.astype(np.uint16), np.arange(BINS)[:, None]))
                continue
            _, k, found, cells = min(options, key=lambda o: o[:2])
            names, _, bins = packed[k]
            number = np.zeros(len(bins) * BINS, np.uint16)
            number[found] = np.arange(len(found))
            packed[k] = ([*names, f], number[cells], np.column_stack([bins[found // BINS], found % BINS]))
        ends = np.cumsum([len(bins) for *_, bins in packed])
        self.packed = [(end - len(bins), end) for end, (*_, bins) in zip(ends, packed)]
        # all packed columns of a row stand side by side, so a row is fetched at once
        self.table = np.zeros((self.codes.shape[1], 1 << (len(packed) - 1).bit_length()), np.uint16)
        for k, (_, column, _) in enumerate(packed):
            self.table[:, k] = column
        cells = np.concatenate([np.array(names) * BINS + bins for names, _, bins in packed], axis=None)
        source = np.concatenate([np.repeat(np.arange(begin, end), len(names))
                                 for (begin, end), (names, *_) in zip(self.packed, packed)])
        by_cell = np.argsort(cells, kind="stable")
        self.source = source[by_cell]
        self.filled, self.first = np.unique(cells[by_cell], return_index=True)

    def stretch(self, begin: int, end: int) -> Columns:
        """Rows next to each other, packed alike and numbered from 0."""
        own = copy(self)
        own.codes, own.table = self.codes[:, begin:end], self.table[begin:end]
        return own

    def histograms(self, parts: Sequence[np.ndarray], first: np.ndarray, second: np.ndarray | None) -> np.ndarray:
        """As `histograms` for rows given by number; a `second` of None is one unit in every row."""
        return self.summed(parts, Weights(first, second))

    def summed(self, parts: Sequence[np.ndarray], weights: Weights | Sequence[Weights]) -> np.ndarray:
        """The histograms of rows given by number, with weights of each part or of all; a part given again is fetched once."""
        size, each = self.features * BINS, [weights] * len(parts) if isinstance(weights, Weights) else weights
        out = np.zeros((len(parts), size, 3))
        few = [k for k, rows in enumerate(parts) if 2 * len(rows) * self.features < len(self.source) and len(rows) <= each[k].most]
        for _, same in groupby((k for k in range(len(parts)) if k not in set(few)), lambda k: id(parts[k])):
            same = list(same)
            rows, most = parts[same[0]], min(each[k].most for k in same)
            found = np.zeros((len(same), 3, self.packed[-1][1]))
            for start in range(0, len(rows), most):
                stop = min(start + most, len(rows))
                totals = [np.zeros(self.packed[-1][1], each[k].values.dtype) for k in same]
                for begin in range(start, stop, BLOCK):
                    block = rows[begin:min(begin + BLOCK, stop)]
                    own, values = self.table.take(block, axis=0), [each[k].values.take(block) for k in same]
                    for (low, high), column in zip(self.packed, own.T):
                        cells = column.astype(np.intp)
                        for total, value in zip(totals, values):
                            np.add.at(total[low:high], cells, value)
                for k, total, part in zip(same, totals, found):
                    if len(rows) <= most:
                        out[k, self.filled] = each[k].apart(np.add.reduceat(total.take(self.source), self.first)).T
                    else:
                        part += each[k].apart(total)
            if len(rows) > most:
                for k, part in zip(same, found):
                    for column, total in zip(out[k].T, part):
                        column[self.filled] = np.add.reduceat(total.take(self.source), self.first)
        if few:
            of, every = np.repeat(np.arange(len(few)), [len(parts[k]) for k in few]), np.concatenate([parts[k] for k in few])
            cells = (self.codes[:, every] + (np.arange(self.features) * BINS)[:, None] + of * size).ravel()
            values = np.concatenate([each[k].values.take(parts[k]) for k in few])
            bins = np.zeros(len(few) * size, values.dtype)
            np.add.at(bins, cells, np.tile(values, self.features))
            for k, own in zip(few, bins.reshape(len(few), size)):
                out[k] = each[k].apart(own).T
        return out.reshape(len(parts), self.features, BINS, 3)


class Weights:
    """What a row adds to its cells, in one number, so cells are added up once.

    A whole number `v` counts its row along as `v * unit + 1`; sums of up to `most` rows are exact and come apart again. That
    is the second derivative, with the first as real part beside it, or the first, in 64 bits, if all second ones are one unit.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray | None, out: np.ndarray | None = None):
        counted = first if second is None else second
        self._room(int(max(counted.max(initial=0), -counted.min(initial=0))), second is None)
        self.values = np.empty(len(first), np.int64 if second is None else complex) if out is None else out
        if second is None:
            np.multiply(counted, self.unit, out=self.values, casting="unsafe")
            self.values += 1
        else:
            np.multiply(counted, self.unit, out=self.values.imag)
            self.values.imag += 1
            self.values.real = first

    @classmethod
    def given(cls, values: np.ndarray, largest: int) -> Weights:
        """Of values put together already; `largest` is a bound of what counts the rows."""
        self = cls.__new__(cls)
        self._room(largest, values.dtype == np.int64)
        self.values = values
        return self

    def _room(self, largest: int, single: bool) -> None:
        self.most = 1 << max(0, min(20, (61 - largest.bit_length()) // 2) if single else min(16, (51 - largest.bit_length()) // 2))
        self.unit = 2.0 * self.most

    def apart(self, sums: np.ndarray) -> np.ndarray:
        """[3, cell]: both derivatives and rows."""
        if sums.dtype == np.int64:
            value = sums >> int(self.unit).bit_length() - 1
            rows = (sums & int(self.unit) - 1).astype(float)
            return np.stack([value, rows * UNIT, rows])
        value = np.floor(sums.imag * (1 / self.unit))
        return np.stack([sums.real, value, sums.imag - value * self.unit])


def best_splits(hists: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per histogram the gain, feature and cut of its best split (ties: first feature, lowest cut), and its sums on the left."""
    sums = np.ascontiguousarray(np.moveaxis(hists, 3, 0))
    left = sums.cumsum(axis=3)
    total = left[:, :, :1, -1:].copy()
    left = left[..., :-1]
    right = total - left
    score = lambda part: (part[0] / UNIT) ** 2 / (part[1] / UNIT + s.l2 + 1e-12)
    gain = score(left) + score(right) - score(total)
    light = np.minimum(left[1], right[1]) < s.min_child_weight * UNIT
    gain[light | (np.minimum(left[2], right[2]) < max(1, s.min_child_samples))] = -np.inf
    flat = gain.reshape(len(hists), -1)
    best = flat.argmax(axis=1)
    every = np.arange(len(best))
    return flat[every, best], best // (BINS - 1), best % (BINS - 1), left[:, every, best // (BINS - 1), best % (BINS - 1)].T


@dataclass(frozen=True)
class Split:
    """`left`: sums on the left. The children of a `last` split are leaves, so their sums are known."""
    node: int
    feature: int
    cut: int
    smaller: int
    left: np.ndarray
    last: bool


class Growing:
    """A tree on its way. Nodes are numbered by their way down: the root is 1, children of k are 2k and 2k + 1."""

    def __init__(self, root: np.ndarray, s: Settings):
        self.s, self.leaves = s, 1
        self.hists: dict[int, np.ndarray] = {}
        self.totals: dict[int, np.ndarray] = {}
        self.splits: dict[int, Split] = {}   # asked for, and so worked out below
        self.taken: set[int] = set()         # part of the tree
        self.rated: dict[int, tuple[float, Split]] = {}
        self.queue: list[tuple[float, int]] = []
        self._rate([1], root[None])
        self._push(1)

    def _rate(self, nodes: Sequence[int], hists: np.ndarray) -> None:
        totals = hists[:, 0].sum(axis=1)
        for node, gain, feature, cut, left, hist, total in zip(nodes, *best_splits(hists, self.s), hists, totals):
            self.totals[node] = total
            depth = node.bit_length()
            if gain > 1e-9 and (self.s.max_depth is None or depth <= self.s.max_depth):
                self.hists[node] = hist
                self.rated[node] = -float(gain), Split(node, int(feature), int(cut), 2 * node + int(2 * left[2] > total[2]),
                                                       left, depth == self.s.max_depth)

    def _push(self, node: int) -> None:
        if node in self.rated:
            heappush(self.queue, (self.rated[node][0], node))

    def wanted(self, ahead: bool) -> list[Split]:
        """Splits whose smaller children are to be summed up next; none once the tree is done.

        Without a limit on leaves every split in the queue will be made, so all are asked for; with one, only the best,
        or with `ahead` as many as may still be made.
        """
        limit = self.s.num_leaves
        while self.queue and (limit is None or self.leaves < limit):
            node = self.queue[0][1]
            if node not in self.splits:
                spare = len(self.queue) if limit is None else limit - self.leaves if ahead else 1
                asked = [self.rated[k][1] for _, k in nsmallest(spare, self.queue) if k not in self.splits]
                self.splits |= {split.node: split for split in asked}
                return asked
            heappop(self.queue)
            self.taken.add(node)
            self.leaves += 1
            self._push(2 * node)
            self._push(2 * node + 1)
        return []

    def take(self, asked: Sequence[Split], hists: Sequence[np.ndarray]) -> None:
        """The histograms of the smaller children, but for those of last splits."""
        nodes, parts, found = [], [], iter(hists)
        for split in asked:
            above = self.hists.pop(split.node)
            if split.last:
                self.totals[2 * split.node] = split.left
                self.totals[2 * split.node + 1] = self.totals[split.node] - split.left
                continue
            hist = next(found)
            nodes += [split.smaller, split.smaller ^ 1]
            parts += [hist, above - hist]
        if nodes:
            self._rate(nodes, np.stack(parts))

    def value(self, node: int) -> float:
        first, second, _ = self.totals[node]
        return -first / (second + (self.s.l2 + 1e-12) * UNIT) * self.s.learning_rate

    def values(self) -> dict[int, float]:
        """The values of the leaves."""
        below = [child for node in self.taken for child in (2 * node, 2 * node + 1)] or [1]
        return {node: float(self.value(node)) for node in below if node not in self.taken}

    def tree(self) -> Tree:
        order, k = [1], 0
        while k < len(order):
            order += [2 * order[k], 2 * order[k] + 1] if order[k] in self.taken else []
            k += 1
        number = {node: i for i, node in enumerate(order)}
        split = [self.splits[n] if n in self.taken else None for n in order]
        column = lambda of, kind: np.array([of(n, p) for n, p in zip(order, split)], kind)
        return Tree(column(lambda n, p: p.feature if p else -1, np.int64), column(lambda n, p: p.cut if p else 0, np.int64),
                    column(lambda n, p: number[2 * n] if p else 0, np.int64), column(lambda n, p: number[2 * n + 1] if p else 0, np.int64),
                    column(lambda n, p: 0.0 if p else self.value(n), float), column(lambda n, p: self.totals[n][2], np.int64))

    def place(self, codes: np.ndarray) -> np.ndarray:
        """For each row the number of its deepest node among those asked for."""
        out = np.empty(len(codes), object)
        todo = [(1, np.arange(len(codes)))]
        while todo:
            node, rows = todo.pop()
            if node not in self.splits:
                out[rows] = node
                continue
            left = codes[rows, self.splits[node].feature] <= self.splits[node].cut
            todo += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
        return out


def derivatives(margins: np.ndarray, target: np.ndarray, s: Settings) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """For each class, from margins [class, row], first and second derivatives of the loss, in whole units; None: one unit."""
    if not s.classes:
        return [(np.rint((margins[0] - target) * UNIT), None)]
    first = margins - margins.max(axis=0)
    np.exp(first, out=first)
    first /= first.sum(axis=0)
    second = 1 - first
    second *= first
    second *= 2
    np.maximum(second, 1e-16, out=second)
    second *= UNIT
    first -= target == np.arange(s.classes)[:, None]
    first *= UNIT
    return list(zip(np.rint(first, out=first), np.rint(second, out=second)))


def gradients(margins: np.ndarray, target: np.ndarray, s: Settings) -> np.ndarray:
    """[class, row, 2]: first and second derivatives of the loss by the margin, in whole units."""
    return np.stack([np.stack([first, np.full_like(first, UNIT) if second is None else second], axis=1)
                     for first, second in derivatives(np.ascontiguousarray(margins.T), target, s)])


def drawn(marks: np.ndarray, s: Settings, number: int) -> np.ndarray:
    """Rows that a round sees: by a hash of the row's mark, the seed and the round."""
    h = marks.view(np.uint64) ^ np.uint64((s.seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return (h >> np.uint64(11)).astype(float) < s.subsample * float(1 << 53)


def _blocks(rows: np.ndarray) -> Iterator[np.ndarray]:
    return (rows[begin:begin + BLOCK] for begin in range(0, len(rows), BLOCK))


def _part(rows: np.ndarray, codes: np.ndarray, cut: int, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers put in order in place, those that go left first; both parts. `spare` has room for all."""
    low = high = 0
    for block in _blocks(rows):
        side = codes.take(block) <= cut
        left, right = block.compress(side), block.compress(~side)  # no branch for each row, unlike block[side]
        rows[low:low + len(left)] = left
        spare[high:high + len(right)] = right
        low, high = low + len(left), high + len(right)
    rows[low:] = spare[:high]
    return rows[:low], rows[low:]


class Stripe:
    """Rows at hand of one fit, or a stretch of them: their margins, their part of every sum, and the leaf each lies in.

    Rows numbered from `held[0]` to `held[1]`, by default those behind the last with a target, are only given margins.
    """

    def __init__(self, columns: Columns, target: np.ndarray, marks: np.ndarray, s: Settings, held: tuple[int, int] | None = None):
        self.columns, self.target, self.marks, self.s = columns, target, marks, s
        every, width = len(columns.table), max(s.classes, 1)
        begin, end = held or (len(target), every)
        self.learned = [(low, min(low + BLOCK, stop)) for start, stop in ((0, begin), (end, every)) for low in range(start, stop, BLOCK)]
        self.margins = np.zeros((width, every))
        # used again in every round
        self.start, self.order, self.spare = (np.empty(every, np.intp) for _ in range(3))
        self.mark, self.seen = np.zeros(every, bool), -1
        self.values = np.zeros((width, every), complex if s.classes else np.int64)
        self.first = None if s.classes else np.zeros(every)

    def begin(self, number: int) -> np.ndarray:
        """The histogram of all rows that the round sees, for each class."""
        if self.s.subsample < 1 or self.seen < 0:
            for low, high in self.learned:
                self.mark[low:high] = drawn(self.marks[low:high], self.s, number) if self.s.subsample < 1 else True
            self.seen = np.count_nonzero(self.mark)
            self.start[:self.seen], self.start[self.seen:] = np.flatnonzero(self.mark), np.flatnonzero(~self.mark)
        if self.s.classes:
            # of shares p the second derivative is 2p(1 - p), half a unit at most
            self.weights = [Weights.given(own, int(UNIT / 2)) for own in self.values]
            for low, high in self.learned:
                for own, (first, second) in zip(self.values, derivatives(self.margins[:, low:high], self.target[low:high], self.s)):
                    second *= self.weights[0].unit
                    second += 1
                    own.real[low:high], own.imag[low:high] = first, second
        else:
            for low, high in self.learned:
                self.first[low:high] = derivatives(self.margins[:, low:high], self.target[low:high], self.s)[0][0]
            self.weights = [Weights(self.first, None, self.values[0])]
        return self.columns.summed([self.start[:self.seen]] * len(self.weights), self.weights)

    def split(self, k: int, asked: Sequence[Split]) -> np.ndarray:
        """Rows go to the children of the splits of class k, the first of which is that of the root; histograms of the smaller ones."""
        if asked[0].node == 1:
            self._gather()
        parts = []
        for split in asked:
            if split.last:
                self.ends.append(split)
                continue
            pairs = [_part(own, self.columns.codes[split.feature], split.cut, self.spare) for own in self.rows.pop(split.node)]
            self.rows[2 * split.node], self.rows[2 * split.node + 1] = zip(*pairs)
            parts.append(self.rows[split.smaller][0])
        return self.columns.summed(parts, self.weights[k])

    def _gather(self) -> None:
        self.order[:] = self.start
        self.rows = {1: (self.order[:self.seen], self.order[self.seen:])}  # by leaf those seen, and the others
        self.ends: list[Split] = []  # last splits

    def settle(self, k: int, values: Mapping[int, float]) -> None:
        """Adds the values of the leaves to the margins of class k."""
        if 1 in values:
            self._gather()
        margins = self.margins[k]
        for split in self.ends:
            both = np.array([values[2 * split.node + 1], values[2 * split.node]])
            for own in self.rows.pop(split.node):
                for block in _blocks(own):
                    side = self.columns.codes[split.feature].take(block) <= split.cut
                    np.add.at(margins, block, both.take(side.view(np.int8)))
        for node, pair in self.rows.items():
            for own in pair:
                for block in _blocks(own):
                    np.add.at(margins, block, values[node])


def _serve(pipe, others: Sequence, stripe: Callable[[], Stripe]) -> None:
    for other in others:
        other.close()
    own = stripe()
    while True:
        try:
            name, *args = pipe.recv()
        except EOFError:
            return
        found = getattr(own, name)(*args)
        if found is not None:
            pipe.send(found)


class Stripes:
    """As `Stripe`, dealt out to processes that end with this one; whole sums make the trees the same."""

    def __init__(self, columns: Columns, target: np.ndarray, marks: np.ndarray, s: Settings, processes: int):
        forked, self.pipes = get_context("fork"), []
        for begin, end in pairwise(np.linspace(0, len(target), processes + 1).astype(int)):
            here, there = forked.Pipe()
            self.pipes.append(here)
            own = partial(Stripe, columns.stretch(begin, end), target[begin:end], marks[begin:end], s)
            forked.Process(target=_serve, args=(there, list(self.pipes), own), daemon=True).start()
            there.close()

    def _sums(self, *call) -> np.ndarray:
        for pipe in self.pipes:
            pipe.send(call)
        return sum(pipe.recv() for pipe in self.pipes)

    def begin(self, number: int) -> np.ndarray:
        return self._sums("begin", number)

    def split(self, k: int, asked: Sequence[Split]) -> np.ndarray:
        return self._sums("split", k, asked)

    def settle(self, k: int, values: Mapping[int, float]) -> None:
        for pipe in self.pipes:
            pipe.send(("settle", k, values))

    def close(self) -> None:
        for pipe in self.pipes:
            pipe.close()


def _grown(rows: Stripe | Stripes, number: int, s: Settings) -> list[Tree]:
    """The trees of a round, whose values are added to the margins."""
    trees = []
    for k, root in enumerate(rows.begin(number)):
        growing = Growing(root, s)
        while asked := growing.wanted(ahead=False):
            growing.take(asked, rows.split(k, asked))
        rows.settle(k, growing.values())
        trees.append(growing.tree())
    return trees


def fewest_rows(trees: Sequence[Tree]) -> int:
    """Of all leaves. A tree is the same for every `min_child_samples` up to the rows of its smallest leaf."""
    return min(int(tree.rows[tree.feature < 0].min()) for tree in trees)


def boosted_alike(columns: Columns, target: np.ndarray, marks: np.ndarray, family: Sequence[Settings],
                  held: tuple[int, int] | None = None) -> Iterator[list[tuple[list[Settings], list[Tree], np.ndarray]]]:
    """As `boosted`, of settings that differ in `min_child_samples` and rounds alone: a fit for all of which the trees are the same.

    From the round on in which a setting would change a tree it goes on by itself, so every setting gets its own trees.
    """
    rows = Stripe(columns, target, marks, family[0], held)
    fits = [(sorted(family, key=lambda s: s.min_child_samples), rows.margins)]
    for number in range(max(s.n_estimators for s in family)):
        done, todo = [], fits
        while todo:
            members, rows.margins = todo.pop()
            members = [s for s in members if s.n_estimators > number]
            if not members:
                continue
            before = rows.margins.copy() if len(members) > 1 else None
            trees = _grown(rows, number, members[0])
            fewest = fewest_rows(trees)
            done.append(([s for s in members if s is members[0] or s.min_child_samples <= fewest], trees, rows.margins))
            if others := [s for s in members if s not in done[-1][0]]:
                todo.append((others, before))
        yield done
        fits = [(members, margins) for members, _, margins in done]


def boosted(columns: Columns, target: np.ndarray, marks: np.ndarray, s: Settings,
            held: tuple[int, int] | None = None) -> Iterator[tuple[list[Tree], np.ndarray]]:
    """The trees of each round, from rows at hand, and the margins [class, row] after it, which change in place.

    `target` and `marks` are of all rows, or of the first ones; see `Stripe` for those that are only given margins.
    """
    for [(_, trees, margins)] in boosted_alike(columns, target, marks, [s], held):
        yield trees, margins


def fit_rows(codes: np.ndarray | Columns, target: np.ndarray, marks: np.ndarray, s: Settings, processes: int = 1) -> Iterator[list[Tree]]:
    """The trees of each round, from rows at hand, which `processes` may share."""
    columns = codes if isinstance(codes, Columns) else Columns(codes)
    rows = Stripes(columns, target, marks, s, processes) if processes > 1 else Stripe(columns, target, marks, s)
    try:
        for number in range(s.n_estimators):
            yield _grown(rows, number, s)
    finally:
        if processes > 1:
            rows.close()


def _lists(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width).astype(kind, copy=False)


def _advanced(trees: list[Tree], s: Settings, number: int, features: int):
    """Margins after the given trees, and the gradients of the next round (none for rows it does not see)."""
    width = max(s.classes, 1)

    @F.arrow_udf("struct<margins:array<double>,sums:array<double>>")
    def advance(codes: pa.Array, target: pa.Array, mark: pa.Array, margins: pa.Array) -> pa.Array:
        own, now = _lists(codes, features, np.int64), _lists(margins, width, float).copy()
        for k, tree in enumerate(trees):
            now[:, k] += tree.value[tree.leaf_of(own)]
        sums = gradients(now, np.asarray(target), s).transpose(1, 0, 2).reshape(len(now), -1)
        seen = drawn(np.asarray(mark), s, number) if s.subsample < 1 else np.ones(len(now), bool)
        array = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(now) + 1, dtype=np.int32) * sums.shape[1]), pa.array(sums.ravel()),
                                        mask=pa.array(~seen))
        return pa.StructArray.from_arrays([array(now), sums], names=["margins", "sums"])
    return advance


CELLS = "tree int, part int, cell int, first double, second double, n bigint"


def _summed(state: DataFrame, growing: Sequence[Growing | None], asked: Sequence[Sequence[Split]], features: int) -> list[np.ndarray]:
    """Histograms of what is asked for in each tree, summed inside partitions, then by shuffle, and collected.

    A `growing` of None asks for the root.
    """
    wanted = [{split.smaller: i for i, split in enumerate(splits)} if tree else {1: 0} for tree, splits in zip(growing, asked)]
    size = features * BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(parts), features, BINS, 3)) for parts in wanted]
        for batch in batches:
            codes, sums = _lists(batch.column(0), features, np.int64), _lists(batch.column(1), 2 * len(wanted), float)
            for k, parts in enumerate(wanted):
                if not parts:
                    continue
                if growing[k] is None:
                    part = np.zeros(len(codes), np.int64)
                else:
                    # a row may lie deeper than a child asked for now: of those none is split yet
                    part = np.array([parts.get(node, -1) for node in growing[k].place(codes)], np.int64)
                own = part >= 0
                totals[k] += histograms(codes[own], sums[own, 2 * k:2 * k + 2], part[own], len(parts))
        for k, total in enumerate(totals):
            flat = total.reshape(-1, 3)
            cell = np.flatnonzero(flat[:, 2])
            n = len(cell)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, k, np.int32)), pa.array((cell // size).astype(np.int32)), pa.array((cell % size).astype(np.int32)),
                 pa.array(flat[cell, 0]), pa.array(flat[cell, 1]), pa.array(flat[cell, 2].astype(np.int64))],
                names=["tree", "part", "cell", "first", "second", "n"])

    cells = (state.where("sums is not null").select("codes", "sums").mapInArrow(count, CELLS)
             .groupBy("tree", "part", "cell").agg(F.sum("first").alias("first"), F.sum("second").alias("second"), F.sum("n").alias("n")))
    found = cells.toArrow()
    out = [np.zeros((len(parts), size, 3)) for parts in wanted]
    tree, part, cell = (np.asarray(found[c].combine_chunks()) for c in ("tree", "part", "cell"))
    values = np.stack([np.asarray(found[c].combine_chunks()).astype(float) for c in ("first", "second", "n")], axis=1)
    for k in range(len(out)):
        own = tree == k
        out[k][part[own], cell[own]] = values[own]
    return [hists.reshape(-1, features, BINS, 3) for hists in out]


def fit_table(rows: DataFrame, features: int, s: Settings) -> Iterator[list[Tree]]:
    """The trees of each round from `rows` (codes, target, mark), which stay in Spark.

    Margins and gradients of a round are a stored table. Executors that are lost cost their own tasks.
    """
    width = max(s.classes, 1)
    zeros = F.array(*[F.lit(0.0)] * width)
    state, trees = rows.select("codes", "target", "mark", zeros.alias("margins")), []
    for number in range(s.n_estimators):
        step = _advanced(trees, s, number, features)("codes", "target", "mark", "margins")
        state = stage(state.select("codes", "target", "mark", step.alias("now")).select("codes", "target", "mark", "now.*"), "boosting")
        roots = _summed(state, [None] * width, [()] * width, features)
        growing = [Growing(hists[0], s) for hists in roots]
        while any(asked := [tree.wanted(ahead=True) for tree in growing]):
            below = [[split for split in splits if not split.last] for splits in asked]
            found = _summed(state, growing, below, features) if any(below) else below
            for tree, splits, hists in zip(growing, asked, found):
                if splits:
                    tree.take(splits, hists)
        trees = [tree.tree() for tree in growing]
        state = state.drop("sums")
        yield trees
