"""Periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words that repeats with a smallest period q, at least twice and over `SHORTEST` words, and that no
neighbour extends. Its last two periods are a branching square: the suffixes at their starts agree in exactly q words. So

1. suffixes are sorted (prefix doubling, only what is still tied is sorted again) and neighbours' common lengths taken
   from the ranks of the doublings;
2. LCP intervals are found as nearest smaller values on both sides; the intervals' own minima part each into children.
   There are no tree nodes;
3. for an interval of depth d, each suffix i outside its largest child asks whether the suffix at i + d or i - d lies in
   the interval (by the inverse array), and whether the words behind differ: then it is a branching square. Smaller
   children hold n log n suffixes in all;
4. squares are rotated to the left as far as words agree, and those that come to the same stretch are merged, with the
   smallest period.

All texts of a megabyte go through these steps at once, as arrays of numbers; a word is numbered per text, so texts never
match each other. Any word of a run lies in a sequence of six words that its text holds twice, so words in no such
sequence are left out before step 1, and a stop stands where they were. That loses no run: a run never spans such a word.

Every text is worked on by itself, whole, in the task that read it: nothing is shuffled, and memory follows the longest text.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import WHITE, mix, slices, word_table, words

#: Fewest words of a run.
SHORTEST = 12
_WORD = word_table(WHITE)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def numbered_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words only; the words' bytes one after the other, and where each begins."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = np.ascontiguousarray(data[_WORD[data]])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64), packed, bounds


def repeated_parts(codes: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Whether each word lies in some sequence of k words that its text holds at least twice."""
    n = len(codes) - k + 1
    covered = np.zeros(len(codes) + 1, np.int32)
    if n > 0:
        total = mix(rows[:n].astype(np.uint64) * _STEP)
        for step in range(k):
            total = mix(total + codes[step:step + n].astype(np.uint64) + np.uint64(step + 1))
        inside = np.flatnonzero(rows[:n] == rows[k - 1:])
        order = inside[np.argsort(total[inside], kind="stable")]
        same = total[order[1:]] == total[order[:-1]]
        twice = order[np.append(same, False) | np.append(False, same)] if len(order) else order
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + k, -1)
    return np.cumsum(covered)[:len(codes)] > 0


def suffixes(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes of s, whose last number stands nowhere else, and for each power 2^r the rank of the 2^r numbers at a place."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    head = np.concatenate([[True], s[order][1:] != s[order][:-1]])
    places = np.arange(n)
    group = np.maximum.accumulate(np.where(head, places, 0))
    rank = np.empty(n, np.int32)
    rank[order] = group
    ranks, length = [rank], 1
    while True:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            return order, ranks
        first = order[tied]
        key = group[tied] * n + rank[first + length]
        by = np.argsort(key, kind="stable")
        order[tied], key = first[by], key[by]
        head[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(head, places, 0))
        rank = rank.copy()
        rank[order[tied]] = group[tied]
        ranks.append(rank)
        length *= 2


def common_lengths(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """How many numbers each sorted suffix has in common with the one before it; -1 before the first and behind the last."""
    a, b = order[:-1].copy(), order[1:].copy()
    for r in range(len(ranks) - 1, -1, -1):
        step = (ranks[r][a] == ranks[r][b]).astype(np.int64) << r
        a += step
        b += step
    return np.concatenate([[-1], b - order[1:], [-1]])


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """The last place before each with a smaller value, for values above 0; jumps grow, since places jumped to have jumped too."""
    at = np.arange(len(values)) - 1
    todo = np.flatnonzero(values > 0)
    todo = todo[values[at[todo]] >= values[todo]]
    while len(todo):
        at[todo] = at[at[todo]]
        todo = todo[values[at[todo]] >= values[todo]]
    return at


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of every square of s whose next number differs from the one half a square before it."""
    n = len(s)
    order, ranks = suffixes(s)
    common = common_lengths(order, ranks)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    low = _nearest_smaller(common)
    high = n - _nearest_smaller(common[::-1])[::-1]
    minima = np.flatnonzero(common > 0)
    if not len(minima):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    minima = minima[np.lexsort((minima, high[minima], low[minima]))]
    lo, hi = low[minima], high[minima]
    begins = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    interval = np.cumsum(begins) - 1
    last = np.append(begins[1:], True)
    # children: one from the interval's start to its first minimum, one from each minimum to the next or to the end
    first = np.concatenate([lo[begins], minima])
    end = np.concatenate([minima[begins], np.where(last, hi, np.append(minima[1:], 0))])
    of = np.concatenate([interval[begins], interval])
    depth = common[minima[begins]]
    by_size = np.lexsort((end - first, of))
    smaller = by_size[:-1][of[by_size[1:]] == of[by_size[:-1]]]
    sizes = end[smaller] - first[smaller]
    members = np.arange(sizes.sum()) + np.repeat(first[smaller] - np.cumsum(sizes) + sizes, sizes)
    own = np.repeat(of[smaller], sizes)
    i, d = order[members], depth[own]
    left, right = lo[begins][own], hi[begins][own]
    found = []
    for other in (i + d, i - d):
        ok = np.flatnonzero(other >= 0)
        at = place[other[ok]]
        ok = ok[(left[ok] <= at) & (at < right[ok])]
        start = np.minimum(i[ok], other[ok])
        branching = s[start + d[ok]] != s[start + 2 * d[ok]]
        found.append(start[branching] * (n + 1) + d[ok][branching])
    both = np.unique(np.concatenate(found))
    return both // (n + 1), both % (n + 1)


def _agreeing_before(s: np.ndarray, a: int, period: int) -> int:
    """The first place from which s agrees with itself a period later, up to a."""
    width = 16
    while a > 0:
        width = min(2 * width, a)
        differ = np.flatnonzero(s[a - width:a] != s[a - width + period:a + period])
        if len(differ):
            return a - width + int(differ[-1]) + 1
        a -= width
    return 0


def merged_runs(s: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of s of at least `shortest` numbers, by end and period."""
    starts, halves = branching_squares(s)
    ends = starts + 2 * halves
    out: list[tuple[int, int, int]] = []
    same_end: list[tuple[int, int]] = []
    seen = -1
    for k in np.lexsort((halves, ends)).tolist():
        start, end, period = int(starts[k]), int(ends[k]), int(halves[k])
        if end != seen:
            seen, same_end = end, []
        # a multiple of a period whose run reaches back that far is that run again
        if any(period % p == 0 and start >= first for first, p in same_end):
            continue
        start = _agreeing_before(s, start, period)
        if all(first != start for first, _ in same_end):
            same_end.append((start, period))
            if end - start >= shortest:
                out.append((start, end, period))
    return out


def word_runs(codes: np.ndarray, rows: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, by start and period; codes are words, rows the texts they belong to, in order."""
    kept = np.flatnonzero(repeated_parts(codes, rows, shortest // 2))
    none = np.zeros(0, np.int64)
    if not len(kept):
        return none, none, none
    cut = np.concatenate([[True], (np.diff(kept) != 1) | (np.diff(rows[kept]) != 0)])
    stretch = np.cumsum(cut) - 1
    s = -1 - np.arange(len(kept) + stretch[-1] + 1)
    at = np.arange(len(kept)) + stretch
    s[at] = rows[kept] * (int(codes.max()) + 1) + codes[kept]
    back = np.full(len(s), -1)
    back[at] = kept
    found = np.array(merged_runs(s, shortest), np.int64).reshape(-1, 3)
    start, end, period = back[found[:, 0]], back[found[:, 1] - 1] + 1, found[:, 2]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def cycled(rows: np.ndarray, per_row: np.ndarray, first: np.ndarray, ids: list) -> np.ndarray:
    """Which word stands at each place once every tenth text, by the CRC-32 of its id, goes round in a circle from some word on."""
    source = np.arange(len(rows))
    for row, doc_id in enumerate(ids):
        n, base = int(per_row[row]), int(first[row])
        h = crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[base + a:base + n] = base + a + np.arange(n - a) % p
    return source


def _found(ids: list, data: np.ndarray, offsets: np.ndarray, cycle: bool, shortest: int):
    """Per text: words, runs as (start, length, period) and the text with repeats dropped."""
    starts, ends, rows = words(data, offsets, _WORD)
    n = len(offsets) - 1
    per_row = np.bincount(rows, minlength=n)
    first = np.cumsum(per_row) - per_row
    codes, packed, bounds = numbered_words(data, starts, ends)
    source = cycled(rows, per_row, first, ids) if cycle else np.arange(len(rows))
    begin, end, period = word_runs(codes[source], rows, shortest)
    drop = np.zeros(len(rows) + 1, np.int32)
    np.add.at(drop, begin + period, 1)
    np.add.at(drop, end, -1)
    keep = np.cumsum(drop)[:len(rows)] == 0
    chosen = source[keep]
    lengths = bounds[chosen + 1] - bounds[chosen]
    joined = np.full(int(lengths.sum()) + len(chosen), 0x20, np.uint8)
    into = np.cumsum(lengths + 1) - lengths - 1
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[np.repeat(into, lengths) + within] = packed[np.repeat(bounds[chosen], lengths) + within]
    kept_of = np.bincount(rows[keep], minlength=n)
    text_end = np.concatenate([[0], np.cumsum(lengths + 1)])[np.cumsum(kept_of)]
    raw, cuts = joined.tobytes(), np.concatenate([[0], text_end]).tolist()
    texts = [raw[i:max(i, j - 1)].decode() for i, j in zip(cuts, cuts[1:])]
    of = rows[begin] if len(begin) else np.zeros(0, np.int64)
    run_ends = np.searchsorted(of, np.arange(n), "right")
    return per_row, run_ends, begin - first[of], end - begin, period, texts


def _finder(cycle: bool, shortest: int):
    @F.arrow_udf("struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def find(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        ids, row = doc_id.to_pylist(), 0
        counts, run_ends, columns, texts, before = [], [0], ([], [], []), [], 0
        for data, offsets in slices(text):
            n = len(offsets) - 1
            per_row, ends, *runs, kept = _found(ids[row:row + n], data, offsets, cycle, shortest)
            counts += per_row.tolist()
            run_ends += (ends + before).tolist()
            before = run_ends[-1]
            for column, values in zip(columns, runs):
                column.append(values)
            texts += kept
            row += n
        fields = [pa.array(np.concatenate([np.zeros(0, np.int64), *c])) for c in columns]
        runs = pa.ListArray.from_arrays(pa.array(run_ends, pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), runs, pa.array(texts, pa.string())],
                                          names=["n_words", "runs", "collapsed"])
    return find


def runs(docs: DataFrame, cycle: bool = False, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, `runs` (start, length and period in words, by start and period) and `collapsed`, the words that
    no run holds after its first period, joined by one blank.

    Words are parted by white space of ASCII. NULL and empty texts, and those of blanks alone, have no words, no runs and an
    empty `collapsed`. Every row is judged by itself: repeated rows and ids, and rows without an id, are all kept. An empty
    table gives none. Columns other than doc_id and text, whatever their names, are left out. With `cycle`, texts are
    changed first as `cycled` tells (a NULL id changes nothing).
    """
    found = docs.select("doc_id", _finder(cycle, shortest)(F.col("doc_id").cast("bigint"), F.col("text")).alias("found"))
    return found.select("doc_id", "found.n_words", "found.runs", "found.collapsed")


def report(found: DataFrame) -> DataFrame:
    """Per row of `runs`: how many, the longest (ties: first start, then shortest period), and digests of runs and text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best")["col3"]
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best")["col2"]).alias("start"), length.alias("length"),
        period.alias("period"), F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
