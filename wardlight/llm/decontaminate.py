"""Benchmark decontamination: token windows of every text looked up in a broadcast hash set of benchmark windows.

A window is `width` consecutive normalised words of a benchmark item; an item with fewer words is one window. The
hashes of all windows go to every executor, a bitmap in front of the sorted hashes. Tasks hash the windows of their
texts in numpy, compare the words of each hit with the window's own words, and mark the hit words. A benchmark beyond
`SET_WINDOWS` windows is worked off in blocks of items of that size, a stored pass for each, and the marks are put
together: driver and executors hold one block at a time, whatever the benchmark's size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import Prefix, lower_ascii, mix, slices, stage, word_table, words

WIDTH = 10
#: Most windows in one broadcast set; a window takes about 30 bytes.
SET_WINDOWS = 2_000_000
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
MARKS = "struct<n_words:bigint,hits:array<struct<first:bigint,last:bigint>>,items:array<string>,spans:array<struct<first:bigint,last:bigint>>>"

_WORD = word_table(SEPARATORS)
_STEP = 0xC2B2AE3D27D4EB4F


def _window_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        total = total * np.uint64(_STEP) + hashes[at + k]
    return mix(total ^ np.uint64(n))


class WindowSet:
    """Windows of benchmark items: for each number of words sorted hashes, with their places in the normalised items."""

    def __init__(self, items: list[tuple[str, str]], width: int = WIDTH):
        found, texts, size = defaultdict(list), [], 0
        for number, (_, text) in enumerate(items):
            data = lower_ascii(np.frombuffer(text.encode(), np.uint8))
            starts, ends, _ = words(data, np.array([0, len(data)]), _WORD)
            if not len(starts):
                continue
            n = min(width, len(starts))
            at = np.arange(len(starts) - n + 1)
            lengths = ends - starts
            places = size + np.concatenate([[0], np.cumsum(lengths + 1)])
            found[n].append((_window_hash(Prefix(data).hash(starts, ends), at, n), places[at], places[at + n] - 1,
                             np.full(len(at), number)))
            texts.append(b" ".join(data[i:j].tobytes() for i, j in zip(starts, ends)) + b" ")
            size += len(texts[-1])
        self.text, self.names, self.lengths, self.bits = b"".join(texts), [i for i, _ in items], {}, {}
        for n, parts in found.items():
            keys, begin, end, item = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(keys, kind="stable")
            self.lengths[n] = keys[order], begin[order], end[order], item[order].astype(np.int32)

    def __getstate__(self):
        return self.__dict__ | {"bits": {}}

    def _bitmap(self, n: int) -> tuple[np.ndarray, np.uint64]:
        """A flag for each leading-bits value that any of the hashes has, and by how much to shift for it."""
        if n not in self.bits:
            wide = 24 if len(self.lengths[n][0]) > 50_000 else 20
            flags = np.zeros(1 << wide, bool)
            flags[self.lengths[n][0] >> np.uint64(64 - wide)] = True
            self.bits[n] = flags, np.uint64(64 - wide)
        return self.bits[n]

    def mark(self, data: np.ndarray, offsets: np.ndarray):
        """Words per row; for rows with hits, (word from, word to, item) of each; byte ranges of all words; first words."""
        data = lower_ascii(data)
        starts, ends, rows = words(data, offsets, _WORD)
        n_words = np.bincount(rows, minlength=len(offsets) - 1)
        first_word = np.concatenate([[0], np.cumsum(n_words)])
        hashes = Prefix(data).hash(starts, ends)
        hits = defaultdict(list)
        for n, (keys, begin, end, item) in self.lengths.items():
            flags, shift = self._bitmap(n)
            at = np.flatnonzero(rows[n - 1:] == rows[:len(rows) - n + 1]) if len(rows) >= n else np.zeros(0, np.int64)
            h = _window_hash(hashes, at, n)
            likely = np.flatnonzero(flags[h >> shift])
            lo, hi = np.searchsorted(keys, h[likely], "left"), np.searchsorted(keys, h[likely], "right")
            for k in np.flatnonzero(hi > lo).tolist():
                w = int(at[likely[k]])
                body = b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(w, w + n))
                row = int(rows[w])
                place = w - int(first_word[row])
                hits[row] += [(place, place + n, self.names[item[p]]) for p in range(lo[k], hi[k])
                              if self.text[begin[p]:end[p]] == body]
        return n_words, {r: found for r, found in hits.items() if found}, starts, ends, first_word


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as ranges that are apart."""
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def _marker(shared):
    @F.arrow_udf(MARKS)
    def mark(text: pa.Array) -> pa.Array:
        known, out = shared.value, []
        for data, offsets in slices(text):
            n_words, hits, starts, ends, first_word = known.mark(data, offsets)
            for row, n in enumerate(n_words.tolist()):
                found = merged([(a, b) for a, b, _ in hits.get(row, ())])
                spans = []
                for a, b in found:
                    begin, end = starts[first_word[row] + a], ends[first_word[row] + b - 1]
                    lead = int(np.count_nonzero((data[offsets[row]:begin] & 0xC0) != 0x80))
                    spans.append({"first": lead, "last": lead + int(np.count_nonzero((data[begin:end] & 0xC0) != 0x80))})
                out.append({"n_words": n, "hits": [{"first": a, "last": b} for a, b in found],
                            "items": sorted({i for *_, i in hits.get(row, ())}), "spans": spans})
        pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("hits", pair), ("items", pa.list_(pa.string())), ("spans", pair)]))
    return mark


def _blocks(benchmark: DataFrame, width: int, set_windows: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most `set_windows` windows (a longer item is its own block); NULL ids or texts are left out."""
    block, size = [], 0
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text")
    for item, text in items.toLocalIterator():
        n = max(1, len(text) // 2 - width + 2)
        if block and size + n > set_windows:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    yield block


def with_marks(docs: DataFrame, benchmark: DataFrame, column: str, width: int = WIDTH,
               set_windows: int = SET_WINDOWS) -> DataFrame:
    """`docs` with a struct `column`: words, ranges of hit words, items found, and the hit spans in code points."""
    spark, passes = docs.sparkSession, []
    blocks = _blocks(benchmark, width, set_windows)
    block = next(blocks)
    while block is not None:
        passes.append(f"{column}{len(passes)}")
        docs = docs.withColumn(passes[-1], _marker(spark.sparkContext.broadcast(WindowSet(block, width)))("text"))
        block = next(blocks, None)
        if block is not None:  # the next set comes when this one is no longer needed
            docs = stage(docs, "marked")
    if len(passes) == 1:
        return docs.withColumnRenamed(passes[0], column)
    each = [F.col(p) for p in passes]
    return docs.withColumn(column, F.struct(
        each[0]["n_words"].alias("n_words"), _joined([e["hits"] for e in each]).alias("hits"),
        F.array_sort(F.array_distinct(F.concat(*[e["items"] for e in each]))).alias("items"),
        _joined([e["spans"] for e in each]).alias("spans"))).drop(*passes)


def _joined(ranges):
    """The union of sorted lists of ranges, as ranges that are apart."""
    return F.aggregate(
        F.array_sort(F.concat(*ranges)), F.array().cast("array<struct<first:bigint,last:bigint>>"),
        lambda done, r: F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= r["first"]), F.concat(
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["first"].alias("first"),
                F.greatest(F.try_element_at(done, F.lit(-1))["last"], r["last"]).alias("last")))))
        .otherwise(F.concat(done, F.array(r))))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, set_windows: int = SET_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings), spans and contaminated, for every row of `docs`.

    NULL and empty texts have no words. Items without words have no windows. Items that repeat an id count once.
    Repeated rows of `docs` are judged each; an empty benchmark contaminates nothing.
    """
    marks = F.col("marks")
    hit = F.aggregate(marks["hits"], F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"])
    return (with_marks(docs.select("doc_id", "text"), benchmark, "marks", width, set_windows)
            .select("doc_id", marks["n_words"].alias("n_words"), hit.alias("n_hit"),
                    F.size(marks["items"]).cast("bigint").alias("n_items"), marks["items"].alias("items"),
                    marks["spans"].alias("spans"), (F.size(marks["hits"]) > 0).alias("contaminated")))


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WIDTH,
          set_windows: int = SET_WINDOWS) -> DataFrame:
    """`docs` with the same columns, without contaminated documents, or with the hit spans cut out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    mark = "__marks__"
    marked = with_marks(docs, benchmark, mark, width, set_windows)
    if remove == "documents":
        return marked.where(F.size(F.col(mark)["hits"]) == 0).select(*docs.columns)
    spans = F.col(mark)["spans"]
    edges = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["last"]))
    ends = F.concat(F.transform(spans, lambda s: s["first"]), F.array(F.length("text").cast("bigint")))
    kept = F.array_join(F.zip_with(edges, ends, lambda a, b: F.substring(
        F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))), "")
    return marked.withColumn("text", F.when(F.size(spans) > 0, kept).otherwise(F.col("text"))).select(*docs.columns)
