"""Records of CSV files whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

A line break ends a record only outside of quotes, and whether a split begins inside of them depends on all text before
it. But only on one bit of it, the parity of its quotes: `survey` counts the quotes of every split in one job over all
files, a running sum over the splits of a file gives each its bit, and then each task can cut its own lines into records.
What hangs over the ends of splits is joined by their order, a few pieces for each split.

The driver holds an entry for each split: one for `spark.sql.files.maxPartitionBytes` of text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, MIDDLE, TAIL, HEADER = range(5)


@dataclass
class File:
    """A file's header record, whether some line holds an odd number of quotes, and for each split (by its first byte)
    whether it begins inside of quotes."""
    header: str | None
    odd: bool
    inside: dict[int, bool]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[str], np.ndarray]]:
    """The lines of each split in a batch, and their quotes."""
    file, block = batch.column(1), np.asarray(batch.column(2))
    quotes = np.asarray(pc.count_substring(pc.fill_null(batch.column(0), ""), '"'))
    change = np.flatnonzero((block[1:] != block[:-1]) | np.asarray(pc.not_equal(file[1:], file[:-1]))) + 1
    cuts = [0, *change.tolist(), len(block)]
    for i, j in zip(cuts, cuts[1:]):
        if i < j:
            yield file[i].as_py(), int(block[i]), batch.column(0)[i:j].to_pylist(), quotes[i:j]


def survey(spark: SparkSession, paths: Sequence[str]) -> dict[str, File]:
    """What is to be known of each file before it is read, by path; files without a line are missing."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for file, block, lines, quotes in _runs(batch):
                entry = found.setdefault((file, block), [0, False, [] if block == 0 else None, False])
                if block == 0 and not entry[3]:
                    for line, n in zip(lines, np.cumsum(quotes) + entry[0]):
                        if line or entry[2]:
                            entry[2].append(line)
                        if entry[2] and n % 2 == 0:
                            entry[3] = True
                            break
                entry[0] += int(quotes.sum())
                entry[1] |= bool((quotes % 2).any())
        for (file, block), (quotes, odd, header, _) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block], pa.int64()), pa.array([quotes % 2 == 1]), pa.array([odd]),
                 pa.array([None if not header else "\n".join(header).removesuffix("\r")], pa.string())],
                names=["file", "block", "flips", "odd", "header"])
    splits = _lines(spark, paths).mapInArrow(count, "file string, block bigint, flips boolean, odd boolean, header string")
    out: dict[str, File] = {}
    inside = False
    for r in sorted(splits.collect(), key=lambda r: (r.file, r.block)):
        if r.file not in out:
            out[r.file], inside = File(r.header, False, {}), False
        out[r.file].inside[r.block] = inside
        out[r.file].odd |= r.odd
        inside ^= r.flips
    return out


def records(spark: SparkSession, files: dict[str, File]) -> DataFrame:
    """(file, record): every record but the first, without its line end; blank lines outside of quotes are none."""
    shared = spark.sparkContext.broadcast({name: file.inside for name, file in files.items()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, kind, odd, first, out = None, [], WHOLE, False, False, []

        def close(last: int) -> None:
            if held:
                out.append((*at, last, "\n".join(held)))
                held.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                                              names=["file", "block", "kind", "piece"])
        for batch in batches:
            for file, block, lines, quotes in _runs(batch):
                if (file, block) != at:
                    close({WHOLE: TAIL, HEAD: MIDDLE, HEADER: HEADER}[kind])
                    at, odd, first = (file, block), shared.value[file][block], block == 0
                    kind = HEAD if odd else WHOLE
                for line, n in zip(lines, (quotes % 2).tolist()):
                    if not (held or odd or line.removesuffix("\r")):
                        continue
                    if first and not held:
                        kind = HEADER
                    held.append(line)
                    odd ^= bool(n)
                    if not odd:
                        first = False
                        close(kind)
                        kind = WHOLE
            yield batch_of()
        close({WHOLE: TAIL, HEAD: MIDDLE, HEADER: HEADER}[kind])
        yield batch_of()

    pieces = _lines(spark, list(files)).mapInArrow(cut, "file string, block bigint, kind int, piece string").where(F.col("kind") != HEADER)
    order = Window.partitionBy("file").orderBy("block", "kind")
    hanging = pieces.where(F.col("kind") != WHOLE).withColumn("number", F.count_if(F.col("kind") == TAIL).over(order))
    # a piece at an end of a split: at most two for each, so a file has few
    joined = hanging.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "piece"))).alias("p"))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", F.col("piece").alias("record"))
    both = whole.union(joined.select("file", F.array_join("p.piece", "\n").alias("record")))
    return both.select("file", F.regexp_replace("record", "\r$", "").alias("record"))
