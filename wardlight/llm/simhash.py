"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of the text's word shingles. Two that
differ in at most three bits differ in at most two outside one of the three parts of the 64 bits (the part with the
most differences, left out). So every fingerprint emits, for each part left out, all variants of the other bits within
one bit, half of two: the balls of two such fingerprints meet in a variant. Variants are dealt by shuffle, those met by
one fingerprint alone fall away, and the rest are verified on all 64 bits. Equal fingerprints are one before that, so
groups of copies cost one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import WHITE, lower_ascii, slices, stage, word_table, words
from wardlight.llm.graph import linked

SEED = 42
RADIUS = 3
#: First bits of the parts that are left out in turn, and the end.
PARTS = (0, 22, 43, 64)

_WORD = word_table(WHITE)


def _shingle_rows(rows: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and row of each shingle of k words; the whole row where it has fewer."""
    per_row = np.bincount(rows, minlength=n)
    first_word = np.cumsum(per_row) - per_row
    short = np.flatnonzero((per_row > 0) & (per_row < k))
    full = np.flatnonzero(rows[k - 1:] == rows[:len(rows) - k + 1]) if len(rows) >= k else np.zeros(0, np.int64)
    first = np.concatenate([full, first_word[short]])
    last = np.concatenate([full + k - 1, first_word[short] + per_row[short] - 1])
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    return first, last, rows[first]


def _majority(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the number whose bits are set in over half of its hashes; rows are in order."""
    out = np.zeros(n, np.uint64)
    if len(hashes):
        begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
        sizes = np.diff(np.concatenate([begins, [len(hashes)]]))
        out[rows[begins]] = np.packbits(2 * sums > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """SimHash of every row over shingles of k words: XXH64 with seed 42 of the words joined by spaces, repeats included."""
    data = lower_ascii(data)
    starts, ends, rows = words(data, offsets, _WORD)
    lengths = ends - starts
    joined = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    joined[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = data[_WORD[data]]
    begin = np.cumsum(lengths + 1) - lengths - 1
    first, last, of = _shingle_rows(rows, len(offsets) - 1, k)
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[i:j], SEED) for i, j in zip(begin[first].tolist(), (begin + lengths)[last].tolist())),
                         np.uint64, len(first))
    return _majority(hashes, of, len(offsets) - 1)


def fingerprint(k: int):
    """A column function: text to fingerprint, as the signed number of its 64 bits. Zero without words."""
    @F.arrow_udf("bigint")
    def of(text: pa.Array) -> pa.Array:
        parts = [fingerprints(data, offsets, k) for data, offsets in slices(text)]
        return pa.array(np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64))
    return of


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def ball_keys(bits: Column) -> Column:
    """The keys of all variants: with each part left out, the other bits as they are and with each of them flipped."""
    def without(low: int, high: int) -> Column:
        others = ((1 << 64) - 1) ^ (((1 << high) - 1) ^ ((1 << low) - 1))
        flips = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << b)) for b in range(64) if others >> b & 1])
        rest = bits.bitwiseAND(F.lit(_signed(others)))
        return F.transform(flips, lambda flip: F.xxhash64(F.lit(low), rest.bitwiseXOR(flip)))
    return F.concat(*[without(low, high) for low, high in zip(PARTS, PARTS[1:])])


def within(pairs: DataFrame, radius: int = RADIUS) -> DataFrame:
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _spread(nodes: DataFrame) -> DataFrame:
    """The same rows over as many tasks as a shuffle has: each becomes over a hundred, so a few tasks won't do.

    Dealt by a hash of the node: a dealing by the node itself is taken for the one that `distinct` has made, and left out.
    """
    return nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("node"))


def linked_fingerprints(prints: DataFrame) -> DataFrame:
    """(node, root) of the distinct fingerprints (`bits`) that links of at most three bits join."""
    nodes = _spread(prints.select(F.col("bits").alias("node")).distinct())
    return linked(nodes.select(F.explode(ball_keys(F.col("node"))).alias("key"), "node"), within)


def components(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (`bits`) and component_id (the smallest doc_id reachable) of every row of `docs`.

    Texts without words have fingerprint zero and link like all others. Repeated rows and ids are all kept; a row
    whose doc_id is NULL counts for links but names no component (NULL only if no row of its component has an id).
    An empty table gives no rows; columns other than doc_id and text are left out.
    """
    prints = stage(docs.select("doc_id", fingerprint(shingle)("text").alias("bits")), "fingerprints")
    roots = stage(linked_fingerprints(prints), "fingerprint-roots")
    firsts = prints.groupBy("bits").agg(F.min("doc_id").alias("first"))
    joined = firsts.join(roots.withColumnRenamed("node", "bits"), "bits")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    wide = joined.join(least, "root").select("bits", "least")
    named = firsts.join(wide, "bits", "left").select("bits", F.coalesce("least", "first").alias("component_id"))
    return prints.join(named, "bits").select("doc_id", "bits", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """`docs` with the same columns and one row of each component: that with the smallest doc_id.

    Rows that repeat this id are told apart by a hash of all their columns, the smallest stays; of equal rows one does. A
    component whose rows all lack an id keeps one of them in the same way.
    """
    def own_hash(side: str = "") -> Column:
        return F.xxhash64(*[F.col(f"{side}`{c}`") for c in docs.columns])

    def those(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.alias("r").join(keys.alias("k"), F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (own_hash("r.") == F.col("k.h")), how)
    prints = stage(docs.select("doc_id", own_hash().alias("h"), fingerprint(shingle)("text").alias("bits")), "fingerprints")
    roots = linked_fingerprints(prints).withColumnRenamed("node", "bits")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h")
    per_print = (prints.groupBy("bits").agg(F.min(rank).alias("first")).join(roots, "bits", "left")
                 .select("bits", "first", F.coalesce("root", "bits").alias("root")))
    per_print = stage(per_print, "print-firsts")
    best = per_print.groupBy("root").agg(F.min("first").alias("best"))
    firsts = stage(per_print.join(best, "root").select("bits", "best"), "component-firsts")
    gone = stage(prints.join(firsts, "bits").where(rank > F.col("best")).select("doc_id", "h").distinct(), "later-copies")

    kept = those(docs, gone, "left_anti")
    twice = prints.join(firsts, "bits").where(rank == F.col("best")).groupBy("doc_id", "h").count().where("count > 1")
    twice = stage(twice, "repeated-rows")
    if twice.isEmpty():
        return kept
    return those(kept, twice, "left_anti").union(those(kept, twice, "left_semi").dropDuplicates())
