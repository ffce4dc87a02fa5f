"""Near-duplicate vectors by binary codes under a random rotation, with correction factors.

A vector's code holds the signs of its direction after a random rotation, and next to it the inner product of that sign
vector with the rotated direction: the correction factor. The inner product of the sign vector with another rotated
direction, divided by the factor, is an unbiased estimate of the cosine. Its error is that of one coordinate of a random
direction, times sqrt(1 - factor^2) / factor, times sqrt(1 - cosine^2). So for a link at the threshold the estimate falls
below a bound only with chance `MISS`: pairs below the bound are dropped unseen, all others are computed again exactly, in
double precision, and only those become links.

Which pairs meet: vectors of one label and length. A label of more than `BUCKET` distinct vectors is dealt into buckets by
the sides of b random hyperplanes, in as many independent tables as keep the chance that a link meets in none below `MISS`
(two vectors at an angle a lie on one side with chance 1 - a / pi, b times over). b grows with the logarithm of the label,
so tables do with a small power of it, and work a little faster than the rows, not with their square. Links between
vectors that also meet in an earlier table are left to that.

Equal vectors are one before all this. A bucket of more than `BLOCK` is split by a hash into blocks, and a task has one
pair of blocks, so a group that holds a third of all rows fills no task. A task gives a row for each linked vector: how
many it found, and the lowest vector that they lead to; pairs themselves never leave it, however dense a group.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm import graph
from wardlight.llm.common import stage

THRESHOLD = 0.93
#: Chance at most, for a pair just at the threshold, to meet in no table, and again for its estimate to be below its bound.
MISS = 1e-7
BUCKET, BLOCK = 8192, 4096
SEED = 42
_ROWS, _PAIRS, _ROUNDING = 512, 1 << 16, 1e-5

_rotations: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    """The random rotation of vectors of a length, the same in every task."""
    if size not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng([SEED, size]).normal(size=(size, size)))
        _rotations[size] = q * np.sign(np.diag(r))
    return _rotations[size]


def hyperplanes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, bits, 1]).normal(size=(size, bits * tables))


def bits_for(n: int, bucket: int = BUCKET) -> int:
    """Hyperplanes of a table for a label of n vectors: buckets hold about `bucket`."""
    return max(0, ceil(log2(max(n, 1) / bucket)))


def tables_for(bits: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Tables such that a pair at the threshold meets in one, but for chance `miss`."""
    meet = (1 - acos(threshold) / pi) ** bits
    return 1 if bits == 0 else ceil(log(miss) / log(1 - meet))


def directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision; scaled first, so no square overflows or vanishes."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed signs) and correction factors of directions."""
    rotated = unit @ rotation(unit.shape[1]).T
    return np.packbits(rotated > 0, axis=1, bitorder="little"), np.abs(rotated).sum(axis=1) / sqrt(unit.shape[1])


def signs(codes: np.ndarray, size: int) -> np.ndarray:
    return (2.0 * np.unpackbits(codes, axis=1, count=size, bitorder="little") - 1.0) / sqrt(size)


def lower_bounds(factors: np.ndarray, size: int, threshold: float, miss: float = MISS) -> np.ndarray:
    """What the estimate of a pair at the threshold, or closer, reaches but for chance `miss`."""
    reach = 1.0 if size <= 3 else sqrt(1 - miss ** (2 / (size - 3)))
    spread = np.sqrt(np.maximum(1 - factors * factors, 0)) / factors
    return threshold - spread * sqrt(1 - threshold * threshold) * reach - _ROUNDING


def _merge(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lowest row of each row's component, once rows a and b are joined as well."""
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            return low
        onto = np.arange(len(low))
        np.minimum.at(onto, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(onto, onto[onto]):
            onto = onto[onto]
        low = onto[low]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, size)


def links(unit: np.ndarray, codes: np.ndarray, factors: np.ndarray, keys: np.ndarray, table: int, left: np.ndarray,
          right: np.ndarray, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights linked to each row, lowest row that it leads to, and how many pairs were computed exactly.

    Of the pairs of a row of `left` with one of `right`; where these are the same rows, of each pair once.
    """
    n, size = unit.shape
    counts, low, tried = np.zeros(n, np.int64), np.arange(n), 0
    same = len(left) == len(right) and np.array_equal(left, right)
    turned = (unit[right] @ rotation(size).T).astype(np.float32).T
    bounds = lower_bounds(factors, size, threshold)
    for k in range(0, len(left), _ROWS):
        rows = left[k:k + _ROWS]
        estimates = signs(codes[rows], size).astype(np.float32) @ turned / factors[rows, None].astype(np.float32)
        x, y = np.nonzero(estimates >= bounds[rows, None].astype(np.float32))
        if same:
            once = y > x + k
            x, y = x[once], y[once]
        tried += len(x)
        for p in range(0, len(x), _PAIRS):
            a, b = rows[x[p:p + _PAIRS]], right[y[p:p + _PAIRS]]
            linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[linked], b[linked]
            if table:
                fresh = ~(keys[a, :table] == keys[b, :table]).any(axis=1)
                a, b = a[fresh], b[fresh]
            counts += np.bincount(a, weights[b], n).astype(np.int64) + np.bincount(b, weights[a], n).astype(np.int64)
            low = _merge(low, a, b)
    return counts, low, tried


def _valid(c: Column) -> Column:
    known = F.forall(c, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(known & F.exists(c, lambda x: x != 0), F.lit(False))


def _coder(threshold: float):
    @F.arrow_udf("struct<code:binary,factor:double,keys:array<bigint>>")
    def code(embedding: pa.Array, bits: pa.Array) -> pa.Array:
        lengths, b = np.asarray(embedding.value_lengths()), np.asarray(bits)
        codes, factors, keys = [None] * len(lengths), np.zeros(len(lengths)), [None] * len(lengths)
        for size, n_bits in set(zip(lengths.tolist(), b.tolist())):
            at = np.flatnonzero((lengths == size) & (b == n_bits))
            unit = directions(np.asarray(embedding.take(pa.array(at)).flatten()).reshape(-1, size))
            packed, factors[at] = encode(unit)
            tables = tables_for(n_bits, threshold)
            sides = (unit @ hyperplanes(size, n_bits, tables) > 0).reshape(len(at), tables, n_bits)
            numbers = (sides * (1 << np.arange(n_bits))).sum(axis=2)
            for row, c, k in zip(at.tolist(), packed, numbers):
                codes[row], keys[row] = c.tobytes(), k
        return pa.StructArray.from_arrays([pa.array(codes, pa.binary()), pa.array(factors), pa.array(keys, pa.list_(pa.int64()))],
                                          names=["code", "factor", "keys"])
    return code


GROUP = ["label", "size", "table", "bucket"]


def _matcher(threshold: float):
    def match(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        size, table, i, j = (rows[c][0].as_py() for c in ("size", "table", "i", "j"))
        block = np.asarray(rows["block"])
        keys = np.asarray(rows["keys"].combine_chunks().flatten()).reshape(len(rows), -1)
        codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
        counts, low, _ = links(directions(_matrix(rows["embedding"], size)), codes, np.asarray(rows["factor"]), keys, table,
                               np.flatnonzero(block == i), np.flatnonzero(block == j), np.asarray(rows["copies"]), threshold)
        node, found = np.asarray(rows["node"]), np.flatnonzero(counts)
        return pa.table({"node": node[found], "n": counts[found], "low": node[low[found]]})
    return match


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and `kept` of every row of `vectors` (vec_id, embedding, label).

    Linked are rows of one label, and of vectors of one length, whose cosine is at least `threshold`; copies of a vector
    link with each other. Rows whose label is NULL, and vectors that are NULL, empty, zero or hold a NULL or a number that
    is not finite, link with nothing. Repeated rows and ids count as rows of their own, and each is given; a row without an
    id counts for others' links, and names no component (NULL only where no row of it has an id; it is not kept). Other
    columns, whatever their names, are left out. An empty table gives no rows.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    usable = F.col("label").isNotNull() & _valid(F.col("embedding"))
    classes = stage(rows.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                    .select("*", F.size("embedding").alias("size"), F.monotonically_increasing_id().alias("node")), "vector-classes")
    wide = F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / bucket))).cast("int")
    labels = stage(classes.groupBy("label", "size").count().select("label", "size", wide.alias("bits")), "label-sizes")
    coded = stage(classes.join(labels, ["label", "size"]).select("*", _coder(threshold)("embedding", "bits").alias("c"))
                  .select("label", "size", "embedding", "copies", "node", "c.*"), "vector-codes")
    dealt = coded.select("*", F.posexplode("keys").alias("table", "bucket"))
    large = stage(dealt.groupBy(*GROUP).count().where(F.col("count") > block)
                  .select(*GROUP, F.ceil(F.col("count") / block).cast("int").alias("blocks")), "large-buckets")
    parted = (dealt.join(large, GROUP, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pairs = parted.select(*GROUP, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node",
                          "copies", "embedding", "code", "factor", "keys")
    found = stage(pairs.groupBy(*GROUP, "i", "j").applyInArrow(_matcher(threshold), "node bigint, n bigint, low bigint"), "vector-links")
    roots = stage(graph.components(found.select(F.col("node").alias("a"), F.col("low").alias("b"))), "vector-roots")
    named = classes.select("node", "least").join(roots, "node").groupBy("root").agg(F.min("least").alias("component"))
    totals = found.groupBy("node").agg(F.sum("n").alias("n"))
    per_class = (classes.join(totals, "node", "left").join(roots.join(named, "root").select("node", "component"), "node", "left")
                 .select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "least").alias("component_id")))
    linked = rows.where(usable).join(stage(per_class, "vector-results"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.union(alone).withColumn("kept", kept)
