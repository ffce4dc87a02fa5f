"""Merkle manifest of a dataset: a digest for every row, source and the whole, and a proof for every row.

A row's leaf is the SHA-256 of its columns. Inside a source leaves stand by id and have ranks from 0; every three
consecutive nodes of a level become one of the level above, until one, the source's subroot, remains. Subroots, by
source, make the tree on top in the same way.

Nodes carry the interval [lo, hi) of leaf ranks they cover. That is all a tree needs: a node of level L is in the bucket
of its level that starts at lo - lo mod 3^L, its parent is the node of the next level in the same bucket there whose
interval contains its own, and its siblings are what its parent's interval holds besides it: to the left the nodes that
end at or before lo, to the right those that begin at or after hi. So `levels` builds upwards, a grouping by bucket for
each level, and `attach` goes down, a containment join by bucket for each level, which hands every node the siblings on
its way to the top. Levels are as many as the logarithm of the rows of the largest source; each is stored, and a third
as large as the one below. A bucket holds three nodes, so no source, however large, ends up in one task.

Ranks come from ranges of the rows (`operators.ranking`). Texts are read and hashed once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import stage
from wardlight.operators import ranking

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """Bytes in UTF-8, a colon and the value; a dash for NULL. So no two rows of different values read alike."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def tampered(doc_id: Column, text: Column) -> Column:
    """The text as somebody might change it: without line ends, for ids whose CRC-32 is even. NULL ids are left alone."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def ranked(leaves: DataFrame, group: str, *order: str) -> DataFrame:
    """`leaves` with its place in its group as the interval [lo, lo + 1), and the group's leaves as `n`; NULLs first."""
    keyed = leaves.withColumn("__order", F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order]))
    placed = ranking.numbered_in(keyed, "__order", "__order", [group], out="__place", size="n")
    return placed.select(*leaves.columns, (F.col("__place") - 1).alias("lo"), F.col("__place").alias("hi"), "n")


def levels(leaves: DataFrame, group: str, fanout: int = FANOUT) -> list[DataFrame]:
    """The nodes of every level, the given leaves first: group, lo, hi, n, digest, and from level 1 on `kids`.

    `leaves` has group, lo, hi, n and digest, a row for each rank. `kids` are the nodes that a node contains, in order.
    A group has nodes up to the level where one remains.
    """
    found, width = [leaves], 1
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while width < largest:
        bucket = F.col("lo") - F.col("lo") % (width * fanout)
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))  # at most `fanout`
        up = (found[-1].where(F.col("n") > width).groupBy(group, "n", bucket.alias("bucket")).agg(kids.alias("kids"))
              .select(group, F.col("bucket").alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"), "n",
                      F.sha2(F.array_join("kids.digest", ""), 256).alias("digest"), "kids"))
        found.append(stage(up, "tree-level"))
        width *= fanout
    return found


def roots(tree: Sequence[DataFrame], group: str, fanout: int = FANOUT) -> DataFrame:
    """(group, n, root): the node that covers all leaves of its group."""
    tops = [nodes.where((F.col("lo") == 0) & (F.col("hi") == F.col("n")) & (F.col("n") > (fanout ** (level - 1) if level else 0)))
            .select(group, "n", F.col("digest").alias("root")) for level, nodes in enumerate(tree)]
    return reduce(DataFrame.union, tops)


STEP = "array<struct<before:string,after:string>>"


def _beside(kids: Column, lo: Column, hi: Column) -> Column:
    """What the parent's interval holds besides [lo, hi): digests before it and behind it, each joined."""
    joined = lambda keep: F.array_join(F.transform(F.filter(kids, keep), lambda kid: kid["digest"]), "")
    return F.struct(joined(lambda kid: kid["hi"] <= lo).alias("before"), joined(lambda kid: kid["lo"] >= hi).alias("after"))


def attach(tree: Sequence[DataFrame], group: str, carried: Sequence[str] = (), fanout: int = FANOUT) -> DataFrame:
    """The leaves with `carried` columns and `path`: for each level on the way to the group's root, from below, the
    digests of the siblings before and behind the node."""
    none = F.array().cast(STEP)
    path = None
    for level in range(len(tree) - 1, -1, -1):
        columns = [group, "lo", "hi", "n", *(["kids"] if level else carried)]
        nodes = tree[level].select(*columns)
        if path is None:
            path = nodes.withColumn("path", none)
            continue
        above = path.select(F.col(group).alias("of"), F.col("lo").alias("from"), F.col("hi").alias("to"),
                            F.col("kids").alias("inside"), F.col("path").alias("onwards"))
        bucket = F.col("lo") - F.col("lo") % fanout ** (level + 1)
        contained = (F.col(group).eqNullSafe(F.col("of")) & (bucket == F.col("from"))
                     & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to")))
        step = F.array(_beside(F.col("inside"), F.col("lo"), F.col("hi")))
        joined = nodes.join(above, contained, "left")
        path = joined.select(*columns, F.when(F.col("inside").isNull(), none).otherwise(F.concat(step, "onwards")).alias("path"))
        if level and level % 4 == 0:  # joins of more levels in one plan gain nothing
            path = stage(path, "tree-paths")
    return path.select(group, *carried, "path")


def fold(path: Column, start: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof(path: Column) -> Column:
    """All siblings on the way, one after the other."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, path and `leaf_now` of every row.

    Columns are those of `COLUMNS`; others, whatever their names, are left out. `leaf_now` is the leaf of the text that
    `tampered` leaves. NULLs are a dash in a leaf; a NULL source is a source of its own, before all others, and NULL ids
    come first in their source. Rows that repeat an id stand by their leaves, so equal rows change places without a
    difference. An empty table has no rows, and no root.
    """
    named = docs.select(*COLUMNS)
    others = [F.col(c) for c in COLUMNS[:-1]]
    hashed = named.select("doc_id", "source", leaf([*others, F.col("text")]).alias("digest"),
                          leaf([*others, tampered(F.col("doc_id"), F.col("text"))]).alias("leaf_now"))
    hashed = stage(hashed, "leaf-digests")  # ranges are sampled first: else texts are read twice
    leaves = stage(ranked(hashed, "source", "doc_id", "digest"), "leaves")
    tree = levels(leaves, "source")
    tops = roots(tree, "source").select(F.lit(0).alias("all"), "source", F.col("root").alias("digest"))
    top_leaves = stage(ranked(tops, "all", "source"), "subroots")
    top = levels(top_leaves, "all")
    upper = attach(top, "all", ["source", "digest"]).withColumnsRenamed({"digest": "subroot", "path": "onwards"})
    upper = stage(upper.join(F.broadcast(roots(top, "all").select("all", "root")), "all").drop("all")  # one row
                  .withColumnRenamed("source", "of"), "subroot-paths")
    rows = attach(tree, "source", ["doc_id", "digest", "leaf_now"])
    return (rows.join(upper, F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                    F.concat("path", "onwards").alias("path"), "leaf_now"))


def verified(entries: DataFrame) -> DataFrame:
    """`entries` of a manifest with `folded_root`, from the leaf as it is now, and whether it is the root."""
    folded = entries.withColumn("folded_root", fold(F.col("path"), F.col("leaf_now")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
