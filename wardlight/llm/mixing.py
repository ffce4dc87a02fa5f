"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

Each source has a whole-number weight; the weights add up to the period. A source's rows, in the order of a hash, are
cut into blocks. Block k of a source with weight w is released at slot floor(k * period / w) and due at slot
ceil((k + 1) * period / w). In every slot the released block that is due first goes next. For one processor this meets
all times, so at every slot each source has had less than one block more or less than its share.

The schedule of one period repeats. Sources of the most frequent weight have the same times, so in it they go round in the
order of their names: they are one class, whose blocks are numbered through. Only the other sources, those to which a weight
was given, are told apart when the schedule is worked out. This takes one row, in which the class moves on by as many blocks
as nothing else comes in between, so it takes steps in proportion to the sum of the given weights, whatever the number of
sources or the length of the period. A block's slot follows by arithmetic, and from the rows of all blocks before it, added
up over ranges of slots, its position. A source that has run out leaves its slots empty and the others close up, so their
shares among each other stay.

Rows are numbered within a source by pieces: a piece is one of 65,536 values of the hash, its rows are numbered in a
window, and the pieces before it are added up from their counts. No task holds a whole source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import stage
from wardlight.operators import ranking

BLOCK_ROWS = 64
#: Steps of the schedule that are gathered before they are put to the others.
CHUNK = 256


def source_weights(docs: DataFrame, weights: Mapping[str, int], default: int = 1) -> DataFrame:
    """source, weight and rows of every source of `docs`; NULL is a source of its own, with the default weight."""
    if any(int(w) != w or w < 1 for w in [*weights.values(), default]):
        raise ValueError("weights are whole numbers from 1")
    known = F.lit(None).cast("int")
    for name, weight in weights.items():
        known = F.when(F.col("source") == name, weight).otherwise(known)
    return docs.groupBy("source").agg(F.count("*").alias("rows")).select(
        "source", F.coalesce(known, F.lit(default)).alias("weight"), "rows")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


PICK = "array<struct<i:int,first:bigint,slot:bigint,length:bigint>>"


def _picks(period: Column, weights: Column, before: Column, members: Column, d: Column) -> Column:
    """Who goes when in one period, earliest deadline first, in order: `length` slots from `slot` on for the blocks of source i
    from `first` on; i is -1 for the class.

    `weights` are those of the sources told apart, in order of name, and `before` how many members of the class come before
    each; the class has `members` sources of weight `d`. Of blocks due at once that of the first name goes.
    """
    nobody = F.lit(None).cast("struct<due:bigint,i:int>")

    def ready(t: Column, done: Column) -> Column:
        def one(k, i):
            w = F.get(weights, i)
            return F.when((k < w) & (k * period < (t + 1) * w), F.struct(_div((k + 1) * period + w - 1, w).alias("due"), i.alias("i")))
        return F.coalesce(F.array_min(F.transform(done, one)), nobody)

    def released_next(t: Column, done: Column) -> Column:
        return F.array_min(F.transform(done, lambda k, i: F.when(
            (k < F.get(weights, i)) & (k * period >= (t + 1) * F.get(weights, i)), _div(k * period, F.get(weights, i)))))

    def step(state: Column, _: Column) -> Column:
        t, n, done, picks = (state[c] for c in ("t", "n", "done", "picks"))

        def decide(c: Column) -> Column:
            k, q = _div(n, members), n % members
            due = _div((k + 1) * period + d - 1, d)
            tie = due == c["due"]
            there = (n < members * d) & (k * period < (t + 1) * d)
            first = there & (c["due"].isNull() | (due < c["due"]) | (tie & (q < F.get(before, c["i"]))))
            run = F.least(members - q, released_next(t, done) - t, F.when(tie, F.get(before, c["i"]) - q))
            pick = F.when(first, F.struct(F.lit(-1).alias("i"), n.alias("first"), t.alias("slot"), run.alias("length"))).otherwise(
                F.struct(c["i"].alias("i"), F.get(done, c["i"]).alias("first"), t.alias("slot"), F.lit(1).cast("long").alias("length")))
            return pick

        def after(pick: Column) -> Column:
            ours = pick["i"] == -1
            return F.struct((t + pick["length"]).alias("t"), F.when(ours, n + pick["length"]).otherwise(n).alias("n"),
                            F.transform(done, lambda k, i: F.when(i == pick["i"], k + 1).otherwise(k)).alias("done"),
                            F.concat(picks, F.array(pick)).alias("picks"))
        return F.when(t < period, _let(_let(ready(t, done), decide), after)).otherwise(state)

    zero, none = F.lit(0).cast("long"), F.array().cast(PICK)
    start = F.struct(zero.alias("t"), zero.alias("n"), F.transform(weights, lambda w: zero).alias("done"), F.array(none).alias("all"))

    def chunk(state: Column, _: Column) -> Column:
        begin = F.struct(state["t"].alias("t"), state["n"].alias("n"), state["done"].alias("done"), none.alias("picks"))
        return _let(F.aggregate(F.sequence(F.lit(1), F.lit(CHUNK)), begin, step), lambda s: F.struct(
            s["t"].alias("t"), s["n"].alias("n"), s["done"].alias("done"), F.concat(state["all"], F.array(s["picks"])).alias("all")))
    # a step for each block told apart, and runs of the class that end with one of these, with a release, or with a round of it
    steps = F.aggregate(weights, zero, lambda a, w: a + w) * 3 + d + 1
    return F.flatten(F.aggregate(F.sequence(zero, _div(steps, F.lit(CHUNK))), start, chunk, lambda s: s["all"]))


def schedule(sources: DataFrame) -> DataFrame:
    """source, weight, `kth` of the source's blocks in the period, slot and period: a row for each source and block of one period.

    `sources` has source and weight, each source once.
    """
    named = sources.select("source", F.col("weight").cast("long").alias("weight"), F.struct(F.col("source").isNotNull(), "source").alias("key"))
    placed = stage(ranking.numbered_in(named, "key", "key", out="g").select("source", "weight", "g"), "sources")
    common = placed.groupBy("weight").agg(F.count("*").alias("n")).agg(F.max_by("weight", F.struct("n", -F.col("weight"))).alias("d"))
    own = F.when(F.col("weight") != F.col("d"), F.struct("g", "source", "weight"))
    one = (placed.crossJoin(F.broadcast(common)).groupBy("d").agg(  # one row
        F.sum("weight").alias("period"), F.count_if(F.col("weight") == F.col("d")).alias("members"),
        F.array_sort(F.collect_list(own)).alias("named"))  # those with a weight of their own, as many as were given
        .withColumn("picks", _picks(F.col("period"), F.transform("named", lambda x: x["weight"]),
                                    F.transform("named", lambda x, i: x["g"] - 1 - i), F.col("members"), F.col("d"))))
    one = stage(one, "schedule")
    picks = one.select("d", "period", "members", "named", F.explode("picks").alias("p")).select("*", "p.*")
    told = picks.where("i >= 0").select(
        F.get("named", F.col("i"))["source"].alias("source"), F.get("named", F.col("i"))["weight"].alias("weight"), F.col("first").alias("kth"), "slot", "period")
    # members of the class: the n-th block of the class lies in one of its runs; both are dealt by ranges of n
    span = F.greatest(F.lit(1).cast("long"), _div(F.col("members") * F.col("d"), F.size("named") + 1))
    runs = picks.where("i < 0").select("first", "slot", "length", F.explode(F.sequence(
        _div(F.col("first"), span), _div(F.col("first") + F.col("length") - 1, span))).alias("range"))
    before = F.size(F.filter("named", lambda x: x["g"] < F.col("g")))
    members = (placed.crossJoin(F.broadcast(one.select("d", "period", "members", "named", span.alias("span"))))  # one row
               .where(F.col("weight") == F.col("d")).withColumn("q", F.col("g") - 1 - before)
               .withColumn("kth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("d") - 1)))
               .withColumn("n", F.col("kth") * F.col("members") + F.col("q")).withColumn("range", _div(F.col("n"), F.col("span")))
               .select("source", "weight", "kth", "period", "n", "range"))
    inside = (members.n >= runs["first"]) & (members.n < runs["first"] + runs["length"])
    held = members.join(runs, (members.range == runs.range) & inside).select(
        "source", "weight", "kth", (F.col("slot") + F.col("n") - F.col("first")).alias("slot"), "period")
    return told.union(held)


def numbered(docs: DataFrame, seed: str = "0") -> DataFrame:
    """`docs` with `__nth`, its number from 0 among the rows of its source in the order of an md5 of id and seed."""
    keyed = (docs.withColumn("__order", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed))))
             .withColumn("__piece", F.substring("__order", 1, 4)))
    counts = keyed.groupBy("source", "__piece").agg(F.count("*").alias("__n"))
    before = counts.select(F.col("source").alias("__s"), F.col("__piece").alias("__p"), F.coalesce(F.sum("__n").over(
        W.partitionBy("source").orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = F.row_number().over(W.partitionBy("source", "__piece").orderBy("__order", "doc_id"))
    return (keyed.join(before, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__piece") == F.col("__p")))
            .withColumn("__nth", F.col("__before") + inside - 1)
            .drop("__order", "__piece", "__s", "__p", "__before"))


def _planned(docs: DataFrame, weights: Mapping[str, int], default: int) -> tuple[DataFrame, DataFrame]:
    """Stored: the sources with their weights and rows, and the schedule of a period."""
    sources = stage(source_weights(docs, weights, default), "source-weights")
    return sources, stage(schedule(sources), "slots")


def _slotted(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """`blocks` (source, `__block`) with `__slot`. Sides are broadcast while Spark knows them to be small."""
    w = plan.where("kth = 0").select(F.col("source").alias("__s"), F.col("weight").alias("__w"), F.col("period").alias("__period"))
    at = plan.select(F.col("source").alias("__t"), F.col("kth").alias("__k"), F.col("slot").alias("__at"))
    return (blocks.join(w, F.col("source").eqNullSafe(F.col("__s")))
            .withColumn("__round", _div(F.col("__block"), F.col("__w")))
            .join(at, F.col("source").eqNullSafe(F.col("__t")) & (F.col("__block") - F.col("__round") * F.col("__w") == F.col("__k")))
            .withColumn("__slot", F.col("__round") * F.col("__period") + F.col("__at"))
            .drop("__s", "__w", "__period", "__round", "__t", "__k", "__at"))


def _placed(docs: DataFrame, plan: DataFrame, block_rows: int, seed: str) -> DataFrame:
    """`docs` with `__block`, `__slot` and `__nth`."""
    return _slotted(numbered(docs, seed).withColumn("__block", _div(F.col("__nth"), F.lit(block_rows))), plan)


def mix(docs: DataFrame, weights: Mapping[str, int], default: int = 1, block_rows: int = BLOCK_ROWS,
        seed: str = "0") -> DataFrame:
    """Every row of `docs` (doc_id, source and any others) with block, slot and position in the mixed order.

    Positions count from 0 without gaps; sorting by `position` gives the order. Columns named block, slot or
    position are replaced. Rows that repeat an id stand next to each other in their source, NULL ids by the hash of an
    empty id. An empty table gives no rows. Weights of sources that are not there are left out.
    """
    added = ("block", "slot", "position")
    keep = [c for c in docs.columns if c.lower() not in added]
    sources, plan = _planned(docs, weights, default)
    of = sources.select("source", "rows", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("rows") - 1, F.lit(block_rows)))).alias("__block"))
    sizes = _slotted(of, plan).select("__slot", F.least(F.lit(block_rows), F.col("rows") - F.col("__block") * block_rows).alias("n"))
    before = ranking.positions_of_counts(sizes, "__slot").select(F.col("__slot").alias("__u"), "n_before")
    placed = _placed(docs.select(*keep), plan, block_rows, seed).join(before, F.col("__slot") == F.col("__u"))
    position = F.col("n_before") + F.col("__nth") % block_rows
    return placed.select(*keep, F.col("__block").alias("block"), F.col("__slot").alias("slot"), position.alias("position"))


def in_order(docs: DataFrame, weights: Mapping[str, int], default: int = 1, block_rows: int = BLOCK_ROWS,
             seed: str = "0") -> DataFrame:
    """`docs` with the same columns, dealt into consecutive ranges of the mixed order and sorted by it."""
    placed = _placed(docs, _planned(docs, weights, default)[1], block_rows, seed)
    return placed.repartitionByRange("__slot", "__nth").sortWithinPartitions("__slot", "__nth").select(*docs.columns)
