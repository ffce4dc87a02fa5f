"""Ranks over a whole table (or over groups of any size) without one-task windows.

``percent_rank() over (order by x)`` has no partition key, so Spark would move
every row to one task; ``rank() over (partition by state ...)`` moves the
largest state to one task. Here instead:

1. the rows are first reduced to what the rank depends on: one row per distinct
   value with its row count (`value_positions`), or the bare order key plus the
   row id (`row_positions`);
2. that narrow table is range-partitioned on the order key and staged with its
   partition number, called a slice. Equal values may be many, but step 1 left
   one row of them, or the row id splits them, so no slice grows with a tie;
3. a running count inside each (group, slice) plus the count of the slices
   before it is the position in the whole.

NULL order keys sort last, as in the reference SQL dialect.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.workspace import stage

# Quantile brackets reach two of these parts to either side.
BRACKET_ACCURACY = 2000


def _order(c: str, ascending: bool) -> Column:
    return F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()


def _sliced(df: DataFrame, *order: Column) -> DataFrame:
    """`df` split into ranges of the order key, the range number kept as `_slice`.

    Staging fixes the number: a later recomputation cannot move a row.
    """
    ranged = df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    return stage(ranged, "slices")


def _running_before(c: str, by: Sequence[str], order: Sequence[Column]) -> Column:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(c).over(w), F.lit(0))


def _with_slice_offsets(sliced: DataFrame, by: Sequence[str], weight: Column) -> DataFrame:
    """Adds `_offset` (rows of the group in earlier slices) and `group_n` (rows of the group).

    Without groups the slice totals, one per slice, are added up on the driver;
    with groups they stay distributed, at most one row per slice and group.
    """
    totals = sliced.groupBy(*by, "_slice").agg(F.sum(weight).cast("long").alias("_slice_n"))
    if not by:
        by_slice = {r["_slice"]: r["_slice_n"] for r in totals.collect()}
        before, seen = [], 0
        for number in range(max(by_slice, default=-1) + 1):
            before.append(seen)
            seen += by_slice.get(number, 0)
        offset = F.get(F.lit(before or [0]).cast("array<bigint>"), F.col("_slice"))
        return sliced.withColumn("_offset", offset).withColumn("group_n", F.lit(seen).cast("long"))
    group = Window.partitionBy(*by)
    offsets = totals.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
        F.col("_slice").alias("_s"),
        _running_before("_slice_n", by, [F.col("_slice")]).alias("_offset"),
        F.sum("_slice_n").over(group).alias("group_n"),
    )
    match = F.col("_slice") == F.col("_s")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return sliced.join(offsets, match).drop("_s", *[f"_g{i}" for i in range(len(by))])


def value_positions(df: DataFrame, value: str, by: Sequence[str] = (), ascending: bool = True,
                    skip_null: bool = False) -> DataFrame:
    """One row per (group, value): `n` rows hold it, `n_before` of the group's `group_n` precede it."""
    if skip_null:
        df = df.where(F.col(value).isNotNull())
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return positions_of_counts(counts, value, by, ascending)


def positions_of_counts(counts: DataFrame, value: str, by: Sequence[str] = (), ascending: bool = True,
                        extra: Sequence[str] = ()) -> DataFrame:
    """`value_positions` for a table already reduced to (group, value, n, extra...)."""
    order = _order(value, ascending)
    sliced = _sliced(counts, order, *[F.col(c) for c in by])
    placed = _with_slice_offsets(sliced, by, F.col("n"))
    before = F.col("_offset") + _running_before("n", [*by, "_slice"], [order])
    return placed.select(*by, value, "n", *extra, before.alias("n_before"), "group_n")


def column_positions(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """(column, value, n, n_before, group_n) of several number columns, each ranked by itself, in one slicing.

    Columns and values are one long table; it is counted, cut into ranges and stored once, however many columns there are.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                          for c in values])).alias("p")).select("p.*")
    return value_positions(pairs, "value", ["column"])


def attach_percent_ranks(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """``percent_rank() over (order by value nulls last)`` of each column of `ranks`, under the name it gives."""
    positions = stage(column_positions(df, list(ranks)), "positions")
    for c, out in ranks.items():
        own = positions.where(F.col("column") == c).select(F.col("value").alias(c), "n_before", "group_n")
        share = F.col("n_before").cast("double") / F.nullif((F.col("group_n") - 1).cast("double"), F.lit(0.0))
        df = _join_on_values(df, own, [c], "left").withColumn(out, F.coalesce(share, F.lit(0.0))).drop("n_before", "group_n")
    return df


def _join_on_values(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Null-safe equality join that keeps the left copies of the key columns."""
    renamed = right
    match = F.lit(True)
    for i, c in enumerate(on):
        renamed = renamed.withColumnRenamed(c, f"_k{i}")
        match = match & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return left.join(renamed, match, how).drop(*[f"_k{i}" for i in range(len(on))])


def attach_positions(df: DataFrame, positions: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds `n`, `n_before`, `group_n` to every row of `df`.

    Positions are one row per group and value, so a left join by these, NULLs included, keeps every row of `df` once,
    whatever its id. They are stored first: Spark knows their size, broadcasts them while that is small, and beyond
    that splits a frequent value of `df` at run time.
    """
    return _join_on_values(df, stage(positions, "positions"), [*by, value], "left")


def _ranked(df: DataFrame, value: str, key: str, by: Sequence[str], ascending: bool,
            skip_null: bool, out: str, expr: Column) -> DataFrame:
    positions = value_positions(df, value, by, ascending, skip_null)
    placed = attach_positions(df, positions, value, by)
    return placed.withColumn(out, expr).drop("n", "n_before", "group_n")


def percent_rank(df: DataFrame, value: str, key: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """``percent_rank() over ([partition by] order by value nulls last)``."""
    return attach_percent_rank(df, value_positions(df, value, by), value, key, out, by)


def attach_percent_rank(df: DataFrame, positions: DataFrame, value: str, key: str, out: str,
                        by: Sequence[str] = ()) -> DataFrame:
    share = F.col("n_before").cast("double") / F.nullif((F.col("group_n") - 1).cast("double"), F.lit(0.0))
    placed = attach_positions(df, positions, value, by)
    return placed.withColumn(out, F.coalesce(share, F.lit(0.0))).drop("n", "n_before", "group_n")


def rank_in(df: DataFrame, by: Sequence[str], value: str, key: str, out: str,
            ascending: bool = False) -> DataFrame:
    """``rank() over (partition by ... order by value desc nulls last)``."""
    return _ranked(df, value, key, by, ascending, False, out, F.col("n_before") + 1)


def average_percentile_in(df: DataFrame, by: Sequence[str], value: str, key: str, out: str) -> DataFrame:
    """Mean rank of ties as a share of the group's non-NULL rows, times 100; NULL stays NULL.

    A row whose group key is NULL belongs to no group and gets NULL.
    """
    middle = (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("group_n") * 100.0
    grouped = F.lit(True)
    for c in by:
        grouped = grouped & F.col(c).isNotNull()
    return _ranked(df, value, key, by, True, True, out, F.when(grouped, middle))


def numbered_in(df: DataFrame, value: str, key: str, by: Sequence[str] = (), ascending: bool = True,
                out: str = "row_number", size: str | None = None) -> DataFrame:
    """`df` with each row's place in its group by value, NULLs last, ties by key; and with the group's rows as `size`.

    The rows themselves are cut into ranges, so there is no join back and rows that repeat an id are numbered each.
    """
    order = [_order(value, ascending), F.col(key).asc()]
    placed = _with_slice_offsets(_sliced(df, *order), by, F.lit(1))
    local = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy(*order))
    numbered = placed.withColumn(out, F.col("_offset") + local)
    if size is not None:
        numbered = numbered.withColumn(size, F.col("group_n"))
    return numbered.select(*df.columns, out, *([] if size is None else [size]))


def row_positions(df: DataFrame, value: str, key: str, by: Sequence[str] = (),
                  ascending: bool = True) -> DataFrame:
    """(group, key, value, `row_number`): place by value, NULLs last, ties by key."""
    return numbered_in(df.select(*by, key, value), value, key, by, ascending)


def row_number_in(df: DataFrame, by: Sequence[str], value: str, key: str, out: str,
                  ascending: bool = False) -> DataFrame:
    """``row_number() over (partition by ... order by value [desc] nulls last, key)``."""
    return numbered_in(df, value, key, by, ascending, out)


def _after(value: str, key: str, cut_value, cut_key) -> Column:
    later_key = F.col(key) > F.lit(cut_key)
    if cut_value is None:
        return F.col(value).isNull() & later_key
    cut = F.lit(cut_value)
    return F.col(value).isNull() | (F.col(value) > cut) | ((F.col(value) == cut) & later_key)


def ntile(df: DataFrame, tiles: int, value: str, key: str, out: str) -> DataFrame:
    """``ntile(tiles) over (order by value nulls last, key)``.

    Only the last row of each tile is looked for, ``tiles - 1`` rows in all; the
    tile of any other row then follows from comparing it with those.
    """
    places = numbered_in(df.select(value, key), value, key, size="_rows")
    first = places.select("_rows").first()
    n = first["_rows"] if first else 0
    size, longer = divmod(n, tiles)
    last_rows = [t * size + min(t, longer) for t in range(1, tiles)]
    cuts = places.where(F.col("row_number").isin(last_rows)).collect() if n else []
    by_row = {r["row_number"]: r for r in cuts}
    tile = F.lit(1)
    for row in last_rows:
        if row in by_row:
            tile = tile + F.when(_after(value, key, by_row[row][value], by_row[row][key]), 1).otherwise(0)
    return df.withColumn(out, tile)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column_name, probability, value): linear-interpolation quantiles of each column.

    A first pass brackets every quantile with approximate ones a little below
    and above it; a second counts the rows below each bracket and ranks only the
    values inside, a small share of the column. Should a bracket have missed its
    quantile, that column is ranked whole. `df` is read three times, so pass a
    stored table. Columns without any value are missing from the result.
    """
    probabilities = [float(p) for p in probabilities]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    found = _bracketed(numbers, cols, probabilities)
    missed = sorted({c for (c, _), value in found.items() if value is None})
    rows = [(c, p, value) for (c, p), value in found.items() if c not in missed]
    out = df.sparkSession.createDataFrame(rows, "column_name string, probability double, value double")
    return out.unionByName(counted_quantiles(numbers, missed, probabilities)) if missed else out


def _bracketed(numbers: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> dict:
    """(column, probability) -> value, None where the bracket missed; bounded by columns times probabilities."""
    margin = 2.0 / BRACKET_ACCURACY
    ends = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)]
    row = numbers.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                      *[F.percentile_approx(c, ends, BRACKET_ACCURACY).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    brackets = []
    for i, c in enumerate(cols):
        for j, p in enumerate(probabilities if row[f"n{i}"] else ()):
            low = float("-inf") if ends[2 * j] == 0.0 else row[f"q{i}"][2 * j]
            high = float("inf") if ends[2 * j + 1] == 1.0 else row[f"q{i}"][2 * j + 1]
            brackets.append((c, p, low, high, (row[f"n{i}"] - 1) * p))
    if not brackets:
        return {}
    below = numbers.agg(*[F.count_if(F.col(c) < F.lit(low)) for c, _, low, _, _ in brackets]).first()
    inside = [F.when(F.col(c).between(low, high), F.struct(F.lit(g).alias("g"), F.col(c).alias("v")))
              for g, (c, _, low, high, _) in enumerate(brackets)]
    values = numbers.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).select("x.g", "x.v")
    # Place of the two neighbours of each quantile among the values of its bracket.
    neighbours = [[int(rounded(at)) - below[g] for g, (*_, at) in enumerate(brackets)] for rounded in (floor, ceil)]
    covers = [(F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n"))
              for at in (F.lit(places).cast("array<bigint>")[F.col("g")] for places in neighbours)]
    hits = value_positions(values, "v", ["g"]).where(covers[0] | covers[1]).groupBy("g").agg(
        *[F.max(F.when(cover, F.col("v"))).alias(side) for cover, side in zip(covers, ("low", "high"))])
    pairs = {r["g"]: (r["low"], r["high"]) for r in hits.collect()}
    out = {}
    for g, (c, p, _, _, at) in enumerate(brackets):
        low, high = pairs.get(g, (None, None))
        out[c, p] = None if low is None or high is None else low + (high - low) * (at - floor(at))
    return out


def counted_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """As `exact_quantiles`, ranking every value of the columns, all columns in one pass.

    (column, value) pairs are counted before the shuffle, and one frequent value
    or one long column cannot fill a task.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("p")).select("p.column_name", "p.v")
    positions = value_positions(pairs, "v", ["column_name"], skip_null=True)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    place = (F.col("group_n") - 1) * F.col("probability")
    covers = lambda at: (F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n"))
    hits = positions.select("*", wanted.alias("probability")).select(
        "column_name", "probability", "v",
        (place - F.floor(place)).alias("part"),
        covers(F.floor(place)).alias("is_low"), covers(F.ceil(place)).alias("is_high"),
    ).where("is_low or is_high")
    low, high = F.max(F.when(F.col("is_low"), F.col("v"))), F.max(F.when(F.col("is_high"), F.col("v")))
    return hits.groupBy("column_name", "probability").agg(
        (low + (high - low) * F.max("part")).alias("value"))
