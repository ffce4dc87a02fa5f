"""Joins: key chains, small dimensions, whole-table aggregates, group means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions.columns import safe_div
from wardlight.functions.exact import mean
from wardlight.workspace import stage


def left_join_chain(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left equi-joins on one key, each right side holding one row per key.

    Every side is shuffled once by the key: an aggregate already grouped by it
    is not shuffled again.
    """
    out = base
    for other in others:
        out = out.join(other, key, "left")
    return out


def join_dim(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join to an aggregated dimension.

    The dimension is staged first, so its size is known when the join is
    planned: Spark broadcasts it below the session's threshold and otherwise
    sorts and merges, splitting a frequent key at run time.
    """
    return df.join(stage(dim, "dim"), key, "left")


def with_global(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Adds whole-table aggregates to every row (``agg(...) over ()``): one row is broadcast.

    `df` is read twice, so pass a staged or scanned table.
    """
    total = df.agg(*[e.alias(name) for name, e in aggregates.items()])
    return df.crossJoin(F.broadcast(total))


def share_of_total(df: DataFrame, c: str) -> DataFrame:
    """(category, n, share of all rows) including the NULL category."""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    share = F.coalesce(safe_div(F.col("n").cast("double"), F.col("_total")), F.lit(0.0))
    return counts.crossJoin(F.broadcast(total)).select(c, "n", share.alias("share"))


def group_mean(df: DataFrame, key: str, c: str, out: str) -> DataFrame:
    """Mean of `c` in the row's group; rows without a group get NULL."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(mean(F.col(c)).alias(out))
    return join_dim(df, means, key)


def add_prefixed(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def performance_with_risk(performance: DataFrame, risk: DataFrame) -> DataFrame:
    """Performance rows with the state rank of the readmission table."""
    extra = risk.select("provider_id", "state_readmission_rank")
    return performance.join(extra, "provider_id", "left")


def performance_with_region(performance: DataFrame, regions: DataFrame) -> DataFrame:
    """Performance rows with their region's summary, `region_` before each column.

    The region table is a stored table, so Spark knows its size and broadcasts
    it only when small.
    """
    return performance.join(add_prefixed(regions, "region_", ["state"]), "state", "left")


def profiles(mart: DataFrame, explanations: Mapping[str, DataFrame]) -> DataFrame:
    """Facility rows with one feature->contribution map per model; absent ones stay NULL."""
    from wardlight.functions.columns import features_map

    out = mart
    for name, table in explanations.items():
        features = [c for c in table.columns if c != "provider_id"]
        out = out.join(table.select("provider_id", features_map(features).alias(name)), "provider_id", "left")
    return out
