"""Sorts, limits, per-row top columns, distinct values, yearly unions, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions.columns import clean_key, rating_to_100, seeded_hash
from wardlight.functions.exact import mean
from wardlight.operators.joins import with_global


def top_n(df: DataFrame, c: str, n: int, tie_break: str) -> DataFrame:
    """Highest n rows, NULLs last; each task keeps only its own n."""
    return df.orderBy(F.col(c).desc_nulls_last(), tie_break).limit(n)


def sort_desc(df: DataFrame, c: str, tie_break: str) -> DataFrame:
    return df.orderBy(F.col(c).desc_nulls_last(), tie_break)


def by_name(df: DataFrame, name: str, tie_break: str) -> DataFrame:
    return df.orderBy(F.col(name).asc_nulls_last(), tie_break)


def leaderboards(df: DataFrame, n: int = 15, tie_break: str = "provider_id") -> tuple[DataFrame, DataFrame]:
    """Best quality and highest risk, rows without the score left out."""
    best = top_n(df.dropna(subset=["composite_quality_score"]), "composite_quality_score", n, tie_break)
    riskiest = top_n(df.dropna(subset=["readmission_risk_score"]), "readmission_risk_score", n, tie_break)
    return best.select(*fv.BEST_COLUMNS), riskiest.select(*fv.RISKIEST_COLUMNS)


def best_states(regions: DataFrame, n: int = 10) -> DataFrame:
    return top_n(regions, "avg_quality_score", n, "state")


def riskiest_states(regions: DataFrame, n: int = 10) -> DataFrame:
    return top_n(regions, "avg_readmission_risk", n, "state")


def drivers(cols: Sequence[str], k: int):
    """Array of the k columns of a row with the largest absolute value, earlier column first on ties."""
    entries = [F.struct(-F.abs(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias("order"), F.lit(i).alias("i"),
                        F.lit(c).alias("feature"), F.col(c).cast("double").alias("contribution"))
               for i, c in enumerate(cols)]
    largest = F.slice(F.array_sort(F.array(*entries)), 1, k)
    return F.transform(largest, lambda e: F.struct(e["feature"].alias("feature"),
                                                   e["contribution"].alias("contribution")))


def top_drivers(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, drivers(cols, k).alias("drivers"))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).dropna().distinct().orderBy(c)


def sample_values(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column_name, value): the first distinct known values of each column."""
    parts = [df.select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
             .dropna().distinct().orderBy("value").limit(n) for c, n in limits.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- yearly snapshots ------------------------------------------------------

def snapshot(raw: DataFrame, year: int) -> DataFrame:
    """Quality proxy of a past year (rating times 20); no scores existed then."""
    no_score = F.lit(None).cast("double")
    return raw.select(
        clean_key("provider_id").alias("provider_id"), F.col("hospital_name").cast("string").alias("hospital_name"),
        F.lit(year).alias("year"), rating_to_100("overall_rating").alias("quality_score"),
        no_score.alias("readmission_risk_score"), no_score.alias("national_avg_quality_score"),
        no_score.alias("national_avg_readmission_risk_score"),
    ).where(F.col("provider_id").isNotNull())


def current_year(mart: DataFrame, year: int) -> DataFrame:
    """This year's scores with the means over all facilities."""
    rows = with_global(
        mart, national_avg_quality_score=mean(F.col("composite_quality_score")),
        national_avg_readmission_risk_score=mean(F.col("readmission_risk_score")))
    return rows.select("provider_id", "hospital_name", F.lit(year).alias("year"),
                       F.col("composite_quality_score").alias("quality_score"), "readmission_risk_score",
                       "national_avg_quality_score", "national_avg_readmission_risk_score")


def trend(mart: DataFrame, history: Mapping[int, DataFrame], year: int, provider_id: str | None = None) -> DataFrame:
    """Past years and the current one, one row per facility and year.

    For one facility, ordered by year, the condition is pushed into every
    branch, while the national means still come from all rows.
    """
    parts = [snapshot(raw, y) for y, raw in sorted(history.items())] + [current_year(mart, year)]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if provider_id is None:
        return rows
    return rows.where(F.col("provider_id") == provider_id).orderBy("year")


def improvement(trends: DataFrame, first: int, last: int, n: int = 10) -> DataFrame:
    """Facilities whose quality rose most between two years; one shuffle, no self-join."""
    at = lambda y, c: F.max(F.when(F.col("year") == y, F.col(c)))
    both = trends.where(F.col("year").isin(first, last)).groupBy("provider_id").agg(
        at(last, "hospital_name").alias("hospital_name"),
        at(first, "quality_score").alias("first_score"), at(last, "quality_score").alias("last_score"))
    gain = both.withColumn("improvement", F.col("last_score") - F.col("first_score"))
    return top_n(gain.where(F.col("improvement").isNotNull()), "improvement", n, "provider_id")


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """At most n rows, the same ones whatever the partitioning."""
    return df.orderBy(seeded_hash(F.col(key), seed), key).limit(n)
