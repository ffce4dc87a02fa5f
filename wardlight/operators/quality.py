"""Data-quality checks: a report has a row (name, ok, value) for each.

A check says what it counts; `compiled` puts all checks of a table together. Counts of rows and NULLs are one aggregate, and
a histogram of a column, of a row for each of its values, serves all checks of that column's values. So a table is read
once, and once more for each column whose values are looked at, however many checks there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv


@dataclass(frozen=True)
class Check:
    """`value` of a check from counts, and whether that is right. `count` is an aggregate over rows; with `by`, over the
    rows (`by`, `n`) of a histogram of that column."""
    name: str
    count: Callable[[], Column]
    ok: Callable[[Column], Column]
    by: str | None = None


def not_null(c: str, name: str | None = None) -> Check:
    """Value: number of rows in which the column is NULL."""
    return Check(name or f"{c} not null", lambda: F.count_if(F.col(c).isNull()), lambda v: v == 0)


def unique(c: str, name: str | None = None) -> Check:
    """Value: number of known keys that occur more than once."""
    return Check(name or f"{c} unique", lambda: F.count_if(F.col(c).isNotNull() & (F.col("n") > 1)), lambda v: v == 0, c)


def min_rows(floor: int = fv.MART_ROW_FLOOR, name: str | None = None) -> Check:
    return Check(name or f"row count > {floor}", lambda: F.count(F.lit(1)), lambda v: v > floor)


def max_null_rate(c: str, limit: float = fv.MAX_NULL_RATE, name: str | None = None) -> Check:
    """Value: share of rows in which the column is NULL, 0 of an empty table."""
    rate = lambda: F.coalesce(F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count(F.lit(1))), F.lit(0.0))
    return Check(name or f"{c} null rate < {limit:.0%}", rate, lambda v: v < limit)


def max_category_share(c: str, limit: float = fv.MAX_LABEL_SHARE, name: str | None = None) -> Check:
    """Value: share of the most frequent value, NULL as one of them; 0 of an empty table."""
    share = lambda: F.coalesce(F.try_divide(F.max("n").cast("double"), F.sum("n")), F.lit(0.0))
    return Check(name or f"{c} max category share <= {limit:.0%}", share, lambda v: v <= limit, c)


def compiled(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The report of all checks of a table."""
    groups: dict[str | None, list[Check]] = {}
    for check in checks:
        groups.setdefault(check.by, []).append(check)
    parts = []
    for by, group in groups.items():
        rows = df if by is None else df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
        counts = rows.agg(*[check.count().cast("double").alias(f"v{k}") for k, check in enumerate(group)])
        entries = F.array(*[F.struct(F.lit(check.name).alias("name"), check.ok(F.col(f"v{k}")).alias("ok"), F.col(f"v{k}").alias("value"))
                            for k, check in enumerate(group)])
        parts.append(counts.select(F.explode(entries).alias("c")).select("c.*"))
    return run_checks(parts)


def _check(row: DataFrame, name: str, ok: Column, value: Column) -> DataFrame:
    return row.select(F.lit(name).alias("name"), ok.alias("ok"), value.cast("double").alias("value"))


def check_not_null(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    return compiled(df, [not_null(c, name)])


def check_unique(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    return compiled(df, [unique(c, name)])


def check_min_rows(df: DataFrame, floor: int = fv.MART_ROW_FLOOR, name: str | None = None) -> DataFrame:
    return compiled(df, [min_rows(floor, name)])


def check_null_rate(df: DataFrame, c: str, limit: float = fv.MAX_NULL_RATE, name: str | None = None) -> DataFrame:
    return compiled(df, [max_null_rate(c, limit, name)])


def check_max_share(df: DataFrame, c: str, limit: float = fv.MAX_LABEL_SHARE, name: str | None = None) -> DataFrame:
    return compiled(df, [max_category_share(c, limit, name)])


def check_not_empty(df: DataFrame, name: str) -> DataFrame:
    """Value: 1 when a row was found; stops at the first one."""
    row = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("v"))
    return _check(row, f"{name} not empty", F.col("v") > 0, F.col("v"))


def check_paths_exist(spark, paths: dict[str, str]) -> DataFrame:
    """Stored models are there; one row per name."""
    rows = []
    for name, p in paths.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        rows.append((f"{name} exists", bool(found), 1.0 if found else 0.0))
    return spark.createDataFrame(rows, "name string, ok boolean, value double")


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def failures(report: DataFrame) -> list[str]:
    """Names of the failed checks (a report has one row per check)."""
    return [r["name"] for r in report.where(~F.col("ok")).select("name").collect()]


def require_passed(report: DataFrame) -> None:
    failed = failures(report)
    if failed:
        raise RuntimeError(f"critical data quality checks failed: {failed}")


def performance_gate(mart: DataFrame, floor: int = fv.MART_ROW_FLOOR, models: dict[str, str] | None = None) -> DataFrame:
    """Gates of the performance table: rows, unknown scores, dominance of one label; and that stored models are there."""
    report = compiled(mart, [min_rows(floor), max_null_rate("composite_quality_score"), max_category_share("readmission_risk_label")])
    return run_checks([report, check_paths_exist(mart.sparkSession, models)] if models else [report])


def schema_tests(staged: dict[str, DataFrame]) -> DataFrame:
    """Key tests of staging and mart tables: ids present and unique, regions by state."""
    reports = []
    for table, df in staged.items():
        key = "state" if table in ("stg_community_health", "mart_regional_summary") else "provider_id"
        checks = [not_null(key, f"{table}.{key} not null")]
        if table != "stg_community_health":
            checks.append(unique(key, f"{table}.{key} unique"))
        reports.append(compiled(df, checks))
    return run_checks(reports)
