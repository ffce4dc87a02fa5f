"""Row selections behind the facility look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv

def find(df: DataFrame, state: str | None = None, risk_level: str | None = None,
         quality_min: float | None = None, limit: int = 100) -> DataFrame:
    """Facilities meeting every given condition, best quality first."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be between 1 and 1000")
    if state:
        df = df.where(F.col("state") == state.upper())
    if risk_level:
        df = df.where(F.col("readmission_risk_label") == risk_level.title())
    if quality_min is not None:
        df = df.where(F.col("composite_quality_score") >= quality_min)
    best_first = F.col("composite_quality_score").desc_nulls_last()
    return df.select(*fv.LIST_COLUMNS).orderBy(best_first, "provider_id").limit(limit)


def find_by_risk(df: DataFrame, risk_level: str = "High", state: str | None = None,
                 limit: int = 100) -> DataFrame:
    if risk_level not in ("Low", "Medium", "High"):
        raise ValueError("risk_level must be Low, Medium or High")
    return find(df, state=state, risk_level=risk_level, limit=limit)


def profile(df: DataFrame, key: str, value) -> DataFrame:
    """The row of one id."""
    return df.where(F.col(key) == F.lit(value))


def compare(df: DataFrame, key: str, ids: Sequence) -> DataFrame:
    """The rows of up to three ids."""
    if len(ids) > 3:
        raise ValueError("at most three ids can be compared")
    return df.where(F.col(key).isin(*ids))


def filter_between(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    """Inclusive range; NULL is outside."""
    return df.where(F.col(c).between(low, high))


def high_burden_high_quality(df: DataFrame, above: float = 70.0, limit: int | None = 50) -> DataFrame:
    hit = (F.col("risk_context_label") == "High Burden") & (F.col("composite_quality_score") > above)
    rows = df.where(hit).select("provider_id", "hospital_name", "city", "state", "composite_quality_score",
                                "community_health_burden_score", "risk_context_label")
    rows = rows.orderBy(F.col("composite_quality_score").desc_nulls_last(), "provider_id")
    return rows if limit is None else rows.limit(limit)
