"""Reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardlight import fixed_values as fv
from wardlight.functions import columns
from wardlight.operators import ranking
from wardlight.operators.aggregates import regional_summary

READMISSION_COLUMNS = (*fv.READMISSION_MEASURES, "avg_readmission_score", *fv.READMISSION_COMPARISONS)


def hospital_performance(contextual: DataFrame) -> DataFrame:
    """Adds the global percent ranks and the labels cut from them."""
    ranks = {"readmission_risk_score": "readmission_pct_rank", "composite_quality_score": "quality_pct_rank"}
    ranked = ranking.attach_percent_ranks(contextual, ranks)
    return (ranked
            .withColumn("readmission_risk_label",
                        columns.bucket_label("readmission_pct_rank", fv.RISK_LABEL_RULES, fv.RISK_LABEL_DEFAULT))
            .withColumn("quality_tier",
                        columns.bucket_label("quality_pct_rank", fv.QUALITY_TIER_RULES, fv.QUALITY_TIER_DEFAULT))
            .select(*contextual.columns, "readmission_pct_rank", "quality_pct_rank",
                    "readmission_risk_label", "quality_tier"))


def readmission_risk(scores: DataFrame, readmissions: DataFrame | None = None) -> DataFrame:
    """Risk rows with the rank inside the state.

    The score table already carries the readmission measures of the same key,
    so they are projected from it; pass `readmissions` to join another set.
    """
    base = scores.select(*fv.RISK_MART_COLUMNS, *READMISSION_COLUMNS)
    if readmissions is not None:
        measures = readmissions.select("provider_id", *READMISSION_COLUMNS)
        base = scores.select(*fv.RISK_MART_COLUMNS).join(measures, "provider_id", "left")
    return ranking.rank_in(base, ["state"], "readmission_risk_score", "provider_id", "state_readmission_rank")


__all__ = ["hospital_performance", "readmission_risk", "regional_summary"]
