"""Raw text tables to typed tables, one row per facility or county."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions import columns as c
from wardlight.operators.aggregates import pivot
from wardlight.sources.seeds import component_weights


def require_key(df: DataFrame, col: str) -> DataFrame:
    """Rows whose key is blank or NULL are dropped."""
    return df.where(c.clean_key(col).isNotNull())


def hospitals(raw: DataFrame) -> DataFrame:
    return require_key(raw, "provider_id").select(
        c.clean_key("provider_id").alias("provider_id"),
        F.trim(c.initcap_alnum("hospital_name")).alias("hospital_name"),
        F.trim(F.col("address").cast("string")).alias("address"),
        c.code("city").alias("city"),
        c.code("state").alias("state"),
        c.zip5("zip_code").alias("zip_code"),
        c.initcap_alnum(F.trim("hospital_type")).alias("hospital_type"),
        c.initcap_alnum(F.trim("hospital_ownership")).alias("hospital_ownership"),
        c.parse_rating("overall_rating").alias("overall_rating"),
        c.keyword_case("hospital_type", fv.SETTING_RULES, fv.SETTING_DEFAULT).alias("urban_rural"),
    )


def _keyword_measures(words: Mapping[str, tuple[str, ...]]) -> dict:
    return {name: c.any_like("measure_key", w) for name, w in words.items()}


def readmissions(raw: DataFrame) -> DataFrame:
    rows = require_key(raw, "provider_id").select(
        c.clean_key("provider_id").alias("provider_id"),
        c.measure_key("measure_id", "measure_name").alias("measure_key"),
        c.parse_numeric("score", fv.READMISSION_NULLS).alias("score"),
        F.col("compared_to_national").cast("string").alias("compared"),
    )
    means = _keyword_measures(fv.READMISSION_MEASURES) | {"avg_readmission_score": None}
    return pivot(rows, ["provider_id"], "score", means,
                 text="compared", text_max=_keyword_measures(fv.READMISSION_COMPARISONS))


def patient_experience(raw: DataFrame) -> DataFrame:
    rows = require_key(raw, "provider_id").select(
        c.clean_key("provider_id").alias("provider_id"),
        c.measure_key("measure_id", "measure_name").alias("measure_key"),
        c.star_to_100(c.parse_numeric("score", fv.EXPERIENCE_NULLS)).alias("score"),
    )
    means = {"overall_patient_experience_score": None} | _keyword_measures(fv.EXPERIENCE_MEASURES)
    return pivot(rows, ["provider_id"], "score", means)


def timely_care(raw: DataFrame) -> DataFrame:
    rows = require_key(raw, "provider_id").select(
        c.clean_key("provider_id").alias("provider_id"),
        c.measure_key("measure_id", "measure_name").alias("measure_key"),
        c.parse_numeric("score", fv.TIMELY_NULLS).alias("score"),
    )
    means = _keyword_measures(fv.TIMELY_MEASURES) | {"avg_timely_care_score": None}
    return pivot(rows, ["provider_id"], "score", means)


def community_health(raw: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """One row per county (NULL county included) and state, with the weighted burden."""
    rows = require_key(raw, "state").select(
        c.clean_key("county_fips").alias("county_fips"),
        c.code("state").alias("state"),
        c.measure_key("measure_id", "measure").alias("measure_key"),
        c.parse_numeric("data_value", fv.COMMUNITY_NULLS).alias("value"),
    )
    means = {
        name: c.in_or_like("measure_key", ids, [word]) for name, (ids, word) in fv.COMMUNITY_MEASURES.items()
    }
    weights = weights or component_weights()
    burden = c.weighted_score({k: weights[w] for k, w in fv.BURDEN_COMPONENTS.items()}, fill=0.0)
    return pivot(rows, ["county_fips", "state"], "value", means).withColumn(
        "community_health_burden_score", burden)
