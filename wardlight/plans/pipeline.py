"""From raw tables to marts: one call per layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wardlight.plans import marts, scores, staging
from wardlight.sources.layers import build_layer
from wardlight.workspace import in_parallel


def staging_layer(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_hospitals": staging.hospitals(raw["hospitals_general"]),
        "stg_readmissions": staging.readmissions(raw["hospitals_readmissions"]),
        "stg_patient_experience": staging.patient_experience(raw["hospitals_patient_experience"]),
        "stg_timely_care": staging.timely_care(raw["hospitals_timely_care"]),
        "stg_community_health": staging.community_health(raw["cdc_places_county"]),
    }


def intermediate_layer(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Scores and community context; facility measures and state means are built side by side."""
    scored, states = in_parallel(
        stg["stg_hospitals"].sparkSession,
        lambda: scores.hospital_scores(stg["stg_hospitals"], stg["stg_readmissions"],
                                       stg["stg_patient_experience"], stg["stg_timely_care"]),
        lambda: scores.state_health(stg["stg_community_health"]))
    return {"int_hospital_scores": scored, "int_community_risk": scores.community_risk(scored, states)}


def build_marts(raw: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Staging and intermediate views, then the three stored marts.

    The regional summary reads the stored performance mart.
    """
    stg = build_layer(staging_layer(raw), "staging", root)
    mid = build_layer(intermediate_layer(stg), "intermediate", root)
    out = build_layer({
        "mart_hospital_performance": marts.hospital_performance(mid["int_community_risk"]),
        "mart_readmission_risk": marts.readmission_risk(mid["int_hospital_scores"]),
    }, "marts", root)
    out |= build_layer({"mart_regional_summary": marts.regional_summary(out["mart_hospital_performance"])},
                       "marts", root)
    return out
