"""Staging tables, scores, marts, trends and features."""

from __future__ import annotations

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.registry import Inputs, query
from wardlight.operators import ordering
from wardlight.plans import features, marts

READM = (*fv.READMISSION_MEASURES, "avg_readmission_score")
EXPERIENCE = ("overall_patient_experience_score", *fv.EXPERIENCE_MEASURES)
TIMELY = (*fv.TIMELY_MEASURES, "avg_timely_care_score")
COMMUNITY = (*fv.COMMUNITY_MEASURES, "community_health_burden_score")
SCORES = (*READM, *EXPERIENCE, *TIMELY, "readmission_performance_score", "timely_care_score_0_100",
          "composite_quality_score", "readmission_risk_score")
CONTEXT = (*SCORES, *COMMUNITY)
PERFORMANCE = (*CONTEXT, "readmission_pct_rank", "quality_pct_rank")
RISK = ("readmission_risk_score", "readmission_performance_score", *READM)
REGION = ("avg_quality_score", "avg_readmission_risk", "pct_high_risk", "pct_low_risk", "avg_community_burden")
TREND = ("quality_score", "readmission_risk_score", "national_avg_quality_score",
         "national_avg_readmission_risk_score")


@query("stg_hospitals", "SELECT * FROM stg_hospitals")
def _(i: Inputs):
    return i.hospitals


@query("stg_readmissions", "SELECT * FROM stg_readmissions", READM)
def _(i: Inputs):
    return i.readmissions


@query("stg_patient_experience", "SELECT * FROM stg_patient_experience", EXPERIENCE)
def _(i: Inputs):
    return i.experience


@query("stg_timely_care", "SELECT * FROM stg_timely_care", TIMELY)
def _(i: Inputs):
    return i.timely


@query("stg_community_health", "SELECT * FROM stg_community_health", COMMUNITY)
def _(i: Inputs):
    return i.counties


@query("int_hospital_scores", "SELECT * FROM int_hospital_scores", SCORES)
def _(i: Inputs):
    return i.build_scores()


@query("int_community_risk", "SELECT * FROM int_community_risk", CONTEXT)
def _(i: Inputs):
    return i.build_community()


@query("mart_hospital_performance", "SELECT * FROM mart_hospital_performance", PERFORMANCE)
def _(i: Inputs):
    return i.build_performance()


@query("mart_readmission_risk", "SELECT * FROM mart_readmission_risk", RISK)
def _(i: Inputs):
    return marts.readmission_risk(i.build_scores())


@query("mart_regional_summary", "SELECT * FROM mart_regional_summary", REGION)
def _(i: Inputs):
    return marts.regional_summary(i.build_performance())


def _history(year: int) -> str:
    return f"""SELECT trim(provider_id), hospital_name, {year},
       CAST({o.rating('overall_rating', fv.TREND_RATING_NULLS)} AS DOUBLE) * 20, NULL, NULL, NULL
FROM raw_hospitals_general_{year} WHERE trim(provider_id) <> ''"""


TREND_SQL = f"""
SELECT provider_id, hospital_name, 2023 AS year, composite_quality_score AS quality_score, readmission_risk_score,
       m.q AS national_avg_quality_score, m.r AS national_avg_readmission_risk_score
FROM mart_hospital_performance
CROSS JOIN (SELECT {o.dmean('composite_quality_score')} AS q, {o.dmean('readmission_risk_score')} AS r
            FROM mart_hospital_performance) m
UNION ALL {_history(2022)} UNION ALL {_history(2021)}"""
o.CTES["trend"] = TREND_SQL


@query("trends_by_year", "SELECT * FROM trend", TREND)
def _(i: Inputs):
    history = {y: i.raw(f"hospitals_general_{y}") for y in (2021, 2022)}
    return ordering.trend(i.performance, history, fv.CURRENT_YEAR)


@query("feature_matrix", "SELECT * FROM features", o.FEATURE_DOUBLES)
def _(i: Inputs):
    return features.feature_matrix(i.performance)[0]
