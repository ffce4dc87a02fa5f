"""Report pages and the fixed analytics questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.registry import Inputs, query
from wardlight.catalogue.relational import (BEST, BOX_D, IMPROVEMENT_D, IMPROVEMENT_SQL, KPI_D, KPI_SQL, LEADERS, M,
                                            RISKIEST, box_sql, histogram_sql)
from wardlight.operators import ordering
from wardlight.plans import pages

QUALITY, RISK = "composite_quality_score", "readmission_risk_score"
STATE = "NATION_6"
CHOSEN = "state IN ('NATION_3', 'NATION_6', 'NATION_9') AND readmission_risk_label IN ('High', 'Medium')"


def _overview(i: Inputs):
    return pages.national_overview(i.performance, i.regions, states=["NATION_3", "NATION_6", "NATION_9"],
                                   risks=["High", "Medium"], search="MARY|city_1")


# ---- national overview -----------------------------------------------------

@query("overview_kpis", f"{KPI_SQL} WHERE {CHOSEN}", KPI_D)
def _(i: Inputs):
    return _overview(i)["kpis"]


@query("overview_histogram", histogram_sql(f"(SELECT * FROM {M} WHERE {CHOSEN})", QUALITY, fv.OVERVIEW_BINS), ["low", "high"])
def _(i: Inputs):
    return _overview(i)["histogram"]


@query("overview_box", box_sql(f"(SELECT * FROM {M} WHERE {CHOSEN})", QUALITY), BOX_D)
def _(i: Inputs):
    return _overview(i)["box"]


@query("overview_risk_counts", f"""
SELECT readmission_risk_label, count(*) AS n, CAST(CASE readmission_risk_label WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2
       ELSE 3 END AS INTEGER) AS place FROM {M} WHERE {CHOSEN} GROUP BY readmission_risk_label""")
def _(i: Inputs):
    return _overview(i)["risk_counts"]


@query("overview_type_mix", f"""
SELECT hospital_type, count(provider_id) AS hospitals, {o.dmean(QUALITY)} AS avg_quality, {o.dmean(RISK)} AS avg_risk
FROM {M} WHERE {CHOSEN} GROUP BY hospital_type ORDER BY hospitals DESC, hospital_type LIMIT 15""",
       ["avg_quality", "avg_risk"])
def _(i: Inputs):
    return _overview(i)["type_mix"]


@query("overview_leaderboard", f"""
SELECT {', '.join(fv.OVERVIEW_COLUMNS)} FROM {M} WHERE {CHOSEN}
  AND (regexp_matches(lower(coalesce(hospital_name, '')), 'mary|city_1') OR regexp_matches(lower(coalesce(city, '')), 'mary|city_1')
       OR regexp_matches(lower(coalesce(state, '')), 'mary|city_1')) {BEST} LIMIT 300""",
       [QUALITY, RISK, "overall_patient_experience_score"])
def _(i: Inputs):
    return _overview(i)["leaderboard"]


# ---- search, map, scorecard ------------------------------------------------

@query("hospital_search", f"""
SELECT {', '.join(fv.SEARCH_RESULT)} FROM {M} WHERE hospital_name ILIKE '%mary%' OR city ILIKE '%mary%'
   OR state ILIKE '%mary%' {BEST} LIMIT 500""", [QUALITY, "community_health_burden_score"])
def _(i: Inputs):
    return pages.hospital_search(i.performance, "mary")


def _map(i: Inputs):
    return pages.readmission_map(i.performance, types=["Psychiatric", "Childrens"], owners=["Proprietary", "Tribal"])


MAPPED = "hospital_type IN ('Psychiatric', 'Childrens') AND hospital_ownership IN ('Proprietary', 'Tribal')"


@query("map_states", f"""
SELECT state, {o.dmean(RISK)} AS avg_readmission_risk_score, count(provider_id) AS hospital_count FROM {M}
WHERE {MAPPED} AND state IS NOT NULL GROUP BY state""", ["avg_readmission_risk_score"])
def _(i: Inputs):
    return _map(i)["states"]


@query("map_kpis", f"SELECT hospitals, avg_risk, high_risk_pct FROM ({KPI_SQL} WHERE {MAPPED})", ["avg_risk", "high_risk_pct"])
def _(i: Inputs):
    return _map(i)["kpis"]


@query("quality_scorecard", f"""
SELECT {', '.join(fv.SCORECARD_COLUMNS)}, CASE WHEN {QUALITY} >= 70 THEN 'green' WHEN {QUALITY} >= 50 THEN 'amber'
       ELSE 'red' END AS quality_band FROM {M} WHERE {QUALITY} BETWEEN 40 AND 75""",
       [QUALITY, RISK, "overall_patient_experience_score", "community_health_burden_score"])
def _(i: Inputs):
    return pages.scorecard(i.performance, 40.0, 75.0)


# ---- community health ------------------------------------------------------

COMMUNITY_CORR = " UNION ALL ".join(
    f"SELECT {o.q(t)} AS title, corr({x}, {y}) AS r FROM {M}" for x, y, t in fv.CORRELATION_PAIRS)


@query("community_correlations", COMMUNITY_CORR, ["r"])
def _(i: Inputs):
    return pages.community_page(i.performance)["correlations"]


@query("community_strongest", f"SELECT * FROM ({COMMUNITY_CORR}) ORDER BY abs(r) DESC NULLS LAST, title LIMIT 1", ["r"])
def _(i: Inputs):
    return pages.community_page(i.performance)["strongest"]


@query("community_trend_lines", " UNION ALL ".join(f"""
SELECT {o.q(x)} AS measure, readmission_risk_label, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept,
       regr_r2({y}, {x}) AS r2, CAST(regr_count({y}, {x}) AS BIGINT) AS n
FROM {M} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY readmission_risk_label""" for x, y, _ in fv.CORRELATION_PAIRS),
       ["slope", "intercept", "r2"])
def _(i: Inputs):
    page = pages.community_page(i.performance)
    lines = [page[f"line_{x}"].select(F.lit(x).alias("measure"), "*") for x, _, _ in fv.CORRELATION_PAIRS]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


@query("community_state_burden", f"""
SELECT state, {o.dmean('community_health_burden_score')} AS community_health_burden_score FROM {M}
WHERE state IS NOT NULL GROUP BY state ORDER BY community_health_burden_score DESC NULLS LAST, state LIMIT 25""",
       ["community_health_burden_score"])
def _(i: Inputs):
    return pages.community_page(i.performance)["state_burden"]


# ---- performance -----------------------------------------------------------

@query("performance_page_kpis", f"""
SELECT count(*) AS hospitals, {o.dmean(QUALITY)} AS avg_quality, {o.dmean(RISK)} AS avg_risk,
       count(*) FILTER (WHERE lower(readmission_risk_label) = 'high') AS high_risk_hospitals
FROM {M} WHERE hospital_name IS NOT NULL AND state = '{STATE}'""", ["avg_quality", "avg_risk"])
def _(i: Inputs):
    return pages.performance_page(i.performance, STATE)["kpis"]


@query("performance_page_histogram", histogram_sql(f"{M}", QUALITY, fv.PERFORMANCE_BINS), ["low", "high"])
def _(i: Inputs):
    return pages.performance_page(i.performance)["histogram"]


@query("performance_page_best", f"SELECT {LEADERS} FROM {M} WHERE state = '{STATE}' {BEST} LIMIT 15", [QUALITY])
def _(i: Inputs):
    return pages.performance_page(i.performance, STATE)["best"]


@query("performance_page_riskiest", f"""
SELECT {RISKIEST} FROM {M} WHERE state = '{STATE}' ORDER BY {RISK} DESC, provider_id LIMIT 15""", [QUALITY, RISK])
def _(i: Inputs):
    return pages.performance_page(i.performance, STATE)["riskiest"]


@query("performance_page_scatter", f"""
SELECT hospital_name, city, state, readmission_risk_label, {QUALITY}, {RISK} FROM {M}
WHERE {QUALITY} IS NOT NULL AND {RISK} IS NOT NULL""", [QUALITY, RISK])
def _(i: Inputs):
    return pages.performance_page(i.performance)["scatter"]


@query("performance_page_table", f"""
SELECT hospital_name, city, state, hospital_type, {QUALITY}, {RISK},
       overall_patient_experience_score AS patient_experience_score, readmission_risk_label, quality_tier FROM {M}
WHERE hospital_name IS NOT NULL""", [QUALITY, RISK, "patient_experience_score"])
def _(i: Inputs):
    return pages.performance_page(i.performance)["full"]


# ---- questions -------------------------------------------------------------

@query("question_states_by_risk", f"""
SELECT state, {o.dmean(RISK)} AS avg_readmission_risk FROM {M} GROUP BY state
ORDER BY avg_readmission_risk DESC NULLS LAST, state LIMIT 10""", ["avg_readmission_risk"])
def _(i: Inputs):
    return pages.states_by_risk(i.performance)


@query("question_high_risk_in_state", f"""
SELECT provider_id, hospital_name, city, state, {RISK}, readmission_risk_label FROM {M}
WHERE state = '{STATE}' AND readmission_risk_label = 'High' ORDER BY {RISK} DESC, provider_id LIMIT 50""", [RISK])
def _(i: Inputs):
    return pages.high_risk_in_state(i.performance, STATE)


@query("question_top_quality", f"""
SELECT provider_id, hospital_name, city, state, {QUALITY} FROM {M} {BEST} LIMIT 10""", [QUALITY])
def _(i: Inputs):
    return pages.top_quality(i.performance)


@query("question_quality_by_type", f"""
SELECT hospital_type, {o.dmean(QUALITY)} AS avg_quality_score, count(*) AS hospital_count FROM {M}
GROUP BY hospital_type""", ["avg_quality_score"])
def _(i: Inputs):
    return pages.quality_by_type(i.performance)


@query("question_burdened_but_good", f"""
SELECT provider_id, hospital_name, city, state, {QUALITY}, community_health_burden_score, risk_context_label FROM {M}
WHERE risk_context_label = 'High Burden' AND {QUALITY} > 50 {BEST} LIMIT 50""", [QUALITY, "community_health_burden_score"])
def _(i: Inputs):
    return pages.burdened_but_good(i.performance, above=50.0)


@query("question_low_risk_high_experience", f"""
SELECT provider_id, hospital_name, city, state, {RISK}, overall_patient_experience_score FROM {M}
WHERE state = 'NATION_11' AND readmission_risk_label = 'Low' AND overall_patient_experience_score >= 45
ORDER BY overall_patient_experience_score DESC, provider_id LIMIT 50""", [RISK, "overall_patient_experience_score"])
def _(i: Inputs):
    return pages.low_risk_high_experience(i.performance, "NATION_11", experience_min=45.0)


@query("question_risk_factors", " UNION ALL ".join(
    f"SELECT {o.q(m)} AS title, corr({m}, {RISK}) AS r FROM {M}" for m in fv.COMMUNITY_MEASURES), ["r"])
def _(i: Inputs):
    return pages.risk_factor_correlations(i.performance)


@query("question_top_quality_in_state", f"""
SELECT provider_id, hospital_name, city, state, {QUALITY} FROM {M} WHERE state = '{STATE}' {BEST} LIMIT 10""", [QUALITY])
def _(i: Inputs):
    return pages.top_quality(i.performance, state=STATE)


@query("question_most_improved", IMPROVEMENT_SQL, IMPROVEMENT_D)
def _(i: Inputs):
    history = {y: i.raw(f"hospitals_general_{y}") for y in (2021, 2022)}
    return ordering.improvement(ordering.trend(i.performance, history, fv.CURRENT_YEAR), 2021, 2023)
