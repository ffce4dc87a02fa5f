"""SQL building blocks for the comparison queries (DuckDB dialect).

They state the same results with what one SQL engine offers: plain windows and
ordered aggregates instead of the distributed forms used by the operators.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from wardlight import fixed_values as fv
from wardlight.sources import adapter


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def settle(x: str) -> str:
    return f"(round_even(({x}) * 1e9, 0) / 1e9)"


def round6(x: str) -> str:
    return f"(round_even(({x}) * 1e6, 0) / 1e6)"


def mean(x: str) -> str:
    """Mean of a decimal expression."""
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def dmean(x: str) -> str:
    """Mean of a double expression, added exactly."""
    return mean(f"CAST(CAST({x} AS DOUBLE) AS DECIMAL(38,18))")


def seeded_hash(x: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(coalesce(CAST({x} AS VARCHAR), '') || ':{seed}'), 1, 15) AS BIGINT)"


def num(x: str, tokens: Sequence[str]) -> str:
    cleaned = f"regexp_replace({x}, '[^0-9.\\-]', '', 'g')"
    return (f"(CASE WHEN lower(coalesce({x}, '')) IN {in_list(tokens)} THEN NULL "
            f"ELSE try_cast(nullif({cleaned}, '') AS DECIMAL(18,6)) END)")


def rating(x: str, tokens: Sequence[str] = fv.RATING_NULLS) -> str:
    return (f"(CASE WHEN lower(coalesce({x}, '')) IN {in_list(tokens)} THEN NULL "
            f"ELSE try_cast(nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '') AS INTEGER) END)")


def lenient(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') " \
           f"THEN try_cast(trim({x}) AS DOUBLE) END)"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[a-z0-9]+|[^a-z0-9]+'), "
            f"lambda w: upper(w[1]) || w[2:]), '')")


def has(c: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"position({q(w)} IN {c}) > 0" for w in words) + ")"


def keywords(c: str, rules, default: str) -> str:
    text = f"lower(coalesce({c}, ''))"
    whens = " ".join(f"WHEN {has(text, words)} THEN {q(label)}" for words, label in rules)
    return f"(CASE {whens} ELSE {q(default)} END)"


def labels(c: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN {c} {op} CAST({v} AS DOUBLE) THEN {q(label)}" for op, v, label in rules)
    return f"(CASE {whens} ELSE {q(default)} END)"


def codes(c: str, mapping, default: int) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {c} {whens} ELSE {default} END AS INTEGER)"


def weighted(parts: dict[str, str], fill: float) -> str:
    weights = {name: w for name, w, _ in fv.MEASURE_WEIGHTS}
    return "(" + " + ".join(
        f"coalesce({c}, {fill}::DOUBLE) * CAST({weights[w]} AS DOUBLE)" for c, w in parts.items()) + ")"


def _cond_means(measures, value: str) -> str:
    return ", ".join(f"{mean(f'CASE WHEN {has('k', words)} THEN {value} END')} AS {name}"
                     for name, words in measures.items())


def _readmissions() -> str:
    texts = ", ".join(f"max(CASE WHEN {has('k', w)} THEN compared END) AS {n}"
                      for n, w in fv.READMISSION_COMPARISONS.items())
    return f"""
SELECT provider_id, {_cond_means(fv.READMISSION_MEASURES, 's')}, {mean('s')} AS avg_readmission_score, {texts}
FROM (SELECT trim(provider_id) AS provider_id, lower(coalesce(measure_id, measure_name, '')) AS k,
             {num('score', fv.READMISSION_NULLS)} AS s, compared_to_national AS compared
      FROM raw_hospitals_readmissions WHERE trim(provider_id) <> '') GROUP BY provider_id"""


def _experience() -> str:
    return f"""
SELECT provider_id, {mean('v')} AS overall_patient_experience_score, {_cond_means(fv.EXPERIENCE_MEASURES, 'v')}
FROM (SELECT provider_id, k, CASE WHEN s <= 5 THEN s * 20 ELSE s END AS v
      FROM (SELECT trim(provider_id) AS provider_id, lower(coalesce(measure_id, measure_name, '')) AS k,
                   {num('score', fv.EXPERIENCE_NULLS)} AS s
            FROM raw_hospitals_patient_experience WHERE trim(provider_id) <> '')) GROUP BY provider_id"""


def _timely() -> str:
    return f"""
SELECT provider_id, {_cond_means(fv.TIMELY_MEASURES, 's')}, {mean('s')} AS avg_timely_care_score
FROM (SELECT trim(provider_id) AS provider_id, lower(coalesce(measure_id, measure_name, '')) AS k,
             {num('score', fv.TIMELY_NULLS)} AS s
      FROM raw_hospitals_timely_care WHERE trim(provider_id) <> '') GROUP BY provider_id"""


def _counties() -> str:
    means = ", ".join(
        mean(f"CASE WHEN k IN {in_list(ids)} OR {has('k', [word])} THEN v END")
        + f" AS {name}" for name, (ids, word) in fv.COMMUNITY_MEASURES.items())
    return f"""
SELECT *, {weighted(fv.BURDEN_COMPONENTS, 0.0)} AS community_health_burden_score
FROM (SELECT county_fips, state, {means}
      FROM (SELECT nullif(trim(county_fips), '') AS county_fips, upper(trim(state)) AS state,
                   lower(coalesce(measure_id, measure, '')) AS k, {num('data_value', fv.COMMUNITY_NULLS)} AS v
            FROM raw_cdc_places_county WHERE trim(state) <> '') GROUP BY county_fips, state)"""


READM_COLS = (*fv.READMISSION_MEASURES, "avg_readmission_score", *fv.READMISSION_COMPARISONS)
COMMUNITY_COLS = (*fv.COMMUNITY_MEASURES, "community_health_burden_score")

CTES: dict[str, str] = {f"raw_{v}": adapter.view_sql(v) for v in adapter.VIEWS}
CTES |= {
    "stg_hospitals": f"""
SELECT trim(provider_id) AS provider_id, trim({initcap('hospital_name')}) AS hospital_name, trim(address) AS address,
       upper(trim(city)) AS city, upper(trim(state)) AS state,
       lpad(regexp_replace(coalesce(zip_code, ''), '[^0-9]', '', 'g'), 5, '0') AS zip_code,
       {initcap('trim(hospital_type)')} AS hospital_type, {initcap('trim(hospital_ownership)')} AS hospital_ownership,
       {rating('overall_rating')} AS overall_rating,
       {keywords('hospital_type', fv.SETTING_RULES, fv.SETTING_DEFAULT)} AS urban_rural
FROM raw_hospitals_general WHERE trim(provider_id) <> ''""",
    "stg_readmissions": _readmissions(),
    "stg_patient_experience": _experience(),
    "stg_timely_care": _timely(),
    "stg_community_health": _counties(),
    "wide": "SELECT * FROM stg_hospitals LEFT JOIN stg_readmissions USING (provider_id) "
            "LEFT JOIN stg_patient_experience USING (provider_id) LEFT JOIN stg_timely_care USING (provider_id)",
    "normed": f"""
SELECT *, 2023 AS year,
       {settle('''CASE WHEN avg_readmission_score IS NULL THEN NULL
             WHEN max(avg_readmission_score) OVER () = min(avg_readmission_score) OVER () THEN 50::DOUBLE
             ELSE 100 - (avg_readmission_score - min(avg_readmission_score) OVER ())
                  / (max(avg_readmission_score) OVER () - min(avg_readmission_score) OVER ()) * 100 END''')}
         AS readmission_performance_score,
       {settle('''CASE WHEN avg_timely_care_score <= 5 THEN avg_timely_care_score * 20
             WHEN avg_timely_care_score > 100
               THEN 100 - least(100, avg_timely_care_score / max(avg_timely_care_score) OVER () * 100)
             ELSE avg_timely_care_score END''')} AS timely_care_score_0_100
FROM wide""",
    "int_hospital_scores": f"""
SELECT *, {settle(weighted(fv.QUALITY_COMPONENTS, 50.0))} AS composite_quality_score,
       {settle('100 - coalesce(readmission_performance_score, 50)')} AS readmission_risk_score FROM normed""",
    "state_health": "SELECT state, " + ", ".join(f"{dmean(c)} AS {c}" for c in COMMUNITY_COLS)
                    + " FROM stg_community_health GROUP BY state",
    "tiled": "SELECT h.*, c.* EXCLUDE (state), CAST(ntile(3) OVER (ORDER BY c.community_health_burden_score NULLS LAST, "
             "h.provider_id) AS INTEGER) AS burden_tertile FROM int_hospital_scores h LEFT JOIN state_health c "
             "ON h.state = c.state",
    "int_community_risk": """
SELECT *, (CASE burden_tertile WHEN 3 THEN 'High Burden' WHEN 2 THEN 'Moderate Burden' ELSE 'Low Burden' END)
       AS risk_context_label FROM tiled""",
    "perf_ranked": "SELECT *, percent_rank() OVER (ORDER BY readmission_risk_score NULLS LAST) AS readmission_pct_rank, "
                   "percent_rank() OVER (ORDER BY composite_quality_score NULLS LAST) AS quality_pct_rank "
                   "FROM int_community_risk",
    "mart_hospital_performance": f"""
SELECT *, {labels('readmission_pct_rank', fv.RISK_LABEL_RULES, fv.RISK_LABEL_DEFAULT)} AS readmission_risk_label,
       {labels('quality_pct_rank', fv.QUALITY_TIER_RULES, fv.QUALITY_TIER_DEFAULT)} AS quality_tier
FROM perf_ranked""",
    "mart_readmission_risk": f"""
SELECT {', '.join((*fv.RISK_MART_COLUMNS, *READM_COLS))},
       rank() OVER (PARTITION BY state ORDER BY readmission_risk_score DESC NULLS LAST) AS state_readmission_rank
FROM int_hospital_scores""",
    "mart_regional_summary": f"""
SELECT state, count(*) AS hospital_count, {dmean('composite_quality_score')} AS avg_quality_score,
       {dmean('readmission_risk_score')} AS avg_readmission_risk,
       CAST(count(*) FILTER (WHERE readmission_risk_label = 'High') AS DOUBLE) / count(*) * 100 AS pct_high_risk,
       CAST(count(*) FILTER (WHERE readmission_risk_label = 'Low') AS DOUBLE) / count(*) * 100 AS pct_low_risk,
       {dmean('community_health_burden_score')} AS avg_community_burden,
       first(hospital_name ORDER BY composite_quality_score DESC NULLS LAST, provider_id) AS top_performing_hospital,
       first(hospital_name ORDER BY readmission_risk_score DESC NULLS LAST, provider_id) AS most_at_risk_hospital
FROM mart_hospital_performance GROUP BY state""",
}


def _features() -> str:
    optional = ", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in fv.OPTIONAL_FEATURES)
    middle = ("(rank() OVER (PARTITION BY state, readmission_risk_score IS NULL ORDER BY readmission_risk_score) "
              "+ (count(*) OVER (PARTITION BY state, readmission_risk_score) - 1) / 2.0::DOUBLE) "
              "/ count(readmission_risk_score) OVER (PARTITION BY state) * 100")
    return f"""
SELECT {', '.join(fv.FEATURE_ID_COLUMNS)}, composite_quality_score,
       CASE WHEN max(readmission_risk_score) OVER () > min(readmission_risk_score) OVER ()
            THEN {settle('''(readmission_risk_score - min(readmission_risk_score) OVER ())
                 / (max(readmission_risk_score) OVER () - min(readmission_risk_score) OVER ()) * 100''')}
            ELSE 50 END AS readmission_risk_score,
       overall_patient_experience_score AS patient_experience_score, community_health_burden_score,
       {codes('lower(urban_rural)', fv.SETTING_CODES, 1)} AS urban_rural_encoded,
       {codes(keywords('hospital_type', fv.TYPE_RULES, 'Other'), fv.TYPE_CODES, 4)} AS hospital_type_encoded,
       {codes(keywords('hospital_ownership', fv.OWNERSHIP_RULES, 'Other'), fv.OWNERSHIP_CODES, 3)} AS ownership_encoded,
       CASE WHEN state IS NOT NULL THEN {dmean_over('composite_quality_score', 'state')} END AS state_avg_quality_score,
       CASE WHEN state IS NOT NULL AND readmission_risk_score IS NOT NULL THEN {settle(middle)} END
         AS state_readmission_percentile, {optional}
FROM mart_hospital_performance"""


def dmean_over(x: str, by: str) -> str:
    d = f"CAST({x} AS DECIMAL(38,18))"
    return f"(CAST(sum({d}) OVER (PARTITION BY {by}) AS DOUBLE) / nullif(count({d}) OVER (PARTITION BY {by}), 0))"


FEATURE_DOUBLES = (
    "composite_quality_score", "readmission_risk_score", "patient_experience_score", "community_health_burden_score",
    "state_avg_quality_score", "state_readmission_percentile", *fv.OPTIONAL_FEATURES,
)
ENCODED = ("urban_rural_encoded", "hospital_type_encoded", "ownership_encoded")
FEATURE_NUMERIC = tuple(c for c in (
    "composite_quality_score", "readmission_risk_score", "patient_experience_score", "community_health_burden_score",
    *ENCODED, "state_avg_quality_score", "state_readmission_percentile", *fv.OPTIONAL_FEATURES))

CTES["features_raw"] = _features()
CTES["features"] = ("SELECT f.* REPLACE (" + ", ".join(
    f"coalesce({c}, (SELECT coalesce(median({c}), 0) FROM features_raw)) AS {c}" for c in FEATURE_DOUBLES)
    + ") FROM features_raw f")

_WORD = re.compile(r"[a-z_0-9]+")


def complete(sql: str, doubles: Sequence[str] = ()) -> str:
    """`sql` with the tables it uses put before it and `doubles` at six decimals."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(_WORD.findall(todo.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                todo.append(CTES[word])
    body = sql.strip().rstrip(";")
    if doubles:
        body = f"SELECT * REPLACE ({', '.join(f'{round6(c)} AS {c}' for c in doubles)}) FROM ({body})"
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body
