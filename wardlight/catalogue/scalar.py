"""Column expressions: text, numbers, scores, labels, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.registry import Inputs, query
from wardlight.functions import columns as c
from wardlight.functions.exact import mean
from wardlight.ml.train import label_index
from wardlight.operators.joins import with_global
from wardlight.operators.shape import ensure_columns, select_existing, tag
from wardlight.plans.features import ownership_bucket, type_bucket
from wardlight.sources.seeds import weights_table
from wardlight.workspace import stage

G = "FROM raw_hospitals_general"


@query("clean_key", f"SELECT zip_code, nullif(trim(provider_id), '') AS provider_id {G}")
def _(i: Inputs):
    return i.raw("hospitals_general").select("zip_code", c.clean_key("provider_id").alias("provider_id"))


@query("parse_numeric",
       f"SELECT provider_id, measure_id, score, CAST({o.num('score', fv.READMISSION_NULLS)} AS DOUBLE) AS value "
       "FROM raw_hospitals_readmissions", ["value"])
def _(i: Inputs):
    value = c.parse_numeric("score", fv.READMISSION_NULLS)
    return i.raw("hospitals_readmissions").select("provider_id", "measure_id", "score", value.alias("value"))


@query("parse_rating", f"SELECT zip_code, {o.rating('overall_rating')} AS rating {G}")
def _(i: Inputs):
    return i.raw("hospitals_general").select("zip_code", c.parse_rating("overall_rating").alias("rating"))


# Texts with percent signs, thousands separators and null tokens, made from whole numbers.
DIRTY = """CASE l_linenumber % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN cast(cast(l_quantity as int) as {text}) || '%'
    WHEN 2 THEN '1,' || lpad(cast(cast(l_quantity as int) as {text}), 3, '0') WHEN 3 THEN 'N/A'
    WHEN 4 THEN '-' || cast(l_linenumber as {text}) || '.5' ELSE cast(l_suppkey as {text}) END"""
DIRTY_DUCK = DIRTY.format(text="varchar")


@query("coerce_numeric", f"""
SELECT dirty, CASE WHEN translate(dirty, '%,', '') NOT IN {o.in_list(fv.COERCE_NULLS)}
                   THEN {o.lenient("translate(dirty, '%,', '')")} END AS value, count(*) AS n
FROM (SELECT {DIRTY_DUCK} AS dirty FROM lineitem) GROUP BY ALL""", ["value"])
def _(i: Inputs):
    dirty = i.table("lineitem").select(F.expr(DIRTY.format(text="string")).alias("dirty"))
    return dirty.select("dirty", c.coerce_numeric("dirty").alias("value")).groupBy("dirty", "value").agg(
        F.count(F.lit(1)).alias("n"))


@query("to_number", f"""
SELECT score, {o.lenient('score')} AS value, count(*) AS n FROM raw_hospitals_readmissions GROUP BY ALL""", ["value"])
def _(i: Inputs):
    rows = i.raw("hospitals_readmissions").select("score", c.to_number("score").alias("value"))
    return rows.groupBy("score", "value").agg(F.count(F.lit(1)).alias("n"))


@query("initcap_alnum", f"SELECT zip_code, trim({o.initcap('hospital_name')}) AS hospital_name {G}")
def _(i: Inputs):
    return i.raw("hospitals_general").select("zip_code", F.trim(c.initcap_alnum("hospital_name")).alias("hospital_name"))


@query("upper_codes", f"SELECT zip_code AS id, upper(trim(city)) AS city, upper(trim(state)) AS state {G}")
def _(i: Inputs):
    return i.raw("hospitals_general").select(
        F.col("zip_code").alias("id"), c.code("city").alias("city"), c.code("state").alias("state"))


@query("zip5", f"""
SELECT zip_code AS raw_zip, lpad(regexp_replace(coalesce(zip_code, ''), '[^0-9]', '', 'g'), 5, '0') AS zip_code {G}""")
def _(i: Inputs):
    return i.raw("hospitals_general").select(F.col("zip_code").alias("raw_zip"), c.zip5("zip_code").alias("zip_code"))


@query("keyword_case", f"SELECT zip_code, {o.keywords('hospital_type', fv.SETTING_RULES, 'Urban')} AS urban_rural {G}")
def _(i: Inputs):
    setting = c.keyword_case("hospital_type", fv.SETTING_RULES, fv.SETTING_DEFAULT)
    return i.raw("hospitals_general").select("zip_code", setting.alias("urban_rural"))


@query("measure_key", """
SELECT lower(coalesce(measure_id, measure_name, '')) AS measure_key, coalesce(measure_name, measure_id, '') AS measure_name,
       count(*) AS n FROM raw_hospitals_readmissions GROUP BY ALL""")
def _(i: Inputs):
    rows = i.raw("hospitals_readmissions").select(
        c.measure_key("measure_id", "measure_name").alias("measure_key"),
        c.coalesce_text("measure_name", "measure_id").alias("measure_name"))
    return rows.groupBy("measure_key", "measure_name").agg(F.count(F.lit(1)).alias("n"))


@query("weighted_score", f"""
SELECT provider_id, {o.weighted(fv.QUALITY_COMPONENTS, 50.0)} AS score,
       100 - coalesce(readmission_performance_score, 50) AS inverted FROM int_hospital_scores""", ["score", "inverted"])
def _(i: Inputs):
    weights = {r["component"]: r["weight"] for r in weights_table(i.spark).collect()}
    parts = {col: weights[name] for col, name in fv.QUALITY_COMPONENTS.items()}
    return i.performance.select("provider_id", c.weighted_score(parts, fv.NEUTRAL_SCORE).alias("score"),
                                c.invert_score("readmission_performance_score").alias("inverted"))


@query("burden_index", f"""
SELECT county_fips, state, {o.weighted(fv.BURDEN_COMPONENTS, 0.0)} AS burden FROM stg_community_health""", ["burden"])
def _(i: Inputs):
    weights = {r["component"]: r["weight"] for r in weights_table(i.spark).collect()}
    parts = {col: weights[name] for col, name in fv.BURDEN_COMPONENTS.items()}
    return i.counties.select("county_fips", "state", c.weighted_score(parts, 0.0).alias("burden"))


_WEIGHT_VALUES = ", ".join(f"({o.q(n)}, CAST({w} AS DOUBLE), {o.q(d)})" for n, w, d in fv.MEASURE_WEIGHTS)
_PART_MEANS = " UNION ALL ".join(
    f"SELECT {o.q(name)} AS component, {o.dmean(f'coalesce({col}, 50)')} AS mean_score FROM int_hospital_scores"
    for col, name in fv.QUALITY_COMPONENTS.items())


@query("component_weights", f"""
SELECT w.component, w.weight, w.description, m.mean_score, m.mean_score * w.weight AS contribution
FROM (VALUES {_WEIGHT_VALUES}) w(component, weight, description) LEFT JOIN ({_PART_MEANS}) m
     ON w.component = m.component""", ["weight", "mean_score", "contribution"])
def _(i: Inputs):
    parts = F.array(*[F.struct(F.lit(name).alias("component"), F.coalesce(F.col(col), F.lit(50.0)).alias("score"))
                      for col, name in fv.QUALITY_COMPONENTS.items()])
    means = i.performance.select(F.explode(parts).alias("p")).groupBy("p.component").agg(
        mean(F.col("p.score")).alias("mean_score"))
    return weights_table(i.spark).join(means, "component", "left").withColumn(
        "contribution", F.col("mean_score") * F.col("weight"))


_STARS = o.num("score", fv.EXPERIENCE_NULLS)


@query("star_to_100", f"""
SELECT measure_id, score, CAST(CASE WHEN {_STARS} <= 5 THEN {_STARS} * 20 ELSE {_STARS} END AS DOUBLE) AS value,
       count(*) AS n FROM raw_hospitals_patient_experience GROUP BY ALL""", ["value"])
def _(i: Inputs):
    value = c.star_to_100(c.parse_numeric("score", fv.EXPERIENCE_NULLS))
    rows = i.raw("hospitals_patient_experience").select("measure_id", "score", value.alias("value"))
    return rows.groupBy("measure_id", "score", "value").agg(F.count(F.lit(1)).alias("n"))


@query("piecewise_scale", """
SELECT provider_id, avg_timely_care_score AS raw_score,
       CASE WHEN avg_timely_care_score IS NULL THEN NULL WHEN avg_timely_care_score <= 5 THEN avg_timely_care_score * 20
            WHEN avg_timely_care_score <= 100 THEN avg_timely_care_score
            ELSE 100 - least(100, avg_timely_care_score * 100 / (SELECT max(avg_timely_care_score) FROM stg_timely_care))
       END AS scaled FROM stg_timely_care""", ["raw_score", "scaled"])
def _(i: Inputs):
    rows = with_global(stage(i.timely.select("provider_id", "avg_timely_care_score"), "timely"),
                       high=F.max("avg_timely_care_score"))
    return rows.select("provider_id", F.col("avg_timely_care_score").alias("raw_score"),
                       c.piecewise_scale("avg_timely_care_score", "high").alias("scaled"))


@query("min_max_100", """
SELECT l_orderkey, l_linenumber, (l_extendedprice - lo) / (hi - lo) * 100 AS scaled,
       100 - (l_extendedprice - lo) / (hi - lo) * 100 AS inverted
FROM lineitem CROSS JOIN (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)""",
       ["scaled", "inverted"])
def _(i: Inputs):
    rows = with_global(i.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
                       lo=F.min("l_extendedprice"), hi=F.max("l_extendedprice"))
    scale = lambda invert: c.min_max_100("l_extendedprice", F.col("lo"), F.col("hi"), invert)
    return rows.select("l_orderkey", "l_linenumber", scale(False).alias("scaled"), scale(True).alias("inverted"))


@query("percent_rank_labels", f"""
SELECT provider_id, {o.labels('readmission_pct_rank', fv.RISK_LABEL_RULES, 'Medium')} AS risk_label,
       {o.labels('quality_pct_rank', fv.QUALITY_TIER_RULES, 'Average')} AS tier,
       CASE WHEN burden_tertile = 3 THEN 'High Burden' WHEN burden_tertile = 2 THEN 'Moderate Burden'
            ELSE 'Low Burden' END AS burden FROM mart_hospital_performance""")
def _(i: Inputs):
    return i.performance.select(
        "provider_id",
        c.bucket_label("readmission_pct_rank", fv.RISK_LABEL_RULES, fv.RISK_LABEL_DEFAULT).alias("risk_label"),
        c.bucket_label("quality_pct_rank", fv.QUALITY_TIER_RULES, fv.QUALITY_TIER_DEFAULT).alias("tier"),
        c.value_case("burden_tertile", fv.BURDEN_LABELS, fv.BURDEN_DEFAULT).alias("burden"))


@query("tagged_year", "SELECT provider_id, 2023 AS year FROM stg_hospitals")
def _(i: Inputs):
    return tag(i.hospitals.select("provider_id"), "year", fv.CURRENT_YEAR)


@query("ownership_and_type_buckets", f"""
SELECT zip_code, {o.keywords('hospital_ownership', fv.OWNERSHIP_RULES, 'Other')} AS ownership,
       {o.keywords('hospital_type', fv.TYPE_RULES, 'Other')} AS type {G}""")
def _(i: Inputs):
    return i.raw("hospitals_general").select(
        "zip_code", ownership_bucket("hospital_ownership").alias("ownership"), type_bucket("hospital_type").alias("type"))


@query("ordinal_encoding", f"""
SELECT zip_code, {o.codes(o.keywords('hospital_ownership', fv.OWNERSHIP_RULES, 'Other'), fv.OWNERSHIP_CODES, 3)}
       AS ownership_code,
       {o.codes(o.keywords('hospital_type', fv.TYPE_RULES, 'Other'), fv.TYPE_CODES, 4)} AS type_code {G}""")
def _(i: Inputs):
    return i.raw("hospitals_general").select(
        "zip_code",
        c.encode(ownership_bucket("hospital_ownership"), fv.OWNERSHIP_CODES, 3).alias("ownership_code"),
        c.encode(type_bucket("hospital_type"), fv.TYPE_CODES, 4).alias("type_code"))


@query("label_index", """
SELECT zip_code, CAST(dense_rank() OVER (ORDER BY hospital_type) - 1 AS INTEGER) AS type_index
FROM raw_hospitals_general""")
def _(i: Inputs):
    return label_index(i.raw("hospitals_general"), "hospital_type", "type_index").select("zip_code", "type_index")


@query("rating_to_100", f"""
SELECT zip_code, CAST({o.rating('overall_rating', fv.TREND_RATING_NULLS)} AS DOUBLE) * 20 AS quality_score
FROM raw_hospitals_general_2022""", ["quality_score"])
def _(i: Inputs):
    return i.raw("hospitals_general_2022").select("zip_code", c.rating_to_100("overall_rating").alias("quality_score"))


@query("ensure_columns", f"""
SELECT zip_code, hospital_name, {o.lenient('overall_rating')} AS overall_rating,
       'Unknown' AS quality_tier {G}""", ["overall_rating"])
def _(i: Inputs):
    rows = i.raw("hospitals_general").select("zip_code", "hospital_name", "overall_rating")
    return ensure_columns(rows, {"hospital_name": "Unknown hospital", "quality_tier": "Unknown"}, ["overall_rating"])


@query("select_existing", "SELECT p_partkey, p_brand FROM part")
def _(i: Inputs):
    return select_existing(i.table("part"), ["p_partkey", "p_colour", "p_brand"])


@query("quality_bands", """
SELECT CASE WHEN composite_quality_score >= 70 THEN 'green' WHEN composite_quality_score >= 50 THEN 'amber'
            ELSE 'red' END AS band, count(*) AS n FROM mart_hospital_performance GROUP BY ALL""")
def _(i: Inputs):
    colour = c.band("composite_quality_score", fv.QUALITY_BANDS, fv.QUALITY_BAND_DEFAULT)
    return i.performance.groupBy(colour.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("flags", """
SELECT provider_id, CASE WHEN readmission_risk_label = 'High' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_high,
       CASE WHEN overall_patient_experience_score IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS unknown_experience
FROM mart_hospital_performance""")
def _(i: Inputs):
    return i.performance.select(
        "provider_id", c.flag(F.col("readmission_risk_label") == "High").alias("is_high"),
        c.flag(F.col("overall_patient_experience_score").isNull()).alias("unknown_experience"))


@query("features_map", """
SELECT p_partkey, 'p_size' AS feature, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""", ["value"])
def _(i: Inputs):
    maps = i.table("part").select("p_partkey", c.features_map(["p_size", "p_retailprice"]).alias("m"))
    return maps.select("p_partkey", F.explode("m").alias("feature", "value"))


@query("to_json", """
SELECT p_partkey, '{"p_name":"' || p_name || '","p_size":' || p_size || '}' AS details FROM part""")
def _(i: Inputs):
    return i.table("part").select("p_partkey", F.to_json(F.struct("p_name", "p_size")).alias("details"))


@query("safe_division", """
SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem""", ["ratio"])
def _(i: Inputs):
    return i.table("lineitem").select(
        "l_orderkey", "l_linenumber", c.safe_div(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio"))
