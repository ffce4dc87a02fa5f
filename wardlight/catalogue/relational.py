"""Filters, joins, aggregates, ranks and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.pipeline import PERFORMANCE, READM, REGION, RISK, COMMUNITY
from wardlight.catalogue.registry import Inputs, query
from wardlight.functions import columns as c
from wardlight.functions import exact
from wardlight.operators import aggregates as agg
from wardlight.operators import filters, joins, ordering, ranking
from wardlight.plans import marts, scores, staging
from wardlight.workspace import stage

M = "mart_hospital_performance"
FIND = ", ".join(fv.LIST_COLUMNS)
FIND_D = ("composite_quality_score", "readmission_risk_score", "overall_patient_experience_score",
          "community_health_burden_score")
BEST = "ORDER BY composite_quality_score DESC NULLS LAST, provider_id"


# ---- filters ---------------------------------------------------------------

@query("require_key", "SELECT provider_id, zip_code FROM raw_hospitals_general WHERE trim(provider_id) <> ''")
def _(i: Inputs):
    return staging.require_key(i.raw("hospitals_general"), "provider_id").select("provider_id", "zip_code")


@query("find_facilities", f"""SELECT {FIND} FROM {M} WHERE state = 'NATION_6' AND readmission_risk_label = 'High'
  AND composite_quality_score >= 30 {BEST} LIMIT 1000""", FIND_D)
def _(i: Inputs):
    return filters.find(i.performance, state="nation_6", risk_level="high", quality_min=30.0, limit=1000)


@query("find_by_risk", f"SELECT {FIND} FROM {M} WHERE readmission_risk_label = 'High' {BEST} LIMIT 100", FIND_D)
def _(i: Inputs):
    return filters.find_by_risk(i.performance)


@query("facility_profile", f"SELECT * FROM {M} WHERE provider_id = '000000000042'", PERFORMANCE)
def _(i: Inputs):
    return filters.profile(i.performance, "provider_id", "000000000042")


@query("filter_lists", "SELECT * FROM part WHERE p_type IN ('PROMO', 'SMALL') AND p_size IN (1, 7, 20)",
       ["p_retailprice"])
def _(i: Inputs):
    return i.table("part").where(c.filter_in(p_type=["PROMO", "SMALL"], p_size=[1, 7, 20], p_brand=[]))


@query("filter_between", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount BETWEEN 0.02 AND 0.05")
def _(i: Inputs):
    return filters.filter_between(i.table("lineitem"), "l_discount", 0.02, 0.05).select("l_orderkey", "l_linenumber")


@query("search_like", """
SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%r#0%1_%' OR c_mktsegment ILIKE '%r#0%1_%'""")
def _(i: Inputs):
    return i.table("customer").where(c.search_like(["c_name", "c_mktsegment"], "r#0%1_")).select("c_custkey", "c_name")


@query("search_regex", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(coalesce(p_name, '')), '1[05]|pro')
   OR regexp_matches(lower(coalesce(p_brand, '')), '1[05]|pro') OR regexp_matches(lower(coalesce(p_type, '')), '1[05]|pro')""")
def _(i: Inputs):
    return i.table("part").where(c.search_regex(["p_name", "p_brand", "p_type"], "1[05]|PRO")).select("p_partkey", "p_name")


@query("any_like", f"""
SELECT provider_id, measure_id FROM raw_hospitals_readmissions
WHERE {o.has('lower(measure_id)', ['ami', 'heart attack'])}""")
def _(i: Inputs):
    return i.raw("hospitals_readmissions").where(
        c.any_like(F.lower("measure_id"), fv.READMISSION_MEASURES["readm_heart_attack"])).select("provider_id", "measure_id")


@query("in_or_like", """
SELECT state, count(*) AS n FROM raw_cdc_places_county
WHERE lower(measure_id) IN ('csmoking', 'csmoking_crudeprev', 'csmoking_adjprev') OR lower(measure_id) LIKE '%smok%'
GROUP BY state""")
def _(i: Inputs):
    ids, word = fv.COMMUNITY_MEASURES["smoking_prevalence"]
    hit = c.in_or_like(F.lower("measure_id"), ids, [word])
    return i.raw("cdc_places_county").where(hit).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("drop_unknown", f"""
SELECT provider_id, overall_patient_experience_score AS e, community_health_burden_score AS b FROM {M}
WHERE overall_patient_experience_score IS NOT NULL AND community_health_burden_score IS NOT NULL""", ["e", "b"])
def _(i: Inputs):
    known = i.performance.dropna(subset=["overall_patient_experience_score", "community_health_burden_score"])
    return known.select("provider_id", F.col("overall_patient_experience_score").alias("e"),
                        F.col("community_health_burden_score").alias("b"))


@query("equal_ignoring_case", """
SELECT zip_code FROM raw_hospitals_general WHERE lower(coalesce(hospital_type, '')) = 'psychiatric'""")
def _(i: Inputs):
    return i.raw("hospitals_general").where(c.eq_ci("hospital_type", "PSYCHIATRIC")).select("zip_code")


@query("compare_facilities", f"""SELECT {FIND} FROM {M}
WHERE provider_id IN ('000000000005', '000000000017', '000000000101')""", FIND_D)
def _(i: Inputs):
    return filters.compare(i.performance, "provider_id", ["000000000005", "000000000017", "000000000101"]).select(
        *fv.LIST_COLUMNS)


@query("high_burden_high_quality", f"""
SELECT provider_id, hospital_name, city, state, composite_quality_score, community_health_burden_score, risk_context_label
FROM {M} WHERE risk_context_label = 'High Burden' AND composite_quality_score > 55""",
       ["composite_quality_score", "community_health_burden_score"])
def _(i: Inputs):
    return filters.high_burden_high_quality(i.performance, above=55.0, limit=None)


# ---- joins -----------------------------------------------------------------

@query("left_join_chain", "SELECT * FROM wide",
       (*READM, "overall_patient_experience_score", *fv.EXPERIENCE_MEASURES, *fv.TIMELY_MEASURES, "avg_timely_care_score"))
def _(i: Inputs):
    return joins.left_join_chain(i.hospitals, [i.readmissions, i.experience, i.timely], "provider_id")


@query("join_state_dimension", f"""
SELECT h.provider_id, h.state, {', '.join('d.' + x for x in COMMUNITY)} FROM stg_hospitals h
LEFT JOIN state_health d ON h.state = d.state""", COMMUNITY)
def _(i: Inputs):
    dim = agg.rollup_mean(i.counties, "state", scores.COMMUNITY_COLUMNS)
    return joins.join_dim(i.hospitals.select("provider_id", "state"), dim, "state")


@query("readmission_rejoin", "SELECT * FROM mart_readmission_risk", RISK)
def _(i: Inputs):
    return marts.readmission_risk(i.performance, i.readmissions)


@query("share_of_total", """
SELECT p_type, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM part) AS share FROM part GROUP BY p_type""",
       ["share"])
def _(i: Inputs):
    return joins.share_of_total(i.table("part"), "p_type")


@query("performance_with_risk", f"""
SELECT p.provider_id, p.state, p.quality_tier, r.state_readmission_rank FROM {M} p
LEFT JOIN mart_readmission_risk r ON p.provider_id = r.provider_id""")
def _(i: Inputs):
    return joins.performance_with_risk(i.performance, i.risk).select(
        "provider_id", "state", "quality_tier", "state_readmission_rank")


@query("performance_with_region", f"""
SELECT p.provider_id, p.state, r.hospital_count AS region_hospital_count, r.avg_quality_score AS region_avg_quality_score,
       r.top_performing_hospital AS region_top_performing_hospital
FROM {M} p LEFT JOIN mart_regional_summary r ON p.state = r.state""", ["region_avg_quality_score"])
def _(i: Inputs):
    return joins.performance_with_region(i.performance, i.regions).select(
        "provider_id", "state", "region_hospital_count", "region_avg_quality_score", "region_top_performing_hospital")


# ---- aggregates ------------------------------------------------------------

@query("conditional_pivot", f"""
SELECT l_returnflag, {o.mean('CASE WHEN l_linenumber <= 3 THEN q END')} AS first_lines,
       {o.mean('CASE WHEN l_linenumber >= 3 THEN q END')} AS later_lines, {o.mean('q')} AS all_lines,
       max(CASE WHEN l_linenumber = 1 THEN l_linestatus END) AS last_status
FROM (SELECT *, CAST(l_quantity AS DECIMAL(18,6)) AS q FROM lineitem) GROUP BY l_returnflag""",
       ["first_lines", "later_lines", "all_lines"])
def _(i: Inputs):
    line = F.col("l_linenumber")
    return agg.pivot(i.table("lineitem"), ["l_returnflag"], "l_quantity", {"first_lines": line <= 3, "later_lines": line >= 3, "all_lines": None},
                     text="l_linestatus", text_max={"last_status": line == 1})


@query("rollup_mean", "SELECT * FROM state_health", COMMUNITY)
def _(i: Inputs):
    return agg.rollup_mean(i.counties, "state", scores.COMMUNITY_COLUMNS)


@query("group_summary", "SELECT * FROM mart_regional_summary", REGION)
def _(i: Inputs):
    return agg.regional_summary(i.performance)


@query("top_name_per_group", """
SELECT p_type, max(CASE WHEN place = 1 THEN p_name END) AS dearest
FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS place FROM part)
GROUP BY p_type""")
def _(i: Inputs):
    return i.table("part").groupBy("p_type").agg(agg.top_name("p_name", "p_retailprice", "p_partkey").alias("dearest"))


KPI_SQL = f"""
SELECT count(*) AS hospitals, {o.dmean('composite_quality_score')} AS avg_quality,
       {o.dmean('readmission_risk_score')} AS avg_risk,
       {o.dmean('overall_patient_experience_score')} AS avg_patient_experience,
       100.0::DOUBLE * count(*) FILTER (WHERE readmission_risk_label = 'High') / count(*) AS high_risk_pct FROM {M}"""
KPI_D = ("avg_quality", "avg_risk", "avg_patient_experience", "high_risk_pct")


@query("kpis", KPI_SQL, KPI_D)
def _(i: Inputs):
    return agg.kpis(i.performance)


@query("performance_kpis", f"""
SELECT count(*) AS hospitals, {o.dmean('composite_quality_score')} AS avg_quality,
       {o.dmean('readmission_risk_score')} AS avg_risk,
       count(*) FILTER (WHERE lower(readmission_risk_label) = 'high') AS high_risk_hospitals FROM {M}""",
       ["avg_quality", "avg_risk"])
def _(i: Inputs):
    return agg.performance_kpis(i.performance)


@query("ordered_counts", """
SELECT o_orderpriority, count(*) AS n,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 4 END AS INTEGER) AS place
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY o_orderpriority""")
def _(i: Inputs):
    return agg.ordered_counts(i.table("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "absent", "5-LOW"])


@query("mix_by_type", f"""
SELECT hospital_type, count(provider_id) AS hospitals, {o.dmean('composite_quality_score')} AS avg_quality,
       {o.dmean('readmission_risk_score')} AS avg_risk FROM {M} GROUP BY hospital_type
ORDER BY hospitals DESC, hospital_type NULLS LAST LIMIT 15""", ["avg_quality", "avg_risk"])
def _(i: Inputs):
    return agg.mix_by(i.performance, "hospital_type")


@query("risk_by_state", f"""
SELECT state, {o.dmean('readmission_risk_score')} AS avg_readmission_risk_score, count(provider_id) AS hospital_count
FROM {M} WHERE state IS NOT NULL GROUP BY state""", ["avg_readmission_risk_score"])
def _(i: Inputs):
    return agg.by_state(i.performance)


@query("ranked_groups", f"""
SELECT county_fips, {o.dmean('community_health_burden_score')} AS community_health_burden_score FROM stg_community_health
WHERE county_fips IS NOT NULL GROUP BY county_fips
ORDER BY community_health_burden_score DESC NULLS LAST, county_fips LIMIT 25""", ["community_health_burden_score"])
def _(i: Inputs):
    return agg.rank_groups(i.counties, "county_fips", "community_health_burden_score", 25)


@query("average_by_group", f"""
SELECT p_brand, {o.dmean('p_retailprice')} AS avg_price, count(*) AS parts FROM part GROUP BY p_brand
ORDER BY avg_price DESC NULLS LAST, p_brand LIMIT 10""", ["avg_price"])
def _(i: Inputs):
    return agg.avg_by(i.table("part"), "p_brand", "p_retailprice", "avg_price", 10, "parts")


@query("null_rate", f"""
SELECT avg(CASE WHEN overall_patient_experience_score IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_rate FROM {M}""",
       ["null_rate"])
def _(i: Inputs):
    return agg.null_rate(i.performance, "overall_patient_experience_score")


@query("max_share", """
SELECT max(n) / CAST(sum(n) AS DOUBLE) AS max_share FROM (SELECT count(*) AS n FROM part GROUP BY p_type)""", ["max_share"])
def _(i: Inputs):
    return agg.max_share(i.table("part"), "p_type")


LINE_PAIRS = (("l_quantity", "l_extendedprice", "quantity and price"), ("l_discount", "l_tax", "discount and tax"),
              ("l_quantity", "l_tax", "quantity and tax"))
CORR_SQL = " UNION ALL ".join(f"SELECT {o.q(t)} AS title, corr({x}, {y}) AS r FROM lineitem" for x, y, t in LINE_PAIRS)


@query("correlations", CORR_SQL, ["r"])
def _(i: Inputs):
    return agg.correlations(i.table("lineitem"), LINE_PAIRS)


@query("strongest_correlation", f"SELECT * FROM ({CORR_SQL}) ORDER BY abs(r) DESC NULLS LAST, title LIMIT 1", ["r"])
def _(i: Inputs):
    return agg.strongest(agg.correlations(i.table("lineitem"), LINE_PAIRS))


@query("ols_by_category", """
SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
       regr_r2(l_extendedprice, l_quantity) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem GROUP BY l_returnflag""", ["slope", "intercept", "r2"])
def _(i: Inputs):
    return agg.ols_by(i.table("lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")


def histogram_sql(source: str, x: str, bins: int) -> str:
    return f"""
SELECT bin, lo + bin * w AS low, lo + (bin + 1) * w AS high, count(*) AS n
FROM (SELECT CAST(CASE WHEN w > 0 THEN least(floor((x - lo) / w), {bins - 1}) ELSE 0 END AS INTEGER) AS bin, lo, w
      FROM (SELECT {x} AS x, min({x}) OVER () AS lo, (max({x}) OVER () - min({x}) OVER ()) / {bins}.0::DOUBLE AS w
            FROM {source} WHERE {x} IS NOT NULL)) GROUP BY bin, lo, w"""


@query("histogram", histogram_sql("lineitem", "l_extendedprice", 34), ["low", "high"])
def _(i: Inputs):
    return agg.histogram(i.table("lineitem"), "l_extendedprice", 34)


def box_sql(source: str, x: str) -> str:
    parts = ", ".join(f"quantile_cont({x}, {p}) AS {n}" for n, p in
                      (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1)))
    return f"SELECT {parts} FROM {source}"


BOX_D = ("min", "q1", "median", "q3", "max")


@query("box_summary", box_sql("lineitem", "l_extendedprice"), BOX_D)
def _(i: Inputs):
    return agg.box_stats(i.table("lineitem"), "l_extendedprice")


# Every numeric column of the performance table.
MEDIAN_COLS = """overall_rating readm_heart_failure readm_pneumonia readm_hip_knee readm_copd readm_stroke readm_heart_attack
    avg_readmission_score overall_patient_experience_score nurse_communication_score doctor_communication_score
    recommendation_score cleanliness_score ed_throughput_score door_to_ct_score sepsis_care_score avg_timely_care_score year
    readmission_performance_score timely_care_score_0_100 composite_quality_score readmission_risk_score diabetes_prevalence
    obesity_prevalence smoking_prevalence poor_mental_health_days no_health_insurance_rate physical_inactivity_rate
    community_health_burden_score burden_tertile readmission_pct_rank quality_pct_rank""".split()


@query("medians", " UNION ALL ".join(
    f"SELECT {o.q(x)} AS column_name, coalesce(CAST(median({x}) AS DOUBLE), 0) AS median FROM {M}" for x in MEDIAN_COLS),
       ["median"])
def _(i: Inputs):
    numeric = [f.name for f in i.performance.schema.fields if isinstance(f.dataType, NumericType)]
    return agg.medians(i.performance, numeric)


@query("bounds", "SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem", ["low", "high"])
def _(i: Inputs):
    return agg.bounds(i.table("lineitem"), "l_extendedprice")


@query("mean_absolute", """
SELECT * FROM (SELECT 'p_size' AS feature, avg(abs(CAST(p_size AS DOUBLE))) AS importance FROM part
UNION ALL SELECT 'p_retailprice', avg(abs(p_retailprice)) FROM part
UNION ALL SELECT 'p_partkey', avg(abs(CAST(p_partkey AS DOUBLE))) FROM part)
ORDER BY importance DESC NULLS LAST, feature LIMIT 10""", ["importance"])
def _(i: Inputs):
    return agg.mean_abs(i.table("part"), ["p_size", "p_retailprice", "p_partkey"])


# ---- ranks -----------------------------------------------------------------

@query("global_aggregates", """
SELECT provider_id, avg_readmission_score AS score, min(avg_readmission_score) OVER () AS low,
       max(avg_readmission_score) OVER () AS high FROM stg_readmissions""", ["score", "low", "high"])
def _(i: Inputs):
    rows = stage(i.readmissions.select("provider_id", F.col("avg_readmission_score").alias("score")), "readmissions")
    return joins.with_global(rows, low=F.min("score"), high=F.max("score"))


@query("global_percent_rank", """
SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity,
       percent_rank() OVER (ORDER BY l_quantity NULLS LAST) AS quantity_rank FROM lineitem""", ["quantity_rank"])
def _(i: Inputs):
    rows = i.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_quantity")
    return ranking.percent_rank(rows, "l_quantity", "id", "quantity_rank")


@query("global_ntile", f"""
SELECT provider_id, overall_patient_experience_score AS experience,
       CAST(ntile(4) OVER (ORDER BY overall_patient_experience_score NULLS LAST, provider_id) AS INTEGER) AS quarter FROM {M}""",
       ["experience"])
def _(i: Inputs):
    rows = i.performance.select("provider_id", F.col("overall_patient_experience_score").alias("experience"))
    return ranking.ntile(rows, 4, "experience", "provider_id", "quarter")


@query("rank_in_state", f"""
SELECT provider_id, state, rank() OVER (PARTITION BY state ORDER BY overall_patient_experience_score DESC NULLS LAST) AS place
FROM {M}""")
def _(i: Inputs):
    return ranking.rank_in(i.performance, ["state"], "overall_patient_experience_score", "provider_id", "place").select(
        "provider_id", "state", "place")


@query("rank_with_repeated_ids", """
SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount DESC NULLS LAST) AS place,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity NULLS LAST, l_orderkey * 100000 + l_linenumber * 1000 + CAST(round(l_discount * 100) AS BIGINT)) AS number
FROM lineitem""")
def _(i: Inputs):
    """The rank's key repeats: an order has several lines."""
    rows = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_discount", "l_quantity",
                                      (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 1000
                                       + F.round(F.col("l_discount") * 100).cast("bigint")).alias("line"))
    ranked = ranking.rank_in(rows, ["l_returnflag"], "l_discount", "l_orderkey", "place")
    return ranking.row_number_in(ranked, ["l_returnflag"], "l_quantity", "line", "number", ascending=True).select(
        "l_orderkey", "l_linenumber", "place", "number")


@query("mean_of_any_size", """
SELECT l_returnflag, CAST(round(sum(CAST(l_quantity AS DECIMAL(18,2))) * 1000000 / count(l_quantity), 0) AS BIGINT) AS tiny_in_quadrillionths,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 1000000 / count(l_extendedprice), 0) AS BIGINT) AS huge_in_thousands
FROM lineitem GROUP BY l_returnflag""")
def _(i: Inputs):
    """Values of about 1e-8 and of about 1e14."""
    means = i.table("lineitem").groupBy("l_returnflag").agg(
        exact.mean(F.col("l_quantity") / F.lit(1e9)).alias("tiny"), exact.mean(F.col("l_extendedprice") * F.lit(1e9)).alias("huge"))
    return means.select("l_returnflag", F.rint(F.col("tiny") * F.lit(1e15)).cast("bigint").alias("tiny_in_quadrillionths"),
                        F.rint(F.col("huge") / F.lit(1e3)).cast("bigint").alias("huge_in_thousands"))


@query("row_numbers_in_state", f"""
SELECT provider_id, row_number() OVER (PARTITION BY state ORDER BY composite_quality_score DESC NULLS LAST, provider_id)
         AS best_rank,
       row_number() OVER (PARTITION BY state ORDER BY readmission_risk_score DESC NULLS LAST, provider_id) AS risk_rank
FROM {M}""")
def _(i: Inputs):
    rows = i.performance.select("provider_id", "state", "composite_quality_score", "readmission_risk_score")
    best = ranking.row_number_in(rows, ["state"], "composite_quality_score", "provider_id", "best_rank")
    both = ranking.row_number_in(best, ["state"], "readmission_risk_score", "provider_id", "risk_rank")
    return both.select("provider_id", "best_rank", "risk_rank")


@query("group_mean", f"""
SELECT provider_id, {o.dmean_over('composite_quality_score', 'state')} AS state_mean FROM {M} WHERE state IS NOT NULL
UNION ALL SELECT provider_id, NULL FROM {M} WHERE state IS NULL""", ["state_mean"])
def _(i: Inputs):
    return joins.group_mean(i.performance.select("provider_id", "state", "composite_quality_score"),
                            "state", "composite_quality_score", "state_mean").select("provider_id", "state_mean")


@query("average_percentile_in_state", f"""
SELECT provider_id, CASE WHEN x IS NOT NULL THEN (rank() OVER (PARTITION BY state, x IS NULL ORDER BY x)
         + (count(*) OVER (PARTITION BY state, x) - 1) / 2.0::DOUBLE) / count(x) OVER (PARTITION BY state) * 100 END AS pct
FROM (SELECT provider_id, state, overall_patient_experience_score AS x FROM {M})""", ["pct"])
def _(i: Inputs):
    rows = i.performance.select("provider_id", "state", F.col("overall_patient_experience_score").alias("x"))
    return ranking.average_percentile_in(rows, ["state"], "x", "provider_id", "pct").select("provider_id", "pct")


# ---- orderings -------------------------------------------------------------

@query("top_n", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 50",
       ["c_acctbal"])
def _(i: Inputs):
    return ordering.top_n(i.table("customer").select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", 50, "c_custkey")


@query("sort_descending", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC NULLS LAST, s_suppkey",
       ["s_acctbal"])
def _(i: Inputs):
    return ordering.sort_desc(i.table("supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", "s_suppkey")


LEADERS = ", ".join(fv.BEST_COLUMNS)
RISKIEST = ", ".join(fv.RISKIEST_COLUMNS)


@query("leaderboard_best", f"SELECT {LEADERS} FROM {M} WHERE composite_quality_score IS NOT NULL {BEST} LIMIT 15",
       ["composite_quality_score"])
def _(i: Inputs):
    return ordering.leaderboards(i.performance)[0]


@query("leaderboard_riskiest", f"""SELECT {RISKIEST} FROM {M} WHERE readmission_risk_score IS NOT NULL
ORDER BY readmission_risk_score DESC NULLS LAST, provider_id LIMIT 15""",
       ["composite_quality_score", "readmission_risk_score"])
def _(i: Inputs):
    return ordering.leaderboards(i.performance)[1]


@query("best_states", "SELECT * FROM mart_regional_summary ORDER BY avg_quality_score DESC NULLS LAST, state LIMIT 10", REGION)
def _(i: Inputs):
    return ordering.best_states(i.regions)


@query("riskiest_states",
       "SELECT * FROM mart_regional_summary ORDER BY avg_readmission_risk DESC NULLS LAST, state LIMIT 10", REGION)
def _(i: Inputs):
    return ordering.riskiest_states(i.regions)


@query("leaderboard_300", """
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 300""", ["c_acctbal"])
def _(i: Inputs):
    return ordering.top_n(i.table("customer").select("c_custkey", "c_acctbal"), "c_acctbal", 300, "c_custkey")


DRIVER_COLS = ("p_size", "p_retailprice", "p_partkey")
UNPIVOT = " UNION ALL ".join(
    f"SELECT p_partkey AS id, p_brand, {n} AS i, {o.q(x)} AS feature, CAST({x} AS DOUBLE) AS v FROM part"
    for n, x in enumerate(DRIVER_COLS))
PLACED = f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(v) DESC, i) AS place FROM ({UNPIVOT})"


@query("top_drivers", f"""
SELECT id AS p_partkey, CAST(place AS INTEGER) AS place, feature, v AS contribution FROM ({PLACED}) WHERE place <= 2""",
       ["contribution"])
def _(i: Inputs):
    top = ordering.top_drivers(i.table("part"), DRIVER_COLS, 2, ["p_partkey"])
    return top.select("p_partkey", F.posexplode("drivers").alias("place", "d")).select(
        "p_partkey", (F.col("place") + 1).alias("place"), "d.feature", "d.contribution")


@query("distinct_values", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY p_brand")
def _(i: Inputs):
    return ordering.distinct_values(i.table("part"), "p_brand")


@query("sample_values", """
(SELECT 'p_type' AS column_name, p_type AS value FROM (SELECT DISTINCT p_type FROM part) ORDER BY value LIMIT 10)
UNION ALL (SELECT 'p_brand', p_brand FROM (SELECT DISTINCT p_brand FROM part) ORDER BY p_brand LIMIT 60)""")
def _(i: Inputs):
    return ordering.sample_values(i.table("part"), {"p_type": 10, "p_brand": 60})


@query("sort_by_name", "SELECT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey")
def _(i: Inputs):
    return ordering.by_name(i.table("customer").select("c_custkey", "c_name"), "c_name", "c_custkey")


TREND = ("quality_score", "readmission_risk_score", "national_avg_quality_score", "national_avg_readmission_risk_score")


@query("facility_trend", "SELECT * FROM trend WHERE provider_id = '000000000042' ORDER BY year", TREND)
def _(i: Inputs):
    history = {y: i.raw(f"hospitals_general_{y}") for y in (2021, 2022)}
    return ordering.trend(i.performance, history, fv.CURRENT_YEAR, "000000000042")


IMPROVEMENT_SQL = """
SELECT b.provider_id, b.hospital_name, a.quality_score AS first_score, b.quality_score AS last_score,
       b.quality_score - a.quality_score AS improvement
FROM trend a JOIN trend b ON a.provider_id = b.provider_id AND a.year = 2021 AND b.year = 2023
WHERE a.quality_score IS NOT NULL AND b.quality_score IS NOT NULL
ORDER BY improvement DESC, b.provider_id LIMIT 10"""
IMPROVEMENT_D = ("first_score", "last_score", "improvement")


@query("most_improved", IMPROVEMENT_SQL, IMPROVEMENT_D)
def _(i: Inputs):
    history = {y: i.raw(f"hospitals_general_{y}") for y in (2021, 2022)}
    return ordering.improvement(ordering.trend(i.performance, history, fv.CURRENT_YEAR), 2021, 2023)


@query("reproducible_sample", f"""
SELECT id, l_extendedprice FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_extendedprice FROM lineitem)
ORDER BY {o.seeded_hash('id', fv.SEED)}, id LIMIT {fv.EXPLAIN_ROWS}""")
def _(i: Inputs):
    rows = i.table("lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return ordering.sample_n(rows, fv.EXPLAIN_ROWS, fv.SEED, "id").select("id", "l_extendedprice")
