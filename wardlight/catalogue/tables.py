"""Ingest, stored tables, run log, profiles and data-quality checks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.pipeline import REGION
from wardlight.catalogue.registry import Inputs, query
from wardlight.functions.columns import to_number
from wardlight.operators import aggregates as agg
from wardlight.operators import quality
from wardlight.plans import features, pages, pipeline
from wardlight.sources import adapter, ingest, layers
from wardlight.workspace import stage_path

M = "mart_hospital_performance"
GENERAL = ("provider_id", "hospital_name", "address", "city", "state", "zip_code", "hospital_type",
           "hospital_ownership", "overall_rating")
# Header cells as the published files have them, by kind.
MEASURE_HEADER = {"provider_id": "Facility ID", "measure_id": "Measure ID", "measure_name": "Measure Name", "score": "Score"}
HEADERS = {
    "general": {
        "provider_id": "Facility ID", "hospital_name": "Facility Name", "address": "Address", "city": "CityTown",
        "state": "State", "zip_code": "ZIP Code", "hospital_type": "Hospital Type",
        "hospital_ownership": "Hospital Ownership", "overall_rating": "Hospital overall rating",
    },
    "readmission": MEASURE_HEADER | {"compared_to_national": "Compared to National"},
    "experience": {"provider_id": "Facility ID", "measure_id": "HCAHPS Measure ID", "measure_name": "HCAHPS Question",
                   "score": "HCAHPS Linear Mean Value"},
    "timely": MEASURE_HEADER,
    "county": {"county_fips": "LocationID", "state": "StateAbbr", "measure_id": "MeasureId", "measure": "Measure",
               "data_value": "Data_Value"},
}
# Files of years for which the driver tables have no view hold that of the current year.
VIEW_OF = {t: t if t in adapter.VIEWS else t[:-5] for t in fv.DATASETS}
LOADED_AT = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def _published(i: Inputs, table: str) -> str:
    """A view written as a CSV folder with published header cells."""
    path = stage_path(i.spark, table) + ".csv"
    header = HEADERS[ingest.kind_of(table)]
    layers.export_csv(i.raw(VIEW_OF[table]).select(*[F.col(c).alias(h) for c, h in header.items()]), path)
    return path


def _known(c: str) -> str:
    return f"CASE WHEN {c} NOT IN {o.in_list(fv.NULL_MARKERS)} THEN {c} END"


@query("ingest_csv", f"""
SELECT {', '.join(GENERAL)}, provider_id AS facility_id, city AS citytown FROM raw_hospitals_general""")
def _(i: Inputs):
    df = ingest.load_table(i.spark, "hospitals_general", _published(i, "hospitals_general"), LOADED_AT)
    return df.select(*GENERAL, "facility_id", "citytown")


def _canonical_sql(table: str) -> str:
    """What each canonical column holds: the first published column among its candidates."""
    kind = ingest.kind_of(table)
    header = {ingest.clean_column(h): c for c, h in HEADERS[kind].items()}
    columns = []
    for target, candidates in fv.CANONICAL_COLUMNS[kind].items():
        source = header.get(target) or next((header[c] for c in candidates if c in header), None)
        columns.append(f"{_known(source)} AS {target}" if source else f"CAST(NULL AS VARCHAR) AS {target}")
    return f"SELECT {', '.join(columns)} FROM raw_{table}"


def _register_kinds() -> None:
    for table in ("hospitals_general", "hospitals_readmissions", "hospitals_patient_experience", "hospitals_timely_care", "cdc_places_county"):
        kind = ingest.kind_of(table)

        @query(f"canonical_{kind}", _canonical_sql(table))
        def _(i: Inputs, table=table, kind=kind):
            df = ingest.load_table(i.spark, table, _published(i, table), LOADED_AT)
            return df.select(*fv.CANONICAL_COLUMNS[kind])


_register_kinds()


@query("ingest_lineage", """
SELECT 'orders.parquet' AS source_file, o_orderkey, '2024-01-02 03:04:05' AS loaded_at FROM orders""")
def _(i: Inputs):
    rows = ingest.with_lineage(i.table("orders").select("o_orderkey"), "orders.parquet", LOADED_AT)
    # as text of universal time, whatever the session's zone
    at = F.to_utc_timestamp("loaded_at", F.current_timezone())
    return rows.select("source_file", "o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("loaded_at"))


@query("clean_column_names", """
SELECT l_orderkey AS order_key, l_linenumber AS col_1st_line_no, l_quantity AS qty, l_tax AS qty_2, l_discount AS qty_3
FROM lineitem""", ["qty", "qty_2", "qty_3"])
def _(i: Inputs):
    rows = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    return ingest.clean_columns(rows.toDF(" Order-Key ", "1st Line.No", "QTY", "qty ", "(Qty)"))


@query("canonical_columns", """
SELECT provider_id AS facility_id, measure_id, measure_name, score, compared_to_national, provider_id,
       CAST(NULL AS VARCHAR) AS hospital_name, CAST(NULL AS VARCHAR) AS state FROM raw_hospitals_readmissions""")
def _(i: Inputs):
    raw = i.raw("hospitals_readmissions").withColumnRenamed("provider_id", "facility_id")
    return ingest.canonicalize(raw, "readmission")


@query("add_alias", "SELECT c_custkey, c_name, c_name AS title, 'none' AS note FROM customer")
def _(i: Inputs):
    rows = i.table("customer").select("c_custkey", "c_name")
    return ingest.add_alias(ingest.add_alias(rows, "title", ["c_title", "c_name"]), "note", ["c_note"], "none")


@query("replace_table", "SELECT c_custkey, c_name FROM customer")
def _(i: Inputs):
    root = stage_path(i.spark, "warehouse")
    rows = i.table("customer").select("c_custkey", "c_name")
    layers.write_table(rows.where("c_custkey < 0"), root, "raw", "customer")
    return layers.write_table(rows, root, "raw", "customer")


@query("layered_marts", "SELECT * FROM mart_regional_summary", REGION)
def _(i: Inputs):
    raw = {v: i.raw(v) for v in adapter.VIEWS}
    return pipeline.build_marts(raw, stage_path(i.spark, "warehouse"))["mart_regional_summary"]


COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in adapter.TABLES)


@query("row_counts", COUNTS)
def _(i: Inputs):
    return layers.row_counts({t: i.table(t) for t in adapter.TABLES})


COUNTS_OF_FILES = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{VIEW_OF[t]}" for t in fv.DATASETS)


def _n_columns(table: str) -> int:
    kind = ingest.kind_of(table)
    return len({ingest.clean_column(h) for h in HEADERS[kind].values()} | set(fv.CANONICAL_COLUMNS[kind])) + 2


RAW_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS stored_rows, CAST({_n_columns(t)} AS INTEGER) AS columns, "
    f"'PASS' AS status FROM raw_{VIEW_OF[t]}" for t in fv.DATASETS)


def _registry(i: Inputs) -> dict[str, str]:
    return {t: _published(i, t) for t in fv.DATASETS}


@query("load_all_counts", COUNTS_OF_FILES)
def _(i: Inputs):
    tables = ingest.load_all(i.spark, _registry(i), LOADED_AT)
    return layers.row_counts(tables)


@query("reconcile_counts", RAW_COUNTS)
def _(i: Inputs):
    """Nine files against their nine tables."""
    return layers.load(i.spark, _registry(i), stage_path(i.spark, "warehouse"), LOADED_AT)[1]


@query("run_log", f"""
SELECT 'load_raw' AS pipeline_stage, 'success' AS status, table_name, source_rows, stored_rows, status AS table_status
FROM ({RAW_COUNTS})""")
def _(i: Inputs):
    log = stage_path(i.spark, "runs")
    layers.load_logged(i.spark, _registry(i), stage_path(i.spark, "warehouse"), log, LOADED_AT)
    shape = "array<struct<table_name:string,source_rows:bigint,stored_rows:bigint,columns:int,status:string>>"
    rows = i.spark.read.parquet(log).select("pipeline_stage", "status", F.explode(F.from_json("details", shape)).alias("d"))
    return rows.select("pipeline_stage", "status", "d.table_name", "d.source_rows", "d.stored_rows",
                       F.col("d.status").alias("table_status"))


@query("min_rows_check", f"SELECT 'lineitem' AS name, count(*) AS row_count, count(*) > {fv.FILE_ROW_FLOOR} AS ok FROM lineitem")
def _(i: Inputs):
    return layers.min_rows_check(i.table("lineitem"), fv.FILE_ROW_FLOOR, "lineitem")


PROFILED = adapter.TABLES


@query("schema_context", f"""
SELECT DISTINCT c.table_name, c.column_name, c.data_type, CAST(c.ordinal_position AS INTEGER) AS ordinal_position, n.row_count
FROM information_schema.columns c JOIN ({COUNTS}) n ON c.table_name = n.table_name
WHERE c.table_name IN {o.in_list(PROFILED)}""")
def _(i: Inputs):
    return layers.schema_context({t: i.table(t) for t in PROFILED})


@query("parquet_round_trip", "SELECT * FROM features", o.FEATURE_DOUBLES)
def _(i: Inputs):
    return layers.write_table(i.features, stage_path(i.spark, "warehouse"), "processed", "features")


@query("export_scorecard", f"""
SELECT hospital_name, state, composite_quality_score, quality_tier FROM {M} WHERE composite_quality_score IS NOT NULL""",
       ["composite_quality_score"])
def _(i: Inputs):
    path = stage_path(i.spark, "scorecard") + ".csv"
    layers.export_csv(pages.scorecard(i.performance), path)
    back = ingest.read_raw_csv(i.spark, path)
    return back.select("hospital_name", "state", to_number("composite_quality_score").alias("composite_quality_score"),
                       "quality_tier")


@query("feature_metadata", " UNION ALL ".join(
    f"SELECT {o.q(c)} AS column_name, coalesce(CAST(median({c}) AS DOUBLE), 0) AS median, count(*) AS rows FROM features_raw"
    for c in o.FEATURE_NUMERIC), ["median"])
def _(i: Inputs):
    path = stage_path(i.spark, "metadata")
    features.feature_metadata(i.features, i.medians).write.json(path)
    meta = i.spark.read.schema("medians map<string,double>, rows bigint").json(path)
    return meta.select(F.explode("medians").alias("column_name", "median"), "rows")


# ---- checks ----------------------------------------------------------------

def _check(name: str, value: str, ok: str, source: str) -> str:
    return f"SELECT {o.q(name)} AS name, {ok} AS ok, CAST({value} AS DOUBLE) AS value FROM {source}"


NOT_NULL = "count(*) FILTER (WHERE overall_patient_experience_score IS NULL)"


@query("check_not_null", _check("experience not null", NOT_NULL, f"{NOT_NULL} = 0", M))
def _(i: Inputs):
    return quality.check_not_null(i.performance, "overall_patient_experience_score", "experience not null")


REPEATED = "(SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)"


@query("check_unique", " UNION ALL ".join([
    _check("o_custkey unique", "count(*)", "count(*) = 0", REPEATED),
    _check("c_custkey unique", "count(*)", "count(*) = 0",
           "(SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1)")]))
def _(i: Inputs):
    return quality.run_checks([quality.check_unique(i.table("orders"), "o_custkey"),
                               quality.check_unique(i.table("customer"), "c_custkey")])


@query("check_min_rows", _check("row count > 4000", "count(*)", "count(*) > 4000", "lineitem"))
def _(i: Inputs):
    return quality.check_min_rows(i.table("lineitem"))


NULL_RATE = "avg(CASE WHEN overall_patient_experience_score IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


@query("check_null_rate", _check("overall_patient_experience_score null rate < 20%", NULL_RATE, f"{NULL_RATE} < 0.2", M),
       ["value"])
def _(i: Inputs):
    return quality.check_null_rate(i.performance, "overall_patient_experience_score")


TYPE_SHARE = "(SELECT max(n) / CAST(sum(n) AS DOUBLE) AS v FROM (SELECT count(*) AS n FROM part GROUP BY p_type))"


@query("check_max_share", _check("p_type max category share <= 80%", "v", "v <= 0.8", TYPE_SHARE), ["value"])
def _(i: Inputs):
    return quality.check_max_share(i.table("part"), "p_type")


@query("check_not_empty", _check("events not empty", "least(count(*), 1)", "count(*) > 0", "events"))
def _(i: Inputs):
    return quality.check_not_empty(i.table("events"), "events")


LABEL_SHARE = f"(SELECT max(n) / CAST(sum(n) AS DOUBLE) AS v FROM (SELECT count(*) AS n FROM {M} GROUP BY readmission_risk_label))"


@query("gate_report", " UNION ALL ".join([
    _check("row count > 4000", "count(*)", "count(*) > 4000", M),
    _check("composite_quality_score null rate < 20%",
           "count(*) FILTER (WHERE composite_quality_score IS NULL) / count(*)",
           "count(*) FILTER (WHERE composite_quality_score IS NULL) / count(*) < 0.2", M),
    _check("readmission_risk_label max category share <= 80%", "v", "v <= 0.8", LABEL_SHARE),
    "SELECT 'readmission_classifier exists' AS name, true AS ok, CAST(1 AS DOUBLE) AS value",
    "SELECT 'quality_regressor exists' AS name, true AS ok, CAST(1 AS DOUBLE) AS value"]), ["value"])
def _(i: Inputs):
    return quality.performance_gate(i.performance, models=i.stored_models)


def _key_checks(table: str, key: str, unique: bool) -> list[str]:
    out = [_check(f"{table}.{key} not null", f"count(*) FILTER (WHERE {key} IS NULL)",
                  f"count(*) FILTER (WHERE {key} IS NULL) = 0", table)]
    if unique:
        out.append(_check(f"{table}.{key} unique", "count(*)", "count(*) = 0",
                          f"(SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"))
    return out


SCHEMA_TESTS = (("stg_hospitals", "provider_id", True), ("stg_readmissions", "provider_id", True),
                ("stg_patient_experience", "provider_id", True), ("stg_timely_care", "provider_id", True),
                ("stg_community_health", "state", False), (M, "provider_id", True),
                ("mart_readmission_risk", "provider_id", True), ("mart_regional_summary", "state", True))


@query("schema_tests", " UNION ALL ".join(sql for t in SCHEMA_TESTS for sql in _key_checks(*t)))
def _(i: Inputs):
    return quality.schema_tests({
        "stg_hospitals": i.hospitals, "stg_readmissions": i.readmissions, "stg_patient_experience": i.experience,
        "stg_timely_care": i.timely, "stg_community_health": i.counties, M: i.performance,
        "mart_readmission_risk": i.risk, "mart_regional_summary": i.regions})


# Every column of the performance table.
NULLABLE = """provider_id hospital_name address city state zip_code hospital_type hospital_ownership overall_rating urban_rural
    readm_heart_failure readm_pneumonia readm_hip_knee readm_copd readm_stroke readm_heart_attack avg_readmission_score
    hf_compared_to_national pn_compared_to_national copd_compared_to_national ami_compared_to_national
    overall_patient_experience_score nurse_communication_score doctor_communication_score recommendation_score
    cleanliness_score ed_throughput_score door_to_ct_score sepsis_care_score avg_timely_care_score year
    readmission_performance_score timely_care_score_0_100 composite_quality_score readmission_risk_score diabetes_prevalence
    obesity_prevalence smoking_prevalence poor_mental_health_days no_health_insurance_rate physical_inactivity_rate
    community_health_burden_score burden_tertile risk_context_label readmission_pct_rank quality_pct_rank
    readmission_risk_label quality_tier""".split()


@query("null_counts", " UNION ALL ".join(
    f"SELECT {o.q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {M}" for c in NULLABLE))
def _(i: Inputs):
    return agg.null_counts(i.performance, NULLABLE)
