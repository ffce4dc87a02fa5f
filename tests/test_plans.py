"""Staging, scores and marts on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from tests.test_ranking import plan_of
from wardlight import workspace
from wardlight.catalogue.registry import Inputs
from wardlight.operators import ranking
from wardlight.plans import features, marts, scores, staging

SMALL = "/root/testdata/sf0.001"
FACILITY = ("provider_id string, hospital_name string, address string, city string, state string, zip_code string, "
            "hospital_type string, hospital_ownership string, overall_rating string")
MEASURE = "provider_id string, measure_id string, measure_name string, score string"


def facilities(spark, ids, state=" tx "):
    rows = [(i, f"clinic {i}", "1 Main", "x", state, "123", "acute", "Tribal", "3") for i in ids]
    return spark.createDataFrame(rows, FACILITY)


def test_blank_ids_are_dropped(spark):
    assert [r[0] for r in staging.hospitals(facilities(spark, [" 1 ", "  ", "", None])).select("provider_id").collect()] == ["1"]


def test_a_measure_can_feed_several_columns(spark):
    raw = spark.createDataFrame(
        [("1", "AMI_PN", "x", "2", "Worse"), ("1", "HF", "x", "4", "Better"), ("1", None, "Heart Failure", "6", "No Different"),
         ("1", "HF", "x", "N/A", None)], MEASURE + ", compared_to_national string")
    r = staging.readmissions(raw).first()
    assert (r.readm_heart_attack, r.readm_pneumonia, r.readm_heart_failure, r.avg_readmission_score) == (2.0, 2.0, 5.0, 4.0)
    assert (r.hf_compared_to_national, r.ami_compared_to_national, r.copd_compared_to_national) == ("No Different", "Worse", None)


def test_county_without_id_forms_a_group(spark):
    raw = spark.createDataFrame([("", " tx", "DIABETES_CRUDEPREV", "d", "10"), (None, "TX ", "x_smoking", "d", "20"),
                                 ("7", "  ", "OBESITY", "d", "9")],
                                "county_fips string, state string, measure_id string, measure string, data_value string")
    rows = staging.community_health(raw).collect()
    assert len(rows) == 1
    assert (rows[0].county_fips, rows[0].state, rows[0].diabetes_prevalence, rows[0].smoking_prevalence) == (None, "TX", 10.0, 20.0)
    assert rows[0].community_health_burden_score == pytest.approx(10 * 0.3 + 20 * 0.2)


def build(spark, ids, readm=(), timely=(), counties=()):
    measures = lambda rows, extra=(): spark.createDataFrame(
        [(i, m, m, s, *extra) for i, m, s in rows], MEASURE + (", compared_to_national string" if extra else ""))
    scored = scores.hospital_scores(
        staging.hospitals(facilities(spark, ids)), staging.readmissions(measures(readm, ("Worse",))),
        staging.patient_experience(measures([])), staging.timely_care(measures(timely)))
    county = spark.createDataFrame(list(counties), "county_fips string, state string, measure_id string, measure string, data_value string")
    return scored, scores.community_risk(scored, scores.state_health(staging.community_health(county)))


def test_neutral_scores_without_measures(spark):
    scored, context = build(spark, ["1"])
    r = marts.hospital_performance(context).first()
    assert (r.composite_quality_score, r.readmission_risk_score) == (50.0, 50.0)
    assert (r.readmission_pct_rank, r.readmission_risk_label, r.quality_tier) == (0.0, "Low", "Bottom 10%")
    # one row: first tertile although its burden is unknown
    assert (r.burden_tertile, r.risk_context_label, r.community_health_burden_score) == (1, "Low Burden", None)


def test_equal_readmissions_score_fifty(spark):
    scored, _ = build(spark, ["1", "2", "3"], readm=[("1", "hf", "1.5"), ("2", "hf", "1.5")])
    got = {r.provider_id: r.readmission_performance_score for r in scored.collect()}
    assert got == {"1": 50.0, "2": 50.0, "3": None}


def test_timely_scale_branches(spark):
    scored, _ = build(spark, ["1", "2", "3", "4", "5"], timely=[
        ("1", "ed", "5"), ("2", "ed", "100"), ("3", "ed", "200"), ("4", "ed", "400")])
    got = {r.provider_id: r.timely_care_score_0_100 for r in scored.collect()}
    assert got == {"1": 100.0, "2": 100.0, "3": 50.0, "4": 0.0, "5": None}


def test_unknown_state_sorts_last(spark):
    ids = [str(i) for i in range(1, 8)]
    _, context = build(spark, ids, counties=[("1", "CA", "DIABETES", "d", "10")])
    sizes = [context.where(F.col("burden_tertile") == t).count() for t in (1, 2, 3)]
    assert sizes == [3, 2, 2]


def test_marts_have_no_single_partition_window(spark, monkeypatch):
    """Of all plans on the way to the mart, those of stored steps included."""
    plans = []

    def recorded(df, label="stage", store=workspace.stage):
        plans.append(plan_of(df))
        return store(df, label)
    for module in (ranking, scores):
        monkeypatch.setattr(module, "stage", recorded)
    plans.append(plan_of(Inputs(spark, SMALL).build_performance()))
    windows = [line for plan in plans for line in plan.splitlines() if "Window [" in line]
    assert windows
    for plan in plans:
        # the only single-partition exchanges are those of one-row aggregates: counts, minimum and maximum
        assert "Window [" not in plan or "SinglePartition" not in plan
    # every window is keyed: by the slice, or over the totals of slices by the column ranked
    assert all("_slice" in line or "column" in line for line in windows)


def test_properties_of_the_mart(spark):
    i = Inputs(spark, SMALL)
    perf = i.performance
    low, high = perf.agg(F.min("readmission_pct_rank"), F.max("quality_pct_rank")).first()
    assert 0.0 <= low and high <= 1.0
    assert perf.where(~F.col("composite_quality_score").between(0, 100)).count() == 0
    tiles = [r["count"] for r in perf.groupBy("burden_tertile").count().collect()]
    assert len(tiles) == 3 and max(tiles) - min(tiles) <= 1
    assert i.regions.agg(F.sum("hospital_count")).first()[0] == perf.count()


def test_performance_schema(spark):
    want = {"provider_id", "hospital_name", "address", "city", "state", "zip_code", "hospital_type", "hospital_ownership",
            "overall_rating", "urban_rural", "year", "burden_tertile", "risk_context_label", "readmission_pct_rank",
            "quality_pct_rank", "readmission_risk_label", "quality_tier"}
    got = Inputs(spark, SMALL).performance.columns
    assert want <= set(got) and len(got) == 48 and len(Inputs(spark, SMALL).risk.columns) == 20


def test_features_have_no_gaps(spark):
    matrix, medians = features.feature_matrix(Inputs(spark, SMALL).performance)
    numeric = features.numeric_features(matrix)
    assert set(medians) == set(numeric)
    gaps = matrix.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in numeric]).first()
    assert sum(gaps) == 0
