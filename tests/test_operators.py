"""Aggregates, filters and orderings beyond what the SQL comparison covers."""

import pytest
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.operators import aggregates as agg
from wardlight.operators import filters, joins, ordering


def test_top_name_ties_and_nulls(spark):
    df = spark.createDataFrame([("g", "b", 5.0, "2"), ("g", "a", 5.0, "1"), ("g", "c", None, "0"), ("h", "d", None, "9")],
                               "g string, name string, score double, id string")
    got = {r.g: r.top for r in df.groupBy("g").agg(agg.top_name("name", "score", "id").alias("top")).collect()}
    assert got == {"g": "a", "h": "d"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (5.0,), (None,), (9.99,)], "x double")
    got = {r.bin: r.n for r in agg.histogram(df, "x", 10).collect()}
    assert got == {0: 1, 5: 1, 9: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r.bin, r.n) for r in agg.histogram(same, "x", 5).collect()] == [(0, 2)]


def test_correlation_without_data_is_null(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "x double, y double")
    assert agg.correlations(df, [("x", "y", "t")]).first().r is None
    known = spark.createDataFrame([("a", None), ("b", -0.9), ("c", 0.5)], "title string, r double")
    assert agg.strongest(known).first().title == "b"


def test_medians_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None)], "x double, y double")
    assert {r.column_name: r.median for r in agg.medians(df, ["x", "y"]).collect()} == {"x": 2.5, "y": 0.0}


def test_group_mean_without_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0)], "g string, x double")
    assert sorted((str(r.g), r.m) for r in joins.group_mean(df, "g", "x", "m").collect()) == [("None", None), ("a", 2.0), ("a", 2.0)]


def test_limits_are_checked(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in fv.LIST_COLUMNS))
    with pytest.raises(ValueError):
        filters.find(df, limit=1001)
    with pytest.raises(ValueError):
        filters.find_by_risk(df, "Extreme")
    with pytest.raises(ValueError):
        filters.compare(df, "provider_id", ["1", "2", "3", "4"])


def test_mean_over_a_frequent_key(spark):
    """A third of the rows in one group: same result as grouping without it."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.lit(1.5).alias("x"))
    got = agg.rollup_mean(df, "g", ["x"])
    assert got.count() == 6001 and got.where("x <> 1.5").count() == 0


def test_trend_of_one_facility(spark):
    mart = spark.createDataFrame([("1", "a", 40.0, 60.0), ("2", "b", 60.0, 40.0)],
                                 "provider_id string, hospital_name string, composite_quality_score double, readmission_risk_score double")
    past = spark.createDataFrame([(" 1", "A", "2"), ("2", "B", "N/A")], "provider_id string, hospital_name string, overall_rating string")
    rows = ordering.trend(mart, {2022: past, 2021: past}, 2023, "1").collect()
    assert [(r.year, r.quality_score, r.national_avg_quality_score) for r in rows] == [
        (2021, 40.0, None), (2022, 40.0, None), (2023, 40.0, 50.0)]
    gains = ordering.improvement(ordering.trend(mart, {2021: past}, 2023), 2021, 2023).collect()
    assert [(r.provider_id, r.improvement) for r in gains] == [("1", 0.0)]


def test_approximate_quantiles(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    got = agg.box_stats(df, "x", accuracy=10_000).first()
    assert [got["min"], got["max"]] == [0.0, 10_000.0] and abs(got["median"] - 5000) <= 2 and abs(got["q1"] - 2500) <= 2
    assert {r.column_name: abs(r.median - 5000) <= 2 or r.median for r in agg.medians(df, ["x", "y"], 10_000).collect()} == {
        "x": True, "y": 0.0}


def test_a_pivot_takes_each_value_apart_once(spark):
    rows = spark.createDataFrame([("a", "x1", 1.5), ("a", "x2", 2.0 ** 95), ("a", "y", None), ("b", "y", -7.25), ("b", "x1", 0.1)],
                                 "k string, m string, v double")
    picked = {"x": F.col("m").startswith("x"), "y": F.col("m") == "y", "all": None}
    out = agg.pivot(rows, ["k"], "v", picked, text="m", text_max={"last": F.col("v") > 0})
    assert {r.k: tuple(r)[1:] for r in out.collect()} == {"a": ((2.0 ** 95 + 1.5) / 2, None, (2.0 ** 95 + 1.5) / 2, "x2"),
                                                           "b": (0.1, -7.25, -3.575, "x1")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("FLOOR(") == 5


def test_pivot_hashes_and_keeps_the_largest_text(spark):
    """The largest text of a key and condition, without sorting all rows by key; NULL texts and keys without any included."""
    rows = [("a", "hf", 1.5, "Worse"), ("a", "hf", None, "b"), ("a", "pn", 2.5, None), (None, "hf", 4.0, "été"), (None, "hf", 5.0, "zz"),
            ("b", "hf pn", 3.0, ""), ("b", "pn", 5.0, "No Different"), ("b", "pn", 7.0, "No"), ("c", None, 1.0, "x"), ("d", "other", 2.0, "x")]
    df = spark.createDataFrame(rows, "k string, m string, x double, t string").repartition(5)
    has = lambda w: F.contains("m", F.lit(w))
    got = agg.pivot(df, ["k"], "x", {"all": None, "hf": has("hf")}, text="t", text_max={"hf_text": has("hf"), "pn_text": has("pn")})
    assert got.columns == ["k", "all", "hf", "hf_text", "pn_text"]
    assert {tuple(r) for r in got.collect()} == {("a", 2.0, 1.5, "b", None), (None, 4.5, 4.5, "été", None), ("b", 5.0, 3.0, "", "No Different"),
                                                 ("c", 1.0, None, None, None), ("d", 2.0, None, None, None)}
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert agg.pivot(df.limit(0), ["k"], "x", {"all": None}, text="t", text_max={"t": has("hf")}).count() == 0
