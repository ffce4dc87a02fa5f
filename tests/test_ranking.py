"""Distributed ranks against the built-in windows, with ties, NULLs and frequent values."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardlight.operators import ranking


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows share one value, one group holds most rows, some values and groups are NULL."""
    n = 3000
    x = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 2 == 0, 50.0).otherwise((F.col("id") * 37 % 400) / 4.0)
    g = F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 3 > 0, "big").otherwise((F.col("id") % 5).cast("string"))
    df = spark.range(n).select(F.format_string("k%05d", "id").alias("key"), g.alias("g"), x.alias("x"))
    return df.repartition(6).cache()


def same(df, got, want):
    wrong = df.where(~F.col(got).eqNullSafe(F.col(want)))
    assert wrong.count() == 0, wrong.limit(5).collect()
    assert df.count() == 3000


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, spark):
    """Spark brings positions back to the rows by either join; the rows must not depend on it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_and_null_ids(spark, way):
    data = [("a", "x", 1.0), ("a", "x", 2.0), (None, "x", 2.0), ("b", "x", None), ("b", "x", None), (None, None, 3.0), ("a", "y", 1.0), ("a", "y", 1.0)]
    df = spark.createDataFrame(data, "key string, g string, x double")
    rows = lambda d: sorted(d.collect(), key=repr)
    places = Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last())
    want = df.withColumn("got", F.rank().over(places).cast("long"))
    assert rows(ranking.rank_in(df, ["g"], "x", "key", "got")) == rows(want)
    want = df.withColumn("got", F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_last())))
    assert rows(ranking.percent_rank(df, "x", "key", "got")) == rows(want)
    want = df.withColumn("got", F.row_number().over(Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last(), "key")).cast("long"))
    assert rows(ranking.row_number_in(df, ["g"], "x", "key", "got")) == rows(want)
    assert ranking.average_percentile_in(df, ["g"], "x", "key", "got").count() == len(data)


def test_percent_rank(spark, rows, way):
    want = F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_last()))
    same(ranking.percent_rank(rows.withColumn("want", want), "x", "key", "got"), "got", "want")


def test_percent_rank_in_groups(spark, rows, way):
    want = F.percent_rank().over(Window.partitionBy("g").orderBy(F.col("x").asc_nulls_last()))
    same(ranking.percent_rank(rows.withColumn("want", want), "x", "key", "got", by=["g"]), "got", "want")


def test_rank_in_group(spark, rows, way):
    want = F.rank().over(Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last())).cast("long")
    same(ranking.rank_in(rows.withColumn("want", want), ["g"], "x", "key", "got"), "got", "want")


def test_average_percentile(spark, rows, way):
    pdf = rows.toPandas()
    pdf["want"] = pdf.groupby("g")["x"].rank(pct=True) * 100
    got = ranking.average_percentile_in(rows, ["g"], "x", "key", "got").toPandas()
    both = pdf.merge(got[["key", "got"]], on="key")
    assert len(both) == 3000
    assert (both["want"].isna() == both["got"].isna()).all()
    known = both.dropna(subset=["want"])
    assert (known["want"] - known["got"]).abs().max() < 1e-9


def test_row_number(spark, rows):
    want = F.row_number().over(Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last(), "key")).cast("long")
    same(ranking.row_number_in(rows.withColumn("want", want), ["g"], "x", "key", "got"), "got", "want")
    want = F.row_number().over(Window.orderBy(F.col("x").asc_nulls_last(), "key")).cast("long")
    placed = ranking.row_positions(rows, "x", "key")
    same(rows.withColumn("want", want).join(placed.select("key", "row_number"), "key"), "row_number", "want")


@pytest.mark.parametrize("tiles", [2, 3, 4, 7])
def test_ntile(spark, rows, tiles):
    want = F.ntile(tiles).over(Window.orderBy(F.col("x").asc_nulls_last(), "key"))
    same(ranking.ntile(rows.withColumn("want", want), tiles, "x", "key", "got"), "got", "want")


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5])
def test_few_rows(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("key"), F.lit(1.0).alias("x"))
    got = ranking.ntile(ranking.percent_rank(df, "x", "key", "p"), 3, "x", "key", "t").orderBy("key").collect()
    assert [r["p"] for r in got] == [0.0] * n
    sizes = [[r["t"] for r in got].count(t) for t in (1, 2, 3)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_all_null(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit(None).cast("double").alias("x"))
    assert {r["p"] for r in ranking.percent_rank(df, "x", "key", "p").collect()} == {0.0}
    assert ranking.exact_quantiles(df, ["x"], [0.5]).count() == 0


@pytest.mark.parametrize("way", ["bracket", "all values", "missed bracket"])
def test_exact_quantiles(spark, rows, monkeypatch, way):
    if way == "missed bracket":
        monkeypatch.setattr(ranking, "_bracketed", lambda df, cols, ps: {(c, p): None for c in cols for p in ps})
    quantiles = ranking.counted_quantiles if way == "all values" else ranking.exact_quantiles
    pdf = rows.toPandas()
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column_name"], r["probability"]): r["value"]
           for r in quantiles(rows.withColumn("y", -F.col("x") * 3), ["x", "y"], probs).collect()}
    assert len(got) == 12
    for p in probs:
        assert got["x", p] == pytest.approx(pdf["x"].quantile(p))
        assert got["y", p] == pytest.approx((-3 * pdf["x"]).quantile(p))


def test_brackets_hold_few_values(spark, monkeypatch):
    """Distinct values: only those near the quantile are ranked, and none is missed."""
    seen = []
    whole = ranking.value_positions
    monkeypatch.setattr(ranking, "value_positions", lambda df, *a, **k: seen.append(df.count()) or whole(df, *a, **k))
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_000).cast("double").alias("x"))
    assert ranking.exact_quantiles(df, ["x"], [0.5]).first().value == 99_999.5
    assert seen[0] < 2000


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_no_window_over_all_rows(spark, rows):
    plan = plan_of(ranking.ntile(ranking.percent_rank(rows, "x", "key", "p"), 3, "x", "key", "t"))
    assert "SinglePartition" not in plan
    grouped = plan_of(ranking.rank_in(rows, ["g"], "x", "key", "r"))
    # windows are keyed by the slice besides the group
    assert all("_slice" in line for line in grouped.splitlines() if "Window [" in line and "_offset" not in line
               and "_slice_n" not in line)


def test_several_columns_in_one_slicing(spark, rows):
    both = rows.withColumn("y", F.when(F.col("x") > 3, -F.col("x")))
    got = ranking.attach_percent_ranks(both, {"x": "px", "y": "py"})
    assert set(got.columns) == {*both.columns, "px", "py"}
    apart = ranking.percent_rank(ranking.percent_rank(both, "x", "key", "px"), "y", "key", "py")
    assert got.exceptAll(apart.select(*got.columns)).count() == 0 and got.count() == both.count()
