"""Column expressions on hand-made edge values."""

import pytest
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions import columns as c
from wardlight.functions.exact import mean, settle


def values(spark, inputs, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_key_and_code(spark):
    assert values(spark, [" a ", "  ", "", None], c.clean_key("x")) == ["a", None, None, None]
    assert values(spark, [" tx ", None], c.code("x")) == ["TX", None]


@pytest.mark.parametrize("tokens", [fv.READMISSION_NULLS, fv.TIMELY_NULLS])
def test_parse_numeric_null_tokens(spark, tokens):
    texts = [t for token in tokens for t in (token, token.upper(), token.title())]
    assert values(spark, texts + [None], c.parse_numeric("x", tokens)) == [None] * (len(texts) + 1)


def test_parse_numeric_dirty(spark):
    texts = ["12%", "1,234", " 7.5 *", "-3", "-", "1.2.3", "10-20", "1e-05", "too few to report"]
    want = [12.0, 1234.0, 7.5, -3.0, None, None, None, None, None]
    assert values(spark, texts, c.parse_numeric("x", fv.EXPERIENCE_NULLS)) == want


def test_parse_rating(spark):
    assert values(spark, ["4", "4 stars", "Not Available", "N/A", "", None, "x"], c.parse_rating("x")) == [
        4, 4, None, None, None, None, None]
    assert values(spark, ["3", "N/A"], c.rating_to_100("x")) == [60.0, None]


def test_coerce_numeric_matches_tokens_as_they_stand(spark):
    texts = ["12%", "1,000", "n/a", "N/A", "nan", "NaN", "", "1e3", "1.5d", " 2 ", None, "-.5"]
    assert values(spark, texts, c.coerce_numeric("x")) == [
        12.0, 1000.0, None, None, None, None, None, 1000.0, None, 2.0, None, -0.5]


def test_to_number(spark):
    assert values(spark, ["1.5", "x", "", "5.", None], c.to_number("x")) == [1.5, None, None, 5.0, None]


def test_initcap_starts_words_at_every_break(spark):
    texts = ["ST. MARY'S-HOSPITAL", "3RD street CLINIC", "", None, "élan VITAL"]
    assert values(spark, texts, c.initcap_alnum("x")) == [
        "St. Mary'S-Hospital", "3rd Street Clinic", "", None, "Élan Vital"]


def test_zip5(spark):
    assert values(spark, ["123", "00501", "123456789", None, "a-1"], c.zip5("x")) == [
        "00123", "00501", "12345", "00000", "00001"]


def test_keyword_classes(spark):
    kinds = ["CRITICAL ACCESS", "Rural Emergency", "Acute", None]
    assert values(spark, kinds, c.keyword_case("x", fv.SETTING_RULES, "Urban")) == ["Rural", "Rural", "Urban", "Urban"]
    owners = ["Government - State", "Voluntary not for profit", "Voluntary non-profit", "Tribal", None]
    assert values(spark, owners, c.keyword_case("x", fv.OWNERSHIP_RULES, "Other")) == [
        "Government", "For-profit", "Non-profit", "Other", "Other"]


def test_measure_key_prefers_id(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), (None, None)], "id string, name string")
    rows = df.select(c.measure_key("id", "name"), c.coalesce_text("name", "id")).collect()
    assert [tuple(r) for r in rows] == [("a", "B"), ("b", "B"), ("", "")]


def test_scales(spark):
    assert values(spark, [5.0, 5.1, None], c.star_to_100("x"), "double") == [100.0, 5.1, None]
    scaled = values(spark, [5.0, 100.0, 150.0, 300.0, None, 7.0], c.piecewise_scale("x", F.lit(300.0)), "double")
    assert scaled == [100.0, 100.0, 50.0, 0.0, None, 7.0]


def test_min_max_constant_column(spark):
    args = (F.lit(3.0), F.lit(3.0))
    assert values(spark, [3.0, None], c.min_max_100("x", *args, invert=True), "double") == [50.0, None]
    filled = c.min_max_100("x", *args, fill_null_when_constant=True)
    assert values(spark, [3.0, None], filled, "double") == [50.0, 50.0]
    unknown = c.min_max_100("x", F.lit(None).cast("double"), F.lit(None).cast("double"), fill_null_when_constant=True)
    assert values(spark, [None], unknown, "double") == [50.0]


def test_labels_at_their_cuts(spark):
    risk = c.bucket_label("x", fv.RISK_LABEL_RULES, fv.RISK_LABEL_DEFAULT)
    assert values(spark, [0.67, 0.669, 0.33, 0.331, None], risk, "double") == ["High", "Medium", "Low", "Medium", "Medium"]
    tier = c.bucket_label("x", fv.QUALITY_TIER_RULES, fv.QUALITY_TIER_DEFAULT)
    assert values(spark, [0.9, 0.89, 0.5, 0.33, 0.1], tier, "double") == [
        "Top 10%", "Above Average", "Average", "Below Average", "Bottom 10%"]
    burden = c.value_case("x", fv.BURDEN_LABELS, fv.BURDEN_DEFAULT)
    assert values(spark, [3, 2, 1, None], burden, "int") == ["High Burden", "Moderate Burden", "Low Burden", "Low Burden"]
    colour = c.band("x", fv.QUALITY_BANDS, fv.QUALITY_BAND_DEFAULT)
    assert values(spark, [70.0, 50.0, 49.9], colour, "double") == ["green", "amber", "red"]


def test_weights_and_encoding(spark):
    df = spark.createDataFrame([(10.0, None), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(c.weighted_score({"a": 0.5, "b": 0.5}, 50.0)).collect()] == [30.0, 50.0]
    assert values(spark, ["Other", "zzz", None], c.encode("x", fv.TYPE_CODES, 4)) == [4, 4, 4]
    assert values(spark, [30.0, None], c.invert_score("x"), "double") == [70.0, 50.0]


def test_searches(spark):
    df = spark.createDataFrame([("A_b (1)", None), ("axb", "TX"), (None, "tx")], "name string, state string")
    count = lambda cond: df.where(cond).count()
    assert count(c.search_like(["name", "state"], "")) == 3
    assert count(c.search_like(["name"], "a_b")) == 2
    assert count(c.search_like(["name"], "(")) == 1
    assert count(c.search_regex(["name", "state"], "^T")) == 2
    assert count(c.eq_ci("state", "TX")) == 2
    assert count(c.filter_in(state=["tx"], name=[])) == 1
    assert count(c.filter_in()) == 3


def test_exact_mean(spark):
    df = spark.createDataFrame([(-1.5,), (2.25,), (None,), (-7.1,)], "x double")
    assert df.agg(mean(F.col("x"))).first()[0] == (-1.5 + 2.25 - 7.1) / 3
    big = spark.createDataFrame([(2e10,), (1.0,)], "x double")
    assert big.agg(mean(F.col("x"))).first()[0] == pytest.approx((2e10 + 1) / 2)
    assert df.where("x > 100").agg(mean(F.col("x"))).first()[0] is None
    # 0.1 added in any order and any grouping gives the same mean
    tenth = spark.range(100_000).select(F.lit(0.1).alias("x"))
    assert {tenth.repartition(n).agg(mean(F.col("x"))).first()[0] for n in (1, 3, 7)} == {0.1}
    assert values(spark, [1.0000000004, 1 / 3], settle(F.col("x")), "double") == [1.0, 0.333333333]
