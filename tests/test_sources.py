"""Files, names, aliases, stored tables, logs and checks."""

import csv
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from wardlight.operators import quality
from wardlight.operators.shape import ensure_columns
from wardlight.sources import ingest, layers, quoted

NOW = datetime(2024, 5, 6, tzinfo=timezone.utc)


def test_csv_keeps_text_and_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('Id,Name,Name,Note\n00501,"a ""b""",x,"two\nlines"\n7,,y,\n')
    assert ingest.has_line_breaks_in_quotes(spark, str(path))
    df = ingest.clean_columns(ingest.read_raw_csv(spark, str(path)))
    assert df.columns == ["id", "name", "name_1", "note"]
    assert sorted(map(tuple, df.collect())) == [("00501", 'a "b"', "x", "two\nlines"), ("7", None, "y", None)]


def test_plain_csv_stays_splittable(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b\n"1,2",3\n')
    assert not ingest.has_line_breaks_in_quotes(spark, str(path))
    assert ingest.read_raw_csv(spark, str(path)).collect()[0].asDict() == {"a": "1,2", "b": "3"}


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("ZIP Code", "zip--code ", "2nd %", "_X_")
    assert ingest.clean_columns(df).columns == ["zip_code", "zip_code_2", "col_2nd", "x"]


def test_alias_takes_the_first_existing_column(spark):
    df = spark.createDataFrame([("1", None, "c")], "facility_id string, facility_name string, hospital_name string")
    got = ingest.canonicalize(df, "general").first()
    assert got.provider_id == "1"
    assert got.hospital_name == "c"  # an existing target is kept
    assert got.overall_rating is None


def test_load_all(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Facility ID,Score\n001,5\n")
    out = ingest.load_all(spark, {"hospitals_timely_care": str(tmp_path / "t.csv")}, NOW)["hospitals_timely_care"]
    row = out.first()
    assert (row.provider_id, row.score, row.measure_id, row.source_file) == ("001", "5", None, "t.csv")
    assert out.select(F.col("loaded_at") == F.lit(NOW)).first()[0]
    assert len(ingest.default_registry("/raw")) == 9


def test_reconcile_and_log(spark, tmp_path):
    a, b = spark.range(5).toDF("x"), spark.range(3).toDF("x")
    report = layers.reconcile_counts({"a": a, "b": b}, {"a": a, "b": a})
    assert {(r.table_name, r.status) for r in report.collect()} == {("a", "PASS"), ("b", "FAIL")}
    log = layers.log_run(spark, str(tmp_path / "log"), "load_raw", NOW, NOW, report)
    log = layers.log_run(spark, str(tmp_path / "log"), "load_raw", NOW, NOW, report.where("status = 'PASS'"))
    assert sorted(r.status for r in log.collect()) == ["failed", "success"]
    assert log.select("run_id").distinct().count() == 2


def test_layers(spark, tmp_path):
    df = spark.range(4).toDF("x")
    layers.build_layer({"stg": df}, "staging", str(tmp_path))
    assert spark.table("staging_stg").count() == 4
    stored = layers.build_layer({"m": df}, "marts", str(tmp_path))["m"]
    assert stored.count() == 4 and spark.table("marts_m").count() == 4
    assert layers.write_table(spark.range(2).toDF("x"), str(tmp_path), "marts", "m").count() == 2


def test_gates(spark):
    df = spark.createDataFrame([("High", 1.0), ("High", None), ("Low", 2.0)],
                               "readmission_risk_label string, composite_quality_score double")
    report = quality.performance_gate(df, floor=2)
    assert [r.ok for r in report.collect()] == [True, False, True]
    gate = quality.performance_gate(df, floor=2, models={"risk": "/no/such/model", "root": "/"})
    assert [r.ok for r in gate.collect()] == [True, False, True, False, True]
    with pytest.raises(RuntimeError, match="null rate"):
        quality.require_passed(report)
    empty = df.limit(0)
    assert not quality.check_not_empty(empty, "t").first().ok
    assert quality.check_max_share(empty, "readmission_risk_label").first().value == 0.0
    twice = quality.check_unique(df, "readmission_risk_label").first()
    assert (twice.ok, twice.value) == (False, 1.0)


def test_ensure_columns(spark):
    df = spark.createDataFrame([("7",), ("x",)], "score string")
    got = ensure_columns(df, {"state": "N/A", "score": None}, ["score"]).collect()
    assert [tuple(r) for r in got] == [(7.0, "N/A"), (None, "N/A")]


def test_folder_by_name_and_null_markers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("id,score\n007,N/A\n008,3\n")
    (tmp_path / "d" / "2.csv").write_text("score,id,more\nNULL,009,x\n")
    got = {tuple(r) for r in ingest.read_raw_csv(spark, str(tmp_path / "d")).select("id", "score", "more").collect()}
    assert got == {("007", None, None), ("008", "3", None), ("009", None, "x")}
    kept = ingest.read_raw_csv(spark, str(tmp_path / "d" / "1.csv"), null_markers=()).first()
    assert kept["score"] == "N/A"


def test_numbered_names_stay_free(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], ["a", "A", "a_2", "a "])
    assert ingest.clean_columns(df).columns == ["a", "a_3", "a_2", "a_4"]


def test_records_across_splits(spark, tmp_path):
    """Quoted line breaks anywhere, also over several splits: the rows of one reader, read by many tasks."""
    rnd = random.Random(4)
    folder = tmp_path / "many"
    folder.mkdir()
    want = []
    for k in range(4):
        header = ["id", "note, long", "x"] if k < 3 else ["x", "id"]
        rows = [[f"{k}-{n}", rnd.choice(["plain", 'a "quoted" word', "two\nlines", "\n\n" + "long line\n" * rnd.randrange(60), "a,b", "é\n"]),
                 rnd.choice(["1", "", "0"])] for n in range(120)]
        rows = rows if k < 3 else [[r[2], r[0]] for r in rows]
        with open(folder / f"{k}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\r\n" if k == 1 else "\n")
            writer.writerows([header, *rows])
        want += [(r[0], r[1], r[2] or None) if k < 3 else (r[1], None, r[0] or None) for r in rows]
    (folder / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        files = quoted.survey(spark, [str(folder)])
        assert any(sum(f.inside.values()) > 1 for f in files.values()) and len(files) == 4
        df = ingest.read_raw_csv(spark, str(folder))
        assert df.rdd.getNumPartitions() > 20
        assert sorted(map(tuple, df.select("id", "`note, long`", "x").collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_failed_write_keeps_the_table(spark, tmp_path):
    root = str(tmp_path)
    layers.write_table(spark.range(3).toDF("x"), root, "raw", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="broken"):
        layers.write_table(broken, root, "raw", "t")
    old = layers.read_table(spark, root, "raw", "t")
    assert old.count() == 3
    itself = layers.write_table(old.union(old), root, "raw", "t")
    assert itself.count() == 6 and old.count() == 3  # the version before can still be read
    layers.write_table(itself.limit(1), root, "raw", "t")
    assert layers.read_table(spark, root, "raw", "t").count() == 1
    assert len(list((tmp_path / "raw" / "t").glob("v-*"))) == 2
    with pytest.raises(FileNotFoundError):
        layers.read_table(spark, root, "raw", "none")


def test_load_and_reconcile(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Facility ID,Score\n001,"5\n6"\n002,N/A\n')
    (tmp_path / "b.csv").write_text("LocationID,Data_Value\n")
    registry = {"hospitals_timely_care": str(tmp_path / "a.csv"), "cdc_places_county": str(tmp_path / "b.csv")}
    log = str(tmp_path / "log")
    tables, report = layers.load_logged(spark, registry, str(tmp_path / "w"), log, NOW)
    assert {tuple(r) for r in report.collect()} == {("hospitals_timely_care", 2, 2, 9, "PASS"), ("cdc_places_county", 0, 0, 9, "PASS")}
    assert tables["hospitals_timely_care"].where("score is null").count() == 1
    with pytest.raises(Exception):
        layers.load_logged(spark, registry | {"hospitals_general": str(tmp_path / "no.csv")}, str(tmp_path / "w"), log, NOW)
    assert sorted(r.status for r in spark.read.parquet(log).collect()) == ["failed", "success"]
