"""Writing and registering tables, row reconciliation, run log, profiles, exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.sources import ingest
from wardlight.workspace import in_parallel

VIEW_LAYERS = ("staging", "intermediate")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- tables ----------------------------------------------------------------

def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


POINTER = "_current"


class _Folder:
    """A table's folder: versions of its files, and a small file that names the current one and the one before."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.hadoop = spark, spark._jvm.org.apache.hadoop.fs
        self.path, self.conf = self.hadoop.Path(path), spark._jsc.hadoopConfiguration()
        self.files = self.path.getFileSystem(self.conf)

    def at(self, name: str):
        return self.hadoop.Path(self.path, name)

    def versions(self) -> list[str]:
        if not self.files.exists(self.at(POINTER)):
            return []
        stream = self.files.open(self.at(POINTER))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
        finally:
            stream.close()

    def point(self, *versions: str) -> None:
        """One rename over the old file, so readers find the old version or the new one."""
        fresh = self.at(f".{versions[0]}.pointer")
        stream = self.files.create(fresh, True)
        stream.write(bytearray("\n".join(versions).encode()))
        stream.close()
        kind = getattr(self.hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self.hadoop.FileContext.getFileContext(self.files.getUri(), self.conf).rename(fresh, self.at(POINTER), options)


def write_table(df: DataFrame, root: str, layer: str, name: str,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Replaces a stored table and returns it as read back.

    The rows go to a new folder; only then does the table point to it. A write that fails leaves the table as it was, a
    table can be made from itself, and who reads the version before goes on reading it: it is deleted with the next write.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    folder, version = _Folder(spark, path), f"v-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    except Exception:
        folder.files.delete(folder.at(version), True)
        raise
    before = folder.versions()
    folder.point(version, *before[:1])
    for old in before[1:]:
        folder.files.delete(folder.at(old), True)
    return spark.read.parquet(f"{path}/{version}")


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The current version of a stored table."""
    path = table_path(root, layer, name)
    versions = _Folder(spark, path).versions()
    if not versions:
        raise FileNotFoundError(f"no table in {path}")
    return spark.read.parquet(f"{path}/{versions[0]}")


def build_layer(dfs: Mapping[str, DataFrame], layer: str, root: str) -> dict[str, DataFrame]:
    """Staging and intermediate become temp views `layer_name`; marts are written."""
    if layer in VIEW_LAYERS:
        for name, df in dfs.items():
            df.createOrReplaceTempView(f"{layer}_{name}")
        return dict(dfs)
    out = {name: write_table(df, root, layer, name) for name, df in dfs.items()}
    for name, df in out.items():
        df.createOrReplaceTempView(f"{layer}_{name}")
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, one per task."""
    df.write.mode("overwrite").option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


# ---- counts ----------------------------------------------------------------

def row_counts(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
                   for t, df in dfs.items()])


def reconcile_counts(source: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> DataFrame:
    """Rows read against rows stored, PASS when equal; a table missing on one side fails."""
    src = row_counts(source).withColumnRenamed("row_count", "source_rows")
    dst = row_counts(stored).withColumnRenamed("row_count", "stored_rows")
    ok = F.col("source_rows").eqNullSafe(F.col("stored_rows"))
    return src.join(dst, "table_name", "full").withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def load(spark: SparkSession, registry: Mapping[str, str], root: str, loaded_at: datetime,
         layer: str = "raw") -> tuple[dict[str, DataFrame], DataFrame]:
    """All files of a registry as stored tables, and a report: table_name, source_rows, stored_rows, columns, status.

    Rows of a file are counted while it is written, and those of the table by the footers of its files, so nothing is read
    twice. Tables are loaded side by side.
    """
    def one(table: str, path: str):
        seen = Observation(table)
        rows = ingest.load_table(spark, table, path, loaded_at).observe(seen, F.count(F.lit(1)).alias("rows"))
        stored = write_table(rows, root, layer, table)
        return table, stored, seen.get["rows"], stored.count(), len(stored.columns)
    found = in_parallel(spark, *[partial(one, t, p) for t, p in registry.items()])
    report = [(t, n, m, k, "PASS" if n == m else "FAIL") for t, _, n, m, k in found]
    return {t: stored for t, stored, *_ in found}, spark.createDataFrame(
        report, "table_name string, source_rows bigint, stored_rows bigint, columns int, status string")


def load_logged(spark: SparkSession, registry: Mapping[str, str], root: str, log_path: str, loaded_at: datetime,
                stage_name: str = "load_raw") -> tuple[dict[str, DataFrame], DataFrame]:
    """`load`, with a row in the run log whatever comes of it; fails if a table has not all rows of its file."""
    now = lambda: datetime.now(timezone.utc)
    started = now()
    try:
        tables, report = load(spark, registry, root, loaded_at)
    except Exception as e:
        failed = spark.createDataFrame([(type(e).__name__, "FAIL")], "error string, status string")
        log_run(spark, log_path, stage_name, started, now(), failed)
        raise
    log_run(spark, log_path, stage_name, started, now(), report)
    short = [r["table_name"] for r in report.where("status <> 'PASS'").collect()]  # a row for each table
    if short:
        raise RuntimeError(f"row counts differ for: {short}")
    return tables, report


def min_rows_check(df: DataFrame, floor: int, name: str = "rows") -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count"), (n > floor).alias("ok")).select(F.lit(name).alias("name"), "row_count", "ok")


# ---- run log ---------------------------------------------------------------

def log_run(spark: SparkSession, path: str, stage_name: str, started_at: datetime, completed_at: datetime,
            details: DataFrame, status_column: str = "status") -> DataFrame:
    """Appends one row: stage, success or failed, times, the details as JSON text.

    `details` has one row per table of the run, so the collected list is as
    short as the list of tables.
    """
    failed = F.count_if(F.col(status_column) != "PASS") > 0
    row = details.agg(
        F.lit(stage_name).alias("pipeline_stage"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.lit(started_at).alias("started_at"),
        F.lit(completed_at).alias("completed_at"),
        F.to_json(F.sort_array(F.collect_list(F.struct(*details.columns)))).alias("details"),
    )
    row.select(F.expr("uuid()").alias("run_id"), *row.columns).write.mode("append").parquet(path)
    return spark.read.parquet(path)


# ---- profiles --------------------------------------------------------------

_TYPE_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def _type_name(t: T.DataType) -> str:
    if isinstance(t, T.ArrayType):
        return _type_name(t.elementType) + "[]"
    return _TYPE_NAMES.get(t.simpleString(), t.simpleString().upper())


def schema_profile(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type, ordinal_position) from the schemas, no data read."""
    spark = next(iter(dfs.values())).sparkSession
    rows = [(t, f.name, _type_name(f.dataType), i)
            for t, df in dfs.items() for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal_position int")


def schema_context(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """Schema profile with each table's row count."""
    return schema_profile(dfs).join(F.broadcast(row_counts(dfs)), "table_name")
