"""Text files to raw tables: all columns as text, cleaned names, canonical columns, lineage."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight import fixed_values as fv
from wardlight.sources import quoted


def has_line_breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """True when some line of some file holds an odd number of quotes, so that a record spans lines."""
    return any(f.odd for f in quoted.survey(spark, [path]).values())


def _distinct_header(names: Sequence[str]) -> list[str]:
    """A repeated header cell gets `.1`, `.2`, ... so that no column is lost."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(name if n == 0 else f"{name}.{n}")
    return out


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool | None = None,
                 null_markers: Sequence[str] = fv.NULL_MARKERS) -> DataFrame:
    """Every row of a CSV file, or of all files of a folder, with a header; every column as text.

    No type is inferred, so ids keep their leading zeros. Each file is read by its own header and the files are put
    together by name; a column that a file lacks is NULL in its rows. Cells that hold a null marker are NULL. One job looks
    over all files first. Files of the same header are one scan; of these, those whose quoted fields hold line breaks are cut
    into records split by split. `multi_line` says of all files whether they do, in place of what the job finds.
    """
    files = quoted.survey(spark, [path])
    by_header: dict[tuple[str, bool], dict[str, quoted.File]] = {}
    for name, file in files.items():
        if file.header is not None:
            by_header.setdefault((file.header, file.odd if multi_line is None else multi_line), {})[name] = file
    if not by_header:
        raise ValueError(f"no header in {path}")
    cells = _header_cells(spark, sorted({header for header, _ in by_header}))
    tables = [_read_files(spark, group, cells[header], odd, null_markers) for (header, odd), group in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


_CSV = {"quote": '"', "escape": '"'}


def _header_cells(spark: SparkSession, headers: Sequence[str]) -> dict[str, list[str]]:
    """The names in each header record."""
    widths = {h: h.count(",") + 1 for h in headers}
    rows = spark.createDataFrame([(h,) for h in headers], "header string")
    schema = ", ".join(f"c{k} string" for k in range(max(widths.values())))
    found = rows.select("header", F.from_csv("header", schema, _CSV).alias("cells")).select("header", F.array("cells.*").alias("cells")).collect()
    out = {}
    for header, cells in found:
        # commas inside of quotes part no cells: names end where only NULLs follow
        last = max((k for k, c in enumerate(cells[:widths[header]]) if c is not None), default=-1) + 1
        trailing = len(header) - len(header.rstrip(","))
        names = cells[:last + trailing]
        out[header] = _distinct_header([v if v is not None else f"unnamed {k}" for k, v in enumerate(names)])
    return out


def _read_files(spark: SparkSession, files: Mapping[str, quoted.File], names: Sequence[str], multi_line: bool,
                null_markers: Sequence[str]) -> DataFrame:
    """Files of one header."""
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    if multi_line:
        ddl = ", ".join(f"c{k} string" for k in range(len(names)))
        rows = quoted.records(spark, dict(files)).select(F.from_csv("record", ddl, _CSV).alias("r")).select("r.*")
    else:
        rows = spark.read.options(**_CSV, header=True, enforceSchema=True).schema(schema).csv(list(files))
    cell = lambda k: F.col(f"c{k}")
    return rows.select(*[F.when(~cell(k).isin(list(null_markers)), cell(k)).alias(n) if null_markers else cell(k).alias(n)
                         for k, n in enumerate(names)])


def clean_column(name: str) -> str:
    """Lower case, runs of other characters to one `_`, `col_` before a leading digit."""
    name = re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")
    return f"col_{name}" if name[:1].isdigit() else name


def clean_columns(df: DataFrame) -> DataFrame:
    """Cleaned names; a name that is taken gets the first free of `_2`, `_3`, ... Names that need no number come first."""
    bases = [clean_column(c) for c in df.columns]
    taken, out = set(bases), []
    for base in bases:
        name, number = base, 2
        while name in out:
            name = f"{base}_{number}" if f"{base}_{number}" not in taken else name
            number += 1
        out.append(name)
    return df.toDF(*out)


def add_alias(df: DataFrame, target: str, candidates: Sequence[str], default=None) -> DataFrame:
    """Adds `target` from the first candidate column there is; an existing target stays."""
    if target in df.columns:
        return df
    source = next((c for c in candidates if c in df.columns), None)
    value = F.col(source) if source else F.lit(default).cast("string")
    return df.withColumn(target, value)


def canonicalize(df: DataFrame, kind: str) -> DataFrame:
    for target, candidates in fv.CANONICAL_COLUMNS[kind].items():
        df = add_alias(df, target, candidates)
    return df


def kind_of(table: str) -> str:
    prefixes = {
        "hospitals_general": "general", "hospitals_readmissions": "readmission",
        "hospitals_patient_experience": "experience", "hospitals_timely_care": "timely",
        "cdc_places_county": "county",
    }
    return next(kind for prefix, kind in prefixes.items() if table.startswith(prefix))


def with_lineage(df: DataFrame, name: str, loaded_at: datetime) -> DataFrame:
    """File name and load time; the caller fixes the time once per run."""
    return df.withColumn("source_file", F.lit(name)).withColumn("loaded_at", F.lit(loaded_at))


def load_table(spark: SparkSession, table: str, path: str, loaded_at: datetime) -> DataFrame:
    raw = canonicalize(clean_columns(read_raw_csv(spark, path)), kind_of(table))
    return with_lineage(raw, path.rstrip("/").rsplit("/", 1)[-1], loaded_at)


def default_registry(folder: str) -> dict[str, str]:
    return {t: f"{folder.rstrip('/')}/{t}.csv" for t in fv.DATASETS}


def load_all(spark: SparkSession, registry: Mapping[str, str], loaded_at: datetime) -> dict[str, DataFrame]:
    return {table: load_table(spark, table, path, loaded_at) for table, path in registry.items()}
