"""Column sets: defaults for missing columns, projections of those that exist."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.functions.columns import to_number


def as_number(df: DataFrame, c: str) -> Column:
    """Column as a double: a cast if it is numeric, lenient parsing if it is text."""
    numeric = isinstance(df.schema[c].dataType, T.NumericType)
    return F.col(c).cast("double") if numeric else to_number(c)


def ensure_columns(df: DataFrame, defaults: Mapping[str, object], numeric: Sequence[str]) -> DataFrame:
    """Adds missing columns with their default and reads `numeric` ones as numbers."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    return df.withColumns({c: as_number(df, c) for c in numeric})


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))
