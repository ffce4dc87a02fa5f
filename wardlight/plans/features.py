"""Feature table for the models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight import fixed_values as fv
from wardlight.functions import columns as c
from wardlight.functions.exact import settle
from wardlight.operators import ranking
from wardlight.operators.aggregates import medians
from wardlight.operators.joins import group_mean
from wardlight.operators.shape import as_number
from wardlight.workspace import stage

ENCODED = ("urban_rural_encoded", "hospital_type_encoded", "ownership_encoded")


def type_bucket(col: str):
    return c.keyword_case(col, fv.TYPE_RULES, fv.OTHER)


def ownership_bucket(col: str):
    return c.keyword_case(col, fv.OWNERSHIP_RULES, fv.OTHER)


def build_features(mart: DataFrame) -> DataFrame:
    """Ids, scores, encodings and state-relative features, before imputation.

    `mart` should be a stored table: its state means, ranks and score bounds
    are separate passes over two or three of its columns.
    """
    df = group_mean(mart, "state", "composite_quality_score", "state_avg_quality_score")
    df = ranking.average_percentile_in(df, ["state"], "readmission_risk_score", "provider_id",
                                       "state_readmission_percentile")
    bounds = mart.agg(F.min("readmission_risk_score").alias("_low"), F.max("readmission_risk_score").alias("_high"))
    df = df.crossJoin(F.broadcast(bounds))
    risk = c.min_max_100("readmission_risk_score", F.col("_low"), F.col("_high"), fill_null_when_constant=True)
    setting = F.lower(c.coalesce_text("urban_rural"))
    return df.select(
        *fv.FEATURE_ID_COLUMNS,
        as_number(mart, "composite_quality_score").alias("composite_quality_score"),
        settle(risk).alias("readmission_risk_score"),
        as_number(mart, "overall_patient_experience_score").alias("patient_experience_score"),
        as_number(mart, "community_health_burden_score").alias("community_health_burden_score"),
        c.encode(setting, fv.SETTING_CODES, 1).alias("urban_rural_encoded"),
        c.encode(type_bucket("hospital_type"), fv.TYPE_CODES, fv.TYPE_CODES["Other"]).alias("hospital_type_encoded"),
        c.encode(ownership_bucket("hospital_ownership"), fv.OWNERSHIP_CODES, fv.OWNERSHIP_CODES["Other"])
        .alias("ownership_encoded"),
        "state_avg_quality_score",
        settle(F.col("state_readmission_percentile")).alias("state_readmission_percentile"),
        *[as_number(mart, x).alias(x) for x in fv.OPTIONAL_FEATURES if x in mart.columns],
    )


def numeric_features(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns that are not ids, labels or otherwise excluded."""
    out = set(exclude) | set(fv.FEATURE_ID_COLUMNS)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in out]


def median_values(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Column -> median; as many values as there are columns."""
    return {r["column_name"]: r["median"] for r in medians(df, cols).collect()}


def impute_median(df: DataFrame, cols: Sequence[str], values: Mapping[str, float] | None = None) -> DataFrame:
    values = values or median_values(df, cols)
    return df.withColumns({x: F.coalesce(F.col(x).cast("double"), F.lit(values[x])) for x in cols})


def feature_matrix(mart: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Imputed features and the medians used. Integer encodings have no gaps to fill."""
    features = stage(build_features(mart), "features")
    gaps = [x for x in numeric_features(features) if x not in ENCODED]
    values = median_values(features, numeric_features(features))
    return impute_median(features, gaps, values), values


def fill_target(df: DataFrame, y: str, how: str) -> DataFrame:
    """Unknown targets: `median` for a number, `label` for the middle risk class."""
    if how == "median":
        return impute_median(df, [y])
    return df.withColumn(y, F.coalesce(F.col(y), F.lit(fv.RISK_LABEL_DEFAULT)))


def feature_metadata(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """One row: feature columns, numeric columns, medians, encodings, rows."""
    numeric = numeric_features(df)
    text = lambda names: F.array(*[F.lit(n) for n in names])
    mapping = lambda m, kind: F.map_from_arrays(text(m), F.array(*[F.lit(v).cast(kind) for v in m.values()]))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        text([x for x in numeric if x != "composite_quality_score"]).alias("feature_columns"),
        text(numeric).alias("numeric_columns"),
        mapping(dict(values), "double").alias("medians"),
        F.struct(mapping(fv.TYPE_CODES, "int").alias("hospital_type_encoded"),
                 mapping(fv.OWNERSHIP_CODES, "int").alias("ownership_encoded"),
                 mapping({k.title(): v for k, v in fv.SETTING_CODES.items()}, "int").alias("urban_rural_encoded"),
                 ).alias("encodings"),
        "rows",
    )
