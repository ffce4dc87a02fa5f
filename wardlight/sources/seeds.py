"""Component weights: a small lookup table that drives the weighted scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlight import fixed_values as fv


def weights_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fv.MEASURE_WEIGHTS), "component string, weight double, description string")


def component_weights(table: DataFrame | None = None) -> dict[str, float]:
    """Component -> weight, from `table` (one row per component) or the defaults."""
    if table is None:
        return {name: weight for name, weight, _ in fv.MEASURE_WEIGHTS}
    return {r["component"]: r["weight"] for r in table.select("component", "weight").collect()}
