"""Facility scores and community context."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions import columns as c
from wardlight.functions.exact import settle
from wardlight.operators import ranking
from wardlight.operators.aggregates import rollup_mean
from wardlight.operators.joins import left_join_chain, with_global
from wardlight.sources.seeds import component_weights
from wardlight.workspace import stage

COMMUNITY_COLUMNS = (*fv.COMMUNITY_MEASURES, "community_health_burden_score")


def facility_measures(facilities: DataFrame, readmissions: DataFrame, experience: DataFrame,
                      timely: DataFrame, year: int = fv.CURRENT_YEAR) -> DataFrame:
    """One wide row per facility; facilities without measures keep NULLs."""
    wide = left_join_chain(facilities, [readmissions, experience, timely], "provider_id")
    return wide.withColumn("year", F.lit(year))


def hospital_scores(facilities: DataFrame, readmissions: DataFrame, experience: DataFrame,
                    timely: DataFrame, year: int = fv.CURRENT_YEAR,
                    weights: Mapping[str, float] | None = None) -> DataFrame:
    """Normalised, composite and risk scores.

    The joined measures are staged once: the global minimum and maximum, every
    later ranking and the final projection then read columns of that table
    instead of repeating the joins.
    """
    measures = stage(facility_measures(facilities, readmissions, experience, timely, year), "measures")
    return score(measures, weights)


def score(measures: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    weights = weights or component_weights()
    composite = c.weighted_score({k: weights[w] for k, w in fv.QUALITY_COMPONENTS.items()}, fv.NEUTRAL_SCORE)
    ranged = with_global(
        measures,
        _readm_low=F.min("avg_readmission_score"), _readm_high=F.max("avg_readmission_score"),
        _timely_high=F.max("avg_timely_care_score"),
    )
    performance = c.min_max_100("avg_readmission_score", F.col("_readm_low"), F.col("_readm_high"), invert=True)
    timely = c.piecewise_scale("avg_timely_care_score", "_timely_high")
    return (ranged
            .withColumn("readmission_performance_score", settle(performance))
            .withColumn("timely_care_score_0_100", settle(timely))
            .withColumn("composite_quality_score", settle(composite))
            .withColumn("readmission_risk_score", settle(c.invert_score("readmission_performance_score")))
            .drop("_readm_low", "_readm_high", "_timely_high"))


def state_health(counties: DataFrame) -> DataFrame:
    """Unweighted means of the counties of each state, stored: one row per state."""
    return stage(rollup_mean(counties, "state", COMMUNITY_COLUMNS), "states")


def community_risk(scores: DataFrame, states: DataFrame) -> DataFrame:
    """Adds the state's community measures, the burden tertile and its label.

    Facilities of a state without community data have no burden; NULLs sort
    last, so they land in the third tertile and are labelled "High Burden".
    `states` is stored, so Spark broadcasts it if it is small and otherwise
    merges, splitting a frequent state.
    """
    joined = scores.join(states, "state", "left").select(*scores.columns, *COMMUNITY_COLUMNS)
    tiled = ranking.ntile(joined, 3, "community_health_burden_score", "provider_id", "burden_tertile")
    label = c.value_case("burden_tertile", fv.BURDEN_LABELS, fv.BURDEN_DEFAULT)
    return tiled.withColumn("risk_context_label", label)
