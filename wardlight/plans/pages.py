"""The tables behind each report page, and the fixed analytics questions.

Every function returns lazy DataFrames over the stored marts; only what a page
shows (key figures, bins, top rows) ever leaves the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions.columns import band, eq_ci, filter_in, search_like, search_regex
from wardlight.operators import aggregates as agg
from wardlight.operators import filters, ordering
from wardlight.operators.shape import ensure_columns, select_existing


# ---- pages -----------------------------------------------------------------

def national_overview(perf: DataFrame, regions: DataFrame, states: Sequence[str] = (), risks: Sequence[str] = (),
                      types: Sequence[str] = (), tiers: Sequence[str] = (), search: str = "") -> dict[str, DataFrame]:
    chosen = perf.where(filter_in(state=states, readmission_risk_label=risks, hospital_type=types, quality_tier=tiers))
    found = chosen.where(search_regex(fv.SEARCHED_COLUMNS, search)) if search else chosen
    return {
        "kpis": agg.kpis(chosen),
        "histogram": agg.histogram(chosen, "composite_quality_score", fv.OVERVIEW_BINS),
        "box": agg.box_stats(chosen, "composite_quality_score"),
        "risk_counts": agg.ordered_counts(chosen, "readmission_risk_label", fv.RISK_ORDER),
        "type_mix": agg.mix_by(chosen, "hospital_type"),
        "best_states": ordering.best_states(regions),
        "riskiest_states": ordering.riskiest_states(regions),
        "leaderboard": select_existing(
            ordering.top_n(found, "composite_quality_score", 300, "provider_id"), fv.OVERVIEW_COLUMNS),
    }


def hospital_search(perf: DataFrame, term: str = "", limit: int = 500) -> DataFrame:
    hits = perf.where(search_like(fv.SEARCHED_COLUMNS, term)).select(*fv.SEARCH_RESULT)
    return ordering.top_n(hits, "composite_quality_score", limit, "provider_id")


def readmission_map(perf: DataFrame, states: Sequence[str] = (), types: Sequence[str] = (),
                    risks: Sequence[str] = (), owners: Sequence[str] = ()) -> dict[str, DataFrame]:
    chosen = perf.where(filter_in(state=states, hospital_type=types, readmission_risk_label=risks,
                                  hospital_ownership=owners))
    return {"states": agg.by_state(chosen), "kpis": agg.kpis(chosen).select("hospitals", "avg_risk", "high_risk_pct")}


def scorecard(perf: DataFrame, low: float | None = None, high: float | None = None, states: Sequence[str] = (),
              types: Sequence[str] = (), risks: Sequence[str] = (), owners: Sequence[str] = ()) -> DataFrame:
    """Filtered facilities with the colour band of their quality; NULL quality is out of any range."""
    chosen = perf.where(filter_in(state=states, hospital_type=types, readmission_risk_label=risks,
                                  hospital_ownership=owners))
    quality = F.col("composite_quality_score")
    chosen = chosen.where(quality.isNotNull())
    if low is not None:
        chosen = chosen.where(quality >= low)
    if high is not None:
        chosen = chosen.where(quality <= high)
    colour = band("composite_quality_score", fv.QUALITY_BANDS, fv.QUALITY_BAND_DEFAULT)
    return chosen.select(*fv.SCORECARD_COLUMNS, colour.alias("quality_band"))


def community_page(perf: DataFrame, state: str | None = None) -> dict[str, DataFrame]:
    chosen = perf if state is None else perf.where(F.col("state") == state)
    corrs = agg.correlations(chosen, fv.CORRELATION_PAIRS)
    lines = {f"line_{x}": agg.ols_by(chosen.dropna(subset=[x, y]), x, y, "readmission_risk_label")
             for x, y, _ in fv.CORRELATION_PAIRS}
    return {"correlations": corrs, "strongest": agg.strongest(corrs),
            "state_burden": agg.rank_groups(perf, "state", "community_health_burden_score"), **lines}


def performance_page(perf: DataFrame, state: str | None = None) -> dict[str, DataFrame]:
    """The patient experience shown is the overall score."""
    named = perf.withColumn("patient_experience_score", F.col("overall_patient_experience_score"))
    table = ensure_columns(named, fv.PERFORMANCE_DEFAULTS, (
        "composite_quality_score", "readmission_risk_score", "patient_experience_score"))
    table = table.where(F.col("hospital_name").isNotNull())
    if state is not None:
        table = table.where(F.col("state") == state)
    best, riskiest = ordering.leaderboards(table)
    both = ["composite_quality_score", "readmission_risk_score"]
    return {
        "kpis": agg.performance_kpis(table),
        "histogram": agg.histogram(table, "composite_quality_score", fv.PERFORMANCE_BINS),
        "best": best,
        "riskiest": riskiest,
        "scatter": table.dropna(subset=both).select(
            "hospital_name", "city", "state", "readmission_risk_label", *both),
        "full": ordering.sort_desc(table, "composite_quality_score", "provider_id").select(
            *fv.PERFORMANCE_COLUMNS),
    }


# ---- questions -------------------------------------------------------------

def states_by_risk(perf: DataFrame, n: int | None = 10) -> DataFrame:
    return agg.avg_by(perf, "state", "readmission_risk_score", "avg_readmission_risk", n)


def high_risk_in_state(perf: DataFrame, state: str, n: int = 50) -> DataFrame:
    rows = perf.where((F.col("state") == state) & (F.col("readmission_risk_label") == "High")).select(
        "provider_id", "hospital_name", "city", "state", "readmission_risk_score", "readmission_risk_label")
    return ordering.top_n(rows, "readmission_risk_score", n, "provider_id")


def top_quality(perf: DataFrame, n: int = 10, state: str | None = None) -> DataFrame:
    rows = perf if state is None else perf.where(F.col("state") == state)
    rows = rows.select("provider_id", "hospital_name", "city", "state", "composite_quality_score")
    return ordering.top_n(rows, "composite_quality_score", n, "provider_id")


def quality_by_type(perf: DataFrame) -> DataFrame:
    return agg.avg_by(perf, "hospital_type", "composite_quality_score", "avg_quality_score", count_as="hospital_count")


def burdened_but_good(perf: DataFrame, above: float = 70.0, n: int = 50) -> DataFrame:
    return filters.high_burden_high_quality(perf, above, n)


def low_risk_high_experience(perf: DataFrame, state: str, experience_min: float = 70.0, n: int = 50) -> DataFrame:
    good = (F.col("state") == state) & eq_ci("readmission_risk_label", "Low") & (
        F.col("overall_patient_experience_score") >= experience_min)
    rows = perf.where(good).select("provider_id", "hospital_name", "city", "state", "readmission_risk_score",
                                   "overall_patient_experience_score")
    return ordering.top_n(rows, "overall_patient_experience_score", n, "provider_id")


def risk_factor_correlations(perf: DataFrame) -> DataFrame:
    """Each community measure against readmission risk, strongest first."""
    pairs = [(m, "readmission_risk_score", m) for m in fv.COMMUNITY_MEASURES]
    return agg.correlations(perf, pairs).orderBy(F.abs("r").desc_nulls_last(), "title")
