"""Aggregations. All of them merge partial results on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions.columns import flag
from wardlight.functions.exact import PARTS, mean, mean_of, parts
from wardlight.operators.joins import share_of_total
from wardlight.operators.ranking import exact_quantiles
from wardlight.workspace import stage


# ---- long to wide ----------------------------------------------------------

def pivot(df: DataFrame, keys: Sequence[str], value: str, means: Mapping[str, Column | None],
          text: str | None = None, text_max: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key with conditional means (and conditional maxima of a text column).

    Conditions may overlap: a row feeds every column whose condition holds, and
    the condition None takes all rows. A row's conditions and the parts of its
    value are worked out once, before they are added up. Each task merges its own
    rows of a key before the shuffle. A maximum of text would make Spark sort all
    rows for that instead of hashing; so texts are put for by numbers in the same
    order, of which the largest is text again at the end.
    """
    conditions = {f"_in_{name}": c for name, c in [*means.items(), *(text_max or {}).items()] if c is not None}
    texts = {} if text is None else {"_text": F.col(text)}
    rows = df.select(*keys, *[c.alias(name) for name, c in conditions.items()], *[c.alias(name) for name, c in texts.items()],
                     *[c.alias(f"_{name}") for name, c in parts(F.col(value)).items()])
    pick = lambda name, c: F.when(F.col(f"_in_{name}"), F.col(c)) if f"_in_{name}" in conditions else F.col(c)
    aggs = [mean_of({part: pick(name, f"_{part}") for part in PARTS}).alias(name) for name in means]
    if not text_max:
        return rows.groupBy(*keys).agg(*aggs)
    numbered = _numbered(df.select(F.col(text).alias("_text")))
    grouped = rows.join(numbered, "_text", "left").groupBy(*keys).agg(
        *aggs, *[F.max(pick(name, "_number")).alias(f"_number_{name}") for name in text_max])
    for name in text_max:
        own = numbered.select(F.col("_number").alias(f"_number_{name}"), F.col("_text").alias(name))
        grouped = grouped.join(own, f"_number_{name}", "left")
    return grouped.select(*keys, *means, *text_max)


def _numbered(texts: DataFrame) -> DataFrame:
    """Stored: each text of the one column of `texts` (_text) but NULL, with a number (_number) in the order of the texts."""
    known = texts.where(F.col("_text").isNotNull()).distinct().repartitionByRange("_text").sortWithinPartitions("_text")
    return stage(known.withColumn("_number", F.monotonically_increasing_id()), "texts")


def rollup_mean(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Unweighted mean of the child rows per parent."""
    return df.groupBy(key).agg(*[mean(F.col(c)).alias(c) for c in cols])


# ---- regional summary ------------------------------------------------------

def top_name(name: str, score: str, tie_break: str) -> Column:
    """Name of the row with the highest score (NULL scores last, then the lowest id)."""
    return F.min_by(F.col(name), F.struct(F.col(score).isNull(), -F.col(score), F.col(tie_break)))


def percent_of(condition: Column) -> Column:
    """Share of rows, in percent, for which the condition holds (NULL counts as not)."""
    return F.count_if(condition).cast("double") / F.count(F.lit(1)) * 100.0


def regional_summary(df: DataFrame) -> DataFrame:
    label = F.col("readmission_risk_label")
    return df.groupBy("state").agg(
        F.count(F.lit(1)).alias("hospital_count"),
        mean(F.col("composite_quality_score")).alias("avg_quality_score"),
        mean(F.col("readmission_risk_score")).alias("avg_readmission_risk"),
        percent_of(label == "High").alias("pct_high_risk"),
        percent_of(label == "Low").alias("pct_low_risk"),
        mean(F.col("community_health_burden_score")).alias("avg_community_burden"),
        top_name("hospital_name", "composite_quality_score", "provider_id").alias("top_performing_hospital"),
        top_name("hospital_name", "readmission_risk_score", "provider_id").alias("most_at_risk_hospital"),
    )


# ---- key figures -----------------------------------------------------------

def kpis(df: DataFrame) -> DataFrame:
    """One row: facilities, three means, percent labelled High."""
    return df.agg(
        F.count(F.lit(1)).alias("hospitals"),
        mean(F.col("composite_quality_score")).alias("avg_quality"),
        mean(F.col("readmission_risk_score")).alias("avg_risk"),
        mean(F.col("overall_patient_experience_score")).alias("avg_patient_experience"),
        F.try_divide(F.count_if(F.col("readmission_risk_label") == "High") * F.lit(100.0),
                     F.count(F.lit(1))).alias("high_risk_pct"),
    )


def performance_kpis(df: DataFrame) -> DataFrame:
    """One row: facilities, two means (NULL when nothing is known), number labelled High."""
    return df.agg(
        F.count(F.lit(1)).alias("hospitals"),
        mean(F.col("composite_quality_score")).alias("avg_quality"),
        mean(F.col("readmission_risk_score")).alias("avg_risk"),
        F.count_if(F.lower(F.coalesce(F.col("readmission_risk_label"), F.lit(""))) == "high")
        .alias("high_risk_hospitals"),
    )


# ---- groups ----------------------------------------------------------------

def ordered_counts(df: DataFrame, c: str, order: Sequence[str]) -> DataFrame:
    """(category, n, place) for the listed categories that occur, in the listed order."""
    places = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order, 1)], f"{c} string, place int")
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(places), c).orderBy("place")


def mix_by(df: DataFrame, c: str, n: int = 15, id_col: str = "provider_id",
           quality: str = "composite_quality_score", risk: str = "readmission_risk_score") -> DataFrame:
    """Largest groups (NULL is a group) with counts of known ids and two means."""
    return df.groupBy(c).agg(
        F.count(id_col).alias("hospitals"),
        mean(F.col(quality)).alias("avg_quality"),
        mean(F.col(risk)).alias("avg_risk"),
    ).orderBy(F.desc("hospitals"), F.col(c).asc_nulls_last()).limit(n)


def by_state(df: DataFrame, key: str = "state", score: str = "readmission_risk_score",
             id_col: str = "provider_id") -> DataFrame:
    return df.dropna(subset=[key]).groupBy(key).agg(
        mean(F.col(score)).alias(f"avg_{score}"), F.count(id_col).alias("hospital_count"))


def rank_groups(df: DataFrame, key: str, c: str, n: int = 25) -> DataFrame:
    """Groups with the highest mean, NULL groups dropped."""
    means = df.dropna(subset=[key]).groupBy(key).agg(mean(F.col(c)).alias(c))
    return means.orderBy(F.col(c).desc_nulls_last(), key).limit(n)


def avg_by(df: DataFrame, key: str, c: str, out: str, n: int | None = None,
           count_as: str | None = None) -> DataFrame:
    """Mean per group, highest first (NULL is a group), optionally with counts and only the first n."""
    aggs = [mean(F.col(c)).alias(out)]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    ordered = df.groupBy(key).agg(*aggs).orderBy(F.col(out).desc_nulls_last(), F.col(key).asc_nulls_last())
    return ordered if n is None else ordered.limit(n)


def null_rate(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.avg(flag(F.col(c).isNull())).alias("null_rate"))


def max_share(df: DataFrame, c: str) -> DataFrame:
    """Share of the most frequent category, 0 for an empty table."""
    return share_of_total(df, c).agg(F.coalesce(F.max("share"), F.lit(0.0)).alias("max_share"))


def bounds(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.min(c).alias("low"), F.max(c).alias("high"))


# ---- statistics ------------------------------------------------------------

def _unpivot(row: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in cols])
    return row.select(F.explode(pairs).alias("p")).select(f"p.{name}", f"p.{value}")


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(title, r) of each column pair over the rows where both are known, in one pass."""
    both = lambda x, y, c: F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(c).cast("double"))
    # Two rows or fewer distinct values give no defined correlation: NaN is reported as NULL.
    row = df.agg(*[F.nanvl(F.corr(both(x, y, x), both(x, y, y)), F.lit(None).cast("double")).alias(title)
                   for x, y, title in pairs])
    pairs_ = F.array(*[F.struct(F.lit(t).alias("title"), F.col(f"`{t}`").alias("r")) for _, _, t in pairs])
    return row.select(F.explode(pairs_).alias("p")).select("p.title", "p.r")


def strongest(corrs: DataFrame) -> DataFrame:
    return corrs.orderBy(F.abs("r").desc_nulls_last(), "title").limit(1)


def ols_by(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Least-squares line of y on x, one per category when `by` is given."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    aggs = [
        F.regr_slope(fy, fx).alias("slope"), F.regr_intercept(fy, fx).alias("intercept"),
        F.regr_r2(fy, fx).alias("r2"), F.regr_count(fy, fx).alias("n"),
    ]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def histogram(df: DataFrame, c: str, bins: int, by: str | None = None) -> DataFrame:
    """(bin, low, high, n): equal bins from minimum to maximum; the maximum falls in the last one."""
    known = df.where(F.col(c).isNotNull())
    edges = known.agg(F.min(c).cast("double").alias("_lo"), F.max(c).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col(c).cast("double") - F.col("_lo"), width)).cast("int")
    bin_ = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    keys = [F.col(by)] if by else []
    return (known.crossJoin(F.broadcast(edges))
            .groupBy(*keys, bin_.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("low"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"), "n"))


def _quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float],
               accuracy: int | None) -> DataFrame:
    """(column_name, probability, value), exact unless an accuracy is given."""
    if accuracy is None:
        return exact_quantiles(df, cols, probabilities)
    wanted = [float(p) for p in probabilities]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), wanted, accuracy).alias(c) for c in cols])
    values = _unpivot(row, cols, "column_name", "found").where(F.col("found").isNotNull())
    return values.select("column_name", F.explode(F.arrays_zip(
        F.lit(wanted).alias("probability"), F.col("found").alias("value"))).alias("p")).select("column_name", "p.*")


def box_stats(df: DataFrame, c: str, accuracy: int | None = None) -> DataFrame:
    """One row: min, q1, median, q3, max; exact at any size, or one approximate pass."""
    q = _quantiles(df, [c], [0.0, 0.25, 0.5, 0.75, 1.0], accuracy)
    at = lambda p: F.max(F.when(F.col("probability") == F.lit(p), F.col("value")))
    return q.agg(at(0.0).alias("min"), at(0.25).alias("q1"), at(0.5).alias("median"),
                 at(0.75).alias("q3"), at(1.0).alias("max"))


def medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """(column_name, median); a column without values gets 0."""
    found = _quantiles(df, cols, [0.5], accuracy).select("column_name", F.col("value").alias("median"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return names.join(F.broadcast(found), "column_name", "left").select(
        "column_name", F.coalesce("median", F.lit(0.0)).alias("median"))


def mean_abs(df: DataFrame, cols: Sequence[str], n: int = 10) -> DataFrame:
    """Columns with the largest mean absolute value."""
    row = df.agg(*[F.avg(F.abs(F.col(c).cast("double"))).alias(c) for c in cols])
    return _unpivot(row, cols, "feature", "importance").orderBy(
        F.col("importance").desc_nulls_last(), "feature").limit(n)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(row, cols, "column_name", "nulls")
