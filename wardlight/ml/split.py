"""Reproducible splits: membership depends on the row id and the seed, not on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions.columns import seeded_hash
from wardlight.operators import ranking
from wardlight.workspace import stage

_STEPS = 1_000_000


def _hash(key: str, seed: int) -> Column:
    return seeded_hash(F.col(key), seed)


def _shuffled_in(df: DataFrame, key: str, seed: int, strata: str) -> DataFrame:
    """Adds `_place`, the row's place in its stratum in hash order, and `_stratum_n`."""
    hashed = df.withColumn("_hash", _hash(key, seed))
    return ranking.numbered_in(hashed, "_hash", key, [strata], out="_place", size="_stratum_n").drop("_hash")


def split(df: DataFrame, key: str, share: float = fv.TEST_SHARE, seed: int = fv.SEED,
          strata: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test). With `strata` every class is divided in the same proportion, and both are parts of one stored table."""
    if strata is None:
        in_test = F.pmod(_hash(key, seed), F.lit(_STEPS)) < F.lit(round(share * _STEPS))
        return df.where(~in_test), df.where(in_test)
    placed = stage(_shuffled_in(df, key, seed, strata), "split")
    in_test = F.col("_place") <= F.round(F.col("_stratum_n") * F.lit(share))
    clean = lambda d: d.drop("_place", "_stratum_n")
    return clean(placed.where(~in_test)), clean(placed.where(in_test))


def with_folds(df: DataFrame, key: str, k: int = fv.FOLDS, seed: int = fv.SEED, strata: str | None = None,
               out: str = "fold") -> DataFrame:
    """Adds the fold number 0..k-1; with `strata` fold sizes in a class differ by at most one."""
    if strata is None:
        return df.withColumn(out, F.pmod(_hash(key, seed), F.lit(k)).cast("int"))
    placed = _shuffled_in(df, key, seed, strata)
    return placed.withColumn(out, F.pmod(F.col("_place"), F.lit(k)).cast("int")).drop("_place", "_stratum_n")
