"""Calibrated risk: an isotonic step from counted scores, and how well forecasts are borne out.

Scores are percentages. They are counted in a fixed number of bins first, so that everything after the
count depends on the bins and not on the rows. The fit is the non-decreasing step that pooling adjacent
violators ends at, written as its min-max form: the value of a bin is the largest, over all bins at or
below it, of the least share that any run of bins from there to at least this bin has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import PanelConfig
from wearline.functions.numbers import clip
from wearline.functions.text import share_bucket
from wearline.operators.split import is_test_asset
from wearline.session import small_side

BINS = 100


def is_calibration_asset(cfg: PanelConfig, share: float, key: Column | None = None) -> Column:
    """Training assets that are kept from the fit and only calibrate it."""
    key = F.col(cfg.asset_id) if key is None else key
    return ~is_test_asset(cfg, key) & (share_bucket(key, cfg.seed + 2) < int(round(share * 1000)))


#: The column of pairs that tells what they are for: "test", "calibrate" or "learn".
SIDE = "_side"


def side_of(cfg: PanelConfig, share: float) -> Column:
    """What the rows of an asset are for, when this share of the training assets calibrates."""
    return F.when(is_test_asset(cfg), "test").when(is_calibration_asset(cfg, share), "calibrate").otherwise("learn")


def score_bin(score: Column, bins: int = BINS) -> Column:
    """0..bins - 1 for a percentage, null without one; 100 falls in the last bin."""
    return clip(F.floor(score * bins / 100), 0, bins - 1).cast("int")


def count_bins(df: DataFrame, by: Sequence[str], score: str, poor: Column, weight: Column | None = None,
               bins: int = BINS) -> DataFrame:
    """(by, bin, n, poor) over the rows that have a score and an outcome."""
    w = F.lit(1) if weight is None else weight
    rows = df.where(F.col(score).isNotNull() & poor.isNotNull())
    return rows.groupBy(*by, score_bin(F.col(score), bins).alias("bin")).agg(
        F.sum(w).cast("long").alias("n"), F.sum(F.when(poor, w).otherwise(0)).cast("long").alias("poor"))


def isotonic_steps(counted: DataFrame, by: Sequence[str], bins: int = BINS) -> DataFrame:
    """(by, bin, calibrated_pct) for every bin of every group that was counted at all.

    A bin without rows takes the value of the nearest bin below it, or the lowest value. At most
    bins * (bins + 1) / 2 runs are compared in a group.
    """
    upto = Window.partitionBy(*by).orderBy("bin")
    totals = counted.select(*by, "bin", F.sum("n").over(upto).alias("_n"), F.sum("poor").over(upto).alias("_p"),
                            F.col("n").alias("_own_n"), F.col("poor").alias("_own_p"))
    first = totals.select(*by, F.col("bin").alias("_from"), (F.col("_n") - F.col("_own_n")).alias("_n0"),
                          (F.col("_p") - F.col("_own_p")).alias("_p0"))
    runs = totals.join(first, list(by)).where(F.col("_from") <= F.col("bin"))
    share = (F.col("_p") - F.col("_p0")) * F.lit(100.0) / (F.col("_n") - F.col("_n0"))
    longer = Window.partitionBy(*by, "_from").orderBy(F.desc("bin"))
    fitted = (runs.withColumn("_least", F.min(share).over(longer))
              .groupBy(*by, "bin").agg(F.max("_least").alias("_fit")))
    every = counted.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    known = F.last("_fit", ignorenulls=True).over(upto)
    lowest = F.min("_fit").over(Window.partitionBy(*by))
    return every.join(fitted, [*by, "bin"], "left").select(*by, "bin", F.coalesce(known, lowest).alias("calibrated_pct"))


def calibrate(df: DataFrame, steps: DataFrame, by: Sequence[str], score: str, bins: int = BINS) -> DataFrame:
    """df with calibrated_pct, null where a row has no score or its group no step."""
    keyed = df.withColumn("bin", score_bin(F.col(score), bins))
    return keyed.join(small_side(steps), [*by, "bin"], "left").drop("bin")


def reliability(df: DataFrame, by: Sequence[str], forecast: str, poor: Column,
                weight: Column | None = None) -> DataFrame:
    """The observed share of poor outcomes beside each forecast value, with its rows."""
    w = F.lit(1) if weight is None else weight
    rows = df.where(F.col(forecast).isNotNull() & poor.isNotNull())
    return rows.groupBy(*by, F.col(forecast).alias("forecast_pct")).agg(
        F.sum(w).cast("long").alias("n"),
        (F.sum(F.when(poor, w).otherwise(0)) * F.lit(100.0) / F.sum(w)).alias("observed_pct"))


def calibration_error(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean distance of forecast and observed share, weighted by rows."""
    gap = F.abs(F.col("forecast_pct") - F.col("observed_pct")) * F.col("n")
    return table.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum(gap) / F.sum("n")).alias("calibration_error"))
