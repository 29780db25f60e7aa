"""Repeatable, leak-free train/test assignment."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import PanelConfig
from wearline.functions.text import share_bucket


def is_test_asset(cfg: PanelConfig, key: Column | None = None) -> Column:
    """All rows of an asset fall on the same side."""
    key = F.col(cfg.asset_id) if key is None else key
    return share_bucket(key, cfg.seed) < int(round(cfg.test_share * 1000))


def with_split(df: DataFrame, cfg: PanelConfig, method: str = "group",
               row_key: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``is_test`` by asset, or by row where asked or where no asset id exists."""
    if method == "group" and cfg.asset_id in df.columns:
        return df.withColumn("is_test", is_test_asset(cfg))
    columns = row_key or tuple(df.columns)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return df.withColumn("is_test", is_test_asset(cfg, key))


def fold_of(cfg: PanelConfig, folds: int, key: Column | None = None) -> Column:
    """Cross-validation fold by asset, independent of the test assignment."""
    key = F.col(cfg.asset_id) if key is None else key
    return (share_bucket(key, cfg.seed + 1) % folds).cast("int")


def cutoff_day(events: DataFrame, cfg: PanelConfig, share: float = 0.7) -> datetime.date:
    """The first day by which at least this share of the inspections had taken place.

    Inspections are counted by day first, so the running total is over the calendar.
    """
    d = cfg.event_date
    days = events.groupBy(d).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy(d))
    total = F.sum("_n").over(Window.partitionBy())
    found = days.select(d, (upto >= total * F.lit(share)).alias("_in")).where("_in").agg(F.min(d).alias("d")).first()
    if found["d"] is None:
        raise ValueError("no dated inspections to cut")
    return found["d"]


def temporal_side(cfg: PanelConfig, cutoff: datetime.date) -> Column:
    """train, test or purged for a pair: neither an asset nor a stretch of time is on both sides.

    Training pairs end by the cut-off and belong to training assets; test pairs begin after it and
    belong to held-out assets. A pair that reaches across the cut-off, or lies on the wrong side of
    it for its asset, is purged.
    """
    held_out = is_test_asset(cfg)
    return (
        F.when(~held_out & (F.col("d1") <= F.lit(cutoff)), "train")
        .when(held_out & (F.col("d0") > F.lit(cutoff)), "test").otherwise("purged")
    )


def temporal_events(events: DataFrame, cfg: PanelConfig, cutoff: datetime.date) -> DataFrame:
    """The inspections whose pairs ``temporal_side`` keeps: pairs across the cut-off cannot form."""
    before = F.col(cfg.event_date) <= F.lit(cutoff)
    return events.where(F.when(is_test_asset(cfg), ~before).otherwise(before))


def split_leaks(pairs: DataFrame, cfg: PanelConfig, side: Column) -> DataFrame:
    """Pairs per side and component, and what the sides share.

    time_leaks: test pairs that begin on or before the last day that training saw. asset_leaks:
    assets with pairs on both sides. Rows are reduced to (component, asset) first.
    """
    rows = pairs.withColumn("_side", side)

    def on(name, value=F.lit(1)):
        return F.when(F.col("_side") == name, value)

    last = F.max("_last").over(Window.partitionBy("component"))
    # Starts are counted by day: a day's test pairs leak or not together.
    by_day = rows.groupBy("component", "d0").agg(
        F.count(on("test")).alias("_test"), F.count(on("train")).alias("_train"),
        F.count(on("purged")).alias("_purged"), F.max(on("train", F.col("d1"))).alias("_last"))
    counts = by_day.withColumn("_seen", last).groupBy("component").agg(
        F.sum("_train").alias("n_train"), F.sum("_test").alias("n_test"), F.sum("_purged").alias("n_purged"),
        F.coalesce(F.sum(F.when(F.col("d0") <= F.col("_seen"), F.col("_test"))), F.lit(0)).alias("time_leaks"))
    assets = rows.groupBy("component", cfg.asset_id).agg(
        F.count(on("test")).alias("_test"), F.count(on("train")).alias("_train"))
    shared = assets.groupBy("component").agg(
        F.count_if((F.col("_test") > 0) & (F.col("_train") > 0)).alias("asset_leaks"))
    return counts.join(shared, "component")
