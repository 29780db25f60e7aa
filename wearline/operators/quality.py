"""Gates that tell whether a source is what the models expect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.config import COORDINATE_BOX, PLAUSIBLE_RANGES, PanelConfig
from wearline.functions.dates import inspection_date
from wearline.functions.numbers import decode_degrees, to_number
from wearline.functions.text import clean_id
from wearline.operators.medians import medians_by

MIN_INSPECTIONS = 3.0
MAX_OUTSIDE_PCT = 5.0


def required_columns(df: DataFrame, cfg: PanelConfig) -> list[str]:
    """The required columns that are missing."""
    needed = [cfg.asset_id, cfg.raw_date, cfg.on_system, cfg.region, *cfg.components[:3]]
    return [c for c in needed if c not in df.columns]


def panel_shape(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row: sizes, date parse rate and range, inspections per asset and the verdict.

    Rows are reduced to (asset, date, count) first, which is where hot assets shrink.
    """
    dated = panel.select(clean_id(F.col(cfg.asset_id)).alias("a"),
                         inspection_date(F.col(cfg.raw_date)).alias("d"))
    grain = dated.groupBy("a", "d").agg(F.count(F.lit(1)).alias("n"))
    per_asset = grain.groupBy("a").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("d").isNotNull(), F.col("n"))).alias("parsed"),
        F.count("d").alias("dates"), F.min("d").alias("first"), F.max("d").alias("last"))
    known = F.col("a").isNotNull()
    total = per_asset.agg(
        F.sum("n").alias("rows"),
        F.count("a").alias("assets"),
        F.coalesce(F.sum("parsed"), F.lit(0)).alias("parsed_rows"),
        F.min("first").alias("first_date"), F.max("last").alias("last_date"),
        F.coalesce(F.sum(F.when(known, F.col("dates"))), F.lit(0)).alias("dated_inspections"),
        F.count_if(known & (F.col("dates") > 0)).alias("dated_assets"),
    )
    per = F.coalesce(F.col("dated_inspections") / F.nullif(F.col("dated_assets"), F.lit(0)),
                     F.lit(0.0))
    return total.select("rows", "assets", "parsed_rows", "first_date", "last_date",
                        "dated_inspections", per.alias("inspections_per_asset"),
                        (per >= MIN_INSPECTIONS).alias("is_panel"))


def value_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None,
                 with_median: bool = True) -> DataFrame:
    """Per checked column: values, share outside its range, median and the verdict."""
    ranges = {c: r for c, r in (ranges or PLAUSIBLE_RANGES).items() if c in df.columns}
    numbers = df.select(*[to_number(F.col(c)).alias(c) for c in ranges])
    counts = numbers.agg(*[
        f for c, (low, high) in ranges.items() for f in (
            F.count(c).alias(f"{c}__n"),
            F.count_if(~F.col(c).between(low, high)).alias(f"{c}__out"))])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(float(low)).alias("low"),
                 F.lit(float(high)).alias("high"), F.col(f"{c}__n").alias("n"),
                 F.col(f"{c}__out").alias("outside"))
        for c, (low, high) in ranges.items()])
    table = counts.select(F.inline(entries)).where("n > 0")
    share = F.col("outside") * F.lit(100.0) / F.col("n")
    table = table.select("column", "low", "high", "n", share.alias("outside_pct"),
                         (share > MAX_OUTSIDE_PCT).alias("out_of_range"))
    if with_median:
        wide = medians_by(numbers, [], list(ranges))
        long = wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("median")) for c in ranges])))
        table = table.join(long, "column", "left")
    return table


def decode_loss(raw: DataFrame,
                columns: Sequence[str] = tuple(COORDINATE_BOX)) -> DataFrame | None:
    """Per coordinate and digit width: how many values decode to an impossible place, and how
    many are recorded as zero. A width that dominates is a form the decoder does not know.
    A source without coordinates has nothing to lose."""
    columns = [c for c in columns if c in raw.columns]
    if not columns:
        return None
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), to_number(F.col(c)).alias("raw"),
                 decode_degrees(to_number(F.col(c)), west=c == "longitude").alias("degrees"),
                 F.lit(COORDINATE_BOX[c][0]).alias("low"), F.lit(COORDINATE_BOX[c][1]).alias("high"))
        for c in columns])
    values = raw.select(F.inline(entries)).where(F.col("raw").isNotNull())
    lost = F.col("degrees").isNotNull() & ~F.col("degrees").between(F.col("low"), F.col("high"))
    zero = F.col("raw") == 0
    width = F.when(lost, F.length(F.abs(F.col("raw")).cast("bigint").cast("string")))
    return (
        values.where(lost | zero)
        .groupBy("column", F.coalesce(width, F.lit(0)).alias("digits"))
        .agg(F.count_if(lost).alias("implausible"), F.count_if(zero).alias("recorded_as_zero"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys, keys held by several rows, and the rows beyond the first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Fill share and number of distinct values per column.

    The exact form counts (column, value) pairs and never holds a column's values in one place;
    the approximate form is one pass with fixed-size sketches.
    """
    if not exact:
        wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[
            f for c in columns for f in (F.count(c).alias(f"{c}__n"),
                                         F.approx_count_distinct(c).alias(f"{c}__d"))])
        return wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"),
                     F.col(f"{c}__n").alias("filled"), F.col(f"{c}__d").alias("distinct_values"))
            for c in columns])))
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                        for c in columns])
    counts = df.select(F.inline(entries)).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    filled = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"), filled.alias("filled"),
        (filled * F.lit(100.0) / F.sum("n")).alias("filled_pct"),
        F.count("value").alias("distinct_values"))
