"""Forecasts from the latest inspection: watch-lists, horizon grids, point forecasts, payloads.

A *scorer* is a function that takes rows with ``component``, ``r0``, ``horizon`` and ``age_t0`` and
adds ``likely``, ``conservative`` and ``risk_pct``. Rule scorers and trained models share it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import ANCHOR_HORIZONS, UNKNOWN, PanelConfig, Screen
from wearline.functions.dates import age_on
from wearline.functions.numbers import half_even
from wearline.functions.ratings import (
    at_horizon, decline_flag, forecast_route, rating_band, risk_flag,
)
from wearline.functions.text import is_on_system
from wearline.session import small_side
from wearline.operators.events import by_component, in_region, latest_event, on_system_rows


@dataclass(frozen=True)
class Scorer:
    components: tuple[str, ...]
    predict: Callable[[DataFrame], DataFrame]


def rule_scorer(outlook: DataFrame, cfg: PanelConfig, by: Sequence[str],
                band_of: Column) -> Scorer:
    """Scores by looking up a Markov outlook of bounded size.

    A row without a stratum is looked up as "unknown". The outlook is sent to every task if its
    size allows.
    """
    keys = ["component", "band", "r0", *[f"_by_{c}" for c in by]]
    table = small_side(outlook.withColumn("r0", F.col("r0").cast("double")).withColumnsRenamed(
        {c: f"_by_{c}" for c in by}))

    def predict(rows: DataFrame) -> DataFrame:
        asked = rows.withColumn("band", band_of).withColumns(
            {f"_by_{c}": F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in by})
        return asked.join(table, keys, "left").drop("band", *[f"_by_{c}" for c in by])

    return Scorer(cfg.components, predict)


def starting_points(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The latest inspection of every asset, one row per rated component.

    Screens on region or system must be applied to this result and not to the history, or a
    reclassified asset would resurface with an old record.
    """
    latest = latest_event(panel, cfg)
    built = F.col(cfg.year_built)
    return by_component(latest, cfg, "r0").withColumn(
        "age_t0", age_on(F.col(cfg.event_date), built))


def watchlist(panel: DataFrame, scorer: Scorer, cfg: PanelConfig, component: str,
              screen: Screen | None = None, region: str | None = None,
              ordered: bool = True, attach: Callable[[DataFrame], DataFrame] | None = None,
              ) -> DataFrame:
    """Assets in fair shape whose conservative forecast turns poor, worst first.

    The comparison uses the rounded forecast. The model is asked at every horizon here: carrying
    the rating forward would hide the assets the list is for.
    """
    screen = screen or cfg.screen
    if component not in scorer.components:
        raise ValueError(f"no model for component {component!r}")
    rows = starting_points(panel, cfg).where(F.col("component") == component)
    if screen.on_system_only and cfg.on_system in rows.columns:
        rows = on_system_rows(rows, cfg, prefix=True)
    if region is not None:
        rows = in_region(rows, cfg, region)
    if attach is not None:
        rows = attach(rows)
    # The band on the current rating does not depend on the model, so it is applied before it.
    rows = rows.where(F.col("r0").between(screen.current_min, screen.current_max))
    scored = scorer.predict(rows.withColumn("horizon", F.lit(float(screen.horizon_years))))
    rounded = scored.withColumns({
        "forecast_likely": half_even(F.col("likely"), 1),
        "forecast_conservative": half_even(F.col("conservative"), 1),
        "risk_poor_pct": half_even(F.col("risk_pct"), 0),
    })
    listed = rounded.where(F.col("forecast_conservative") <= screen.poor_threshold).select(
        cfg.asset_id, "component", F.col(cfg.region).alias("region"), cfg.year_built,
        F.year(cfg.event_date).alias("last_inspection_year"), F.col("r0").alias("current_rating"),
        "risk_poor_pct", "forecast_likely", "forecast_conservative",
        half_even(F.col("r0") - F.col("forecast_likely"), 1).alias("predicted_decline"))
    if not ordered:
        return listed
    return listed.orderBy(F.col("risk_poor_pct").desc_nulls_last(),
                          F.col("forecast_conservative").asc_nulls_last(), cfg.asset_id)


def with_rank(listed: DataFrame) -> DataFrame:
    """Adds the place in the list of each component; equal scores share a place.

    Scores are rounded, so there are at most about 10,000 different ones: those are counted and
    ordered, and the assets themselves are never sorted.
    """
    keys = ["component", "risk_poor_pct", "forecast_conservative"]
    worse = Window.partitionBy("component").orderBy(
        F.col("risk_poor_pct").desc_nulls_last(), F.col("forecast_conservative").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    places = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        (F.coalesce(F.sum("_n").over(worse), F.lit(0)) + 1).alias("rank"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return listed.join(places, same[0] & same[1] & same[2]).drop(*[f"_{k}" for k in keys])


def horizon_grid(rows: DataFrame, scorer: Scorer, cfg: PanelConfig,
                 anchors: Sequence[int] = ANCHOR_HORIZONS) -> DataFrame:
    """Forecasts at every anchor, long: one row per starting point and horizon.

    Up to the hybrid threshold the rating is carried forward and no model is called: such rows
    are emitted next to the first scored anchor, so the input is read once and only far anchors
    are scored.
    """
    near = [h for h in anchors if h <= cfg.hybrid_years]
    far = [h for h in anchors if h > cfg.hybrid_years]
    carried = [F.struct(F.lit(float(h)).alias("horizon"), F.col("r0").alias("likely"),
                        F.col("r0").alias("conservative"),
                        F.lit(None).cast("double").alias("risk_pct")) for h in near]
    if not far:
        return rows.select("*", F.inline(F.array(*carried)))
    start = rows.columns
    scored = scorer.predict(rows.withColumn(
        "horizon", F.explode(F.array(*[F.lit(float(h)) for h in far]))))
    own = F.array(F.struct("horizon", half_even(F.col("likely"), 1).alias("likely"),
                           half_even(F.col("conservative"), 1).alias("conservative"),
                           half_even(F.col("risk_pct"), 0).alias("risk_pct")))
    if near:
        own = F.when(F.col("horizon") == far[0], F.concat(F.array(*carried), own)).otherwise(own)
    return scored.select(*start, F.explode(own).alias("_g")).select(*start, "_g.*")


def horizon_maps(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The grid as maps horizon -> value per starting point; each map has one entry per anchor."""
    def as_map(value):
        return F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(F.col("horizon").cast("int"), F.col(value))))).alias(value)

    return grid.groupBy(*keys).agg(as_map("likely"), as_map("conservative"), as_map("risk_pct"))


def read_maps(maps: DataFrame, cfg: PanelConfig, years: Column,
              anchors: Sequence[int] = ANCHOR_HORIZONS) -> DataFrame:
    """Values at any horizon between the anchors, with how they arose and their flags."""
    at = maps.withColumn("years", years.cast("double"))
    far = F.col("years") > cfg.hybrid_years
    out = at.withColumns({
        "likely_at": at_horizon(F.col("likely"), F.col("years"), anchors),
        "conservative_at": at_horizon(F.col("conservative"), F.col("years"), anchors),
        "risk_at": F.when(far, at_horizon(F.col("risk_pct"), F.col("years"), anchors)),
    })
    return out.withColumns({
        "route": forecast_route(F.col("years"), cfg.hybrid_years, anchors),
        "band_at": rating_band(F.col("likely_at")),
        "decline_flag": decline_flag(F.col("likely_at") - F.col("r0")),
        "risk_flag": risk_flag(F.col("risk_at")),
    })


def point_forecast(rows: DataFrame, scorer: Scorer, cfg: PanelConfig,
                   target_year: int) -> DataFrame:
    """The hybrid rule at one calendar year: what is known, carried, or modelled.

    Only rows beyond the hybrid threshold, or without a date, are scored.
    """
    gap = F.lit(target_year) - F.year(cfg.event_date)
    asked = rows.where(F.col("component").isin(*scorer.components)).withColumn(
        "horizon", gap.cast("double"))
    years = F.col("horizon")
    answered = F.coalesce(years <= cfg.hybrid_years, F.lit(False))
    scored = scorer.predict(asked.where(~answered)).unionByName(
        asked.where(answered), allowMissingColumns=True)
    method = (
        F.when(years <= 0, "current").when(years <= cfg.hybrid_years, "carry_forward")
        .otherwise("model")
    )
    modelled = F.col("method") == "model"
    return scored.withColumn("method", method).select(
        cfg.asset_id, "component", "method",
        half_even(F.when(modelled, F.col("likely")).otherwise(F.col("r0")), 1).alias("prediction"),
        half_even(F.when(modelled, F.col("conservative")).otherwise(F.col("r0")), 1)
        .alias("prediction_conservative"),
        half_even(F.when(modelled, F.col("risk_pct")), 0).alias("risk_poor_pct"),
        F.col("r0").alias("current_rating"),
        F.year(cfg.event_date).alias("last_inspection_year"), years.alias("horizon_years"))


def asset_payload(grid: DataFrame, cfg: PanelConfig, values: Sequence[str] = ()) -> DataFrame:
    """One nested row per asset: scalars, positional values, and component -> forecast maps."""
    keep = [c for c in (cfg.region, cfg.year_built, "feat_total", "feat_present", "feat_missing")
            if c in grid.columns]
    grouped = [cfg.asset_id, cfg.event_date, "age_t0", *keep, *values]
    maps = horizon_maps(grid, [*grouped, "component", "r0"])
    forecast = F.struct(F.col("r0").alias("current"), "likely", "conservative", "risk_pct")
    by_name = [x for c in cfg.components for x in (
        F.lit(c), F.first(F.when(F.col("component") == c, forecast), ignorenulls=True))]
    nested = maps.groupBy(*grouped).agg(F.map_filter(
        F.create_map(*by_name), lambda name, value: value.isNotNull()).alias("targets"))
    vals = [F.array(*[F.col(v).cast("string") for v in values]).alias("vals")] if values else []
    return nested.select(
        F.col(cfg.asset_id).alias("id"),
        *[F.col(c).cast("int").alias(c) if c == cfg.year_built else c for c in keep],
        F.year(cfg.event_date).alias("last_year"),
        F.col(cfg.event_date).cast("string").alias("last_inspection"),
        F.col("age_t0").cast("int").alias("age_t0"), *vals, "targets")


def region_summary(grid: DataFrame, cfg: PanelConfig, screen: Screen | None = None,
                   at: float | None = None,
                   anchors: Sequence[int] = ANCHOR_HORIZONS) -> DataFrame:
    """Per region, and in total: assets, those trending poor, coverage and system split.

    An asset counts once however many components trend poor. Assets without a region form the row
    "unknown". The last row (null region) is the total of the same pass.
    """
    screen = screen or cfg.screen
    horizon = screen.horizon_years if at is None else at
    if horizon not in anchors:
        raise ValueError(f"the grid has no forecasts for {horizon} years")
    poor = (
        (F.col("horizon") == horizon)
        & F.col("r0").between(screen.current_min, screen.current_max)
        & (F.col("conservative") <= screen.poor_threshold)
    )
    named = grid.withColumn(cfg.region, F.coalesce(cfg.region, F.lit(UNKNOWN)))
    assets = named.groupBy(cfg.asset_id, cfg.region).agg(
        F.bool_or(F.coalesce(poor, F.lit(False))).alias("poor"),
        F.max(F.col("feat_present") / F.col("feat_total")).alias("share"),
        F.bool_or(F.coalesce(is_on_system(F.col(cfg.on_system)), F.lit(False))).alias("on"))
    n = F.count(F.lit(1))
    return assets.rollup(F.col(cfg.region).alias("region")).agg(
        n.alias("assets"), F.count_if("poor").alias("poor"),
        (F.count_if("poor") * F.lit(100.0) / n).alias("poor_pct"),
        (F.avg("share") * 100).alias("coverage_pct"),
        F.count_if("on").alias("on_assets"), F.count_if(~F.col("on")).alias("off_assets"),
    ).orderBy(F.col("region").isNull(), F.length("region"), "region")


def coverage_confound(regions: DataFrame) -> DataFrame:
    """Does the watch-list rate follow attribute coverage rather than condition?

    Written out from co-moments: a region set without any spread has correlation 0.
    """
    rows = regions.where(F.col("region") != UNKNOWN)
    moments = rows.agg(
        F.count(F.lit(1)).alias("regions"),
        F.covar_pop("coverage_pct", "poor_pct").alias("_cov"),
        (F.stddev_pop("coverage_pct") * F.stddev_pop("poor_pct")).alias("_spread"),
        F.min("coverage_pct").alias("lowest_pct"), F.max("coverage_pct").alias("highest_pct"))
    corr = F.when((F.col("regions") >= 3) & (F.col("_spread") > 0),
                  F.col("_cov") / F.col("_spread")).otherwise(F.lit(0.0))
    verdict = (
        F.when(F.col("regions") < 8, "too few").when(F.col("correlation") <= -0.5, "confounded")
        .otherwise("comparable")
    )
    return moments.withColumn("correlation", corr).select(
        "regions", "correlation", "lowest_pct", "highest_pct", verdict.alias("verdict"))


def combine_forecasts(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary forecasts, and the fallback for whatever the primary lacks, marked by source."""
    first = primary.withColumn("source", F.lit("trajectory"))
    second = fallback.join(primary.select(*keys).distinct(), list(keys), "left_anti")
    return first.unionByName(second.withColumn("source", F.lit("attributes")),
                             allowMissingColumns=True)
