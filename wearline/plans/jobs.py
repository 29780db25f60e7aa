"""The composite jobs, from source frames to written results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.config import UNKNOWN, PanelConfig, Screen, TreeParams
from wearline.operators.calibration import SIDE, side_of
from wearline.operators.clean import clean_panel
from wearline.operators.enrich import attach_static, with_coverage
from wearline.operators.events import inspection_events, latest_event
from wearline.operators.features import engineer, trajectory_columns
from wearline.operators.metrics import by_method, grouped_summary, score
from wearline.operators.pairs import forward_pairs, long_pairs, wide_pairs
from wearline.operators.quality import decode_loss, panel_shape, required_columns, value_ranges
from wearline.functions.ratings import horizon_label
from wearline.plans import models as ml
from wearline.plans.outlook import (
    Scorer, asset_payload, combine_forecasts, horizon_grid, point_forecast, region_summary,
    starting_points, with_rank,
)
from wearline.plans.outlook import watchlist as build_watchlist
from wearline.session import settle
from wearline.sources import writers


def enriched_events(panel: DataFrame, static: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """Events with their attributes, written once: the self-join reads them twice, with different columns."""
    return settle(attach_static(inspection_events(panel, cfg), static, cfg), "events")


def training_pairs(panel: DataFrame, static: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """Pairs with their inputs. Attributes join the events, of which there are far fewer."""
    return pairs_with_inputs(enriched_events(panel, static, cfg), cfg)


def _features(events: DataFrame, cfg: PanelConfig) -> list[str]:
    numeric, text = trajectory_columns(events.columns, cfg)
    return [c for c in (*numeric, *text) if c in events.columns]


def pairs_with_inputs(events: DataFrame, cfg: PanelConfig) -> DataFrame:
    return forward_pairs(events, cfg, _features(events, cfg))


def stored_pairs(events: DataFrame, cfg: PanelConfig, params: TreeParams) -> DataFrame:
    """The same pairs, written once, with what they are for in the fits of ``params``.

    Fits and evaluation read them many times, mostly those of one component and side. The components of a pair
    share a row and the sides have folders; the side is taken of the events, of which there are far fewer.
    """
    sided = events.withColumn(SIDE, side_of(cfg, params.calibration_share))
    return long_pairs(settle(wide_pairs(sided, cfg, [*_features(events, cfg), SIDE]), "pairs", by=[SIDE]), cfg)


def train(raw: DataFrame, static: DataFrame | None, cfg: PanelConfig, params: TreeParams,
          root: str, tuning: dict | None = None) -> dict[str, str]:
    """Both model families, their metrics, predictions, importances and the grouped summary."""
    spark = raw.sparkSession
    panel_path = writers.write_panel(clean_panel(raw, cfg), root)
    panel = spark.read.parquet(panel_path)
    pairs = stored_pairs(enriched_events(panel, static, cfg), cfg, params)
    trajectories = ml.fit_all_trajectories(pairs, cfg, params)
    if trajectories:
        ml.save_trajectories(trajectories, f"{root}/models", spark)
    features = settle(attach_static(engineer(panel, cfg), static, cfg), "features")
    attributes, metrics = ml.fit_all_attributes(features, cfg, params, tuning=tuning)
    if attributes:
        ml.save_attributes(attributes, f"{root}/attribute_models", spark)
    predictions = ml.predict_attributes(attributes, features) if attributes else None
    predicted = [f"{c}_{k}_predicted" for c, m in attributes.items() for k in m.models]
    tables = {
        "trajectory_metrics": trajectory_metrics(pairs, trajectories, cfg) if trajectories else None,
        "metrics": metrics,
        "predictions": predictions,
        "feature_importance": ml.attribute_importance(attributes, spark) if attributes else None,
        "summary": None if predictions is None else grouped_summary(
            predictions, [cfg.region, "climate_zone"], [*predicted, *attributes]),
    }
    written = writers.write_results(tables, root)
    written["panel"] = panel_path
    return written


def trajectory_metrics(pairs: DataFrame, models, cfg: PanelConfig) -> DataFrame:
    """Model and carry-forward error on held-out assets by component and horizon band."""
    return scored_metrics(ml.predict_by_component(models, ml.held_out(pairs, cfg), cfg), cfg)


def scored_metrics(scored: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The same of held-out pairs that are scored already."""
    rows = by_method(scored.withColumn("band", horizon_label(F.col("horizon"), cfg.bands)),
                     {"model": F.col("likely"), "conservative": F.col("conservative"),
                      "carry_forward": F.col("r0")})
    return score(rows.where(F.col("band").isNotNull()), ["component", "band", "method"])


def publish_watchlist(panel: DataFrame, static: DataFrame | None, scorer: Scorer,
                      cfg: PanelConfig, component: str, root: str, region: str | None = None,
                      screen: Screen | None = None) -> str:
    """The list for one component and scope; the screen decides whether off-system assets count."""
    listed = settle(build_watchlist(panel, scorer, cfg, component, screen, region, ordered=False,
                                    attach=lambda rows: attach_static(rows, static, cfg)), "watchlist")
    return writers.write_watchlist(with_rank(listed), root)


def forecast_grid(panel: DataFrame, static: DataFrame | None, scorer: Scorer, cfg: PanelConfig,
                  attributes: list[str]) -> DataFrame:
    """Every asset at every anchor, scored once for all regions, with its coverage."""
    rows = attach_static(starting_points(panel, cfg), static, cfg)
    return horizon_grid(with_coverage(rows, attributes), scorer, cfg)


def publish_regions(grid: DataFrame, cfg: PanelConfig, root: str, scope: str = "all",
                    values: tuple[str, ...] = (), screen: Screen | None = None) -> dict[str, str]:
    """Payloads by region and the index summary; scopes never share a folder. The grid is
    written once, so that nothing is scored twice."""
    grid = settle(grid, "grid")
    named = grid.withColumn(cfg.region, F.coalesce(cfg.region, F.lit(UNKNOWN)))
    payload = asset_payload(named, cfg, values)
    packs = writers.write_by_region(payload.withColumnRenamed(cfg.region, "region"), root, scope)
    index = f"{root}/index/scope={scope}"
    region_summary(grid, cfg, screen).write.mode("overwrite").parquet(index)
    return {"packs": packs, "index": index}


def forecast_year(panel: DataFrame, static: DataFrame | None, cfg: PanelConfig, root: str,
                  target_year: int, asset: str | None = None) -> DataFrame:
    """Forecasts of one asset, or of all, from the models that ``train`` saved below ``root``.

    Trajectory forecasts come first; attribute forecasts fill in where an asset has none.
    """
    spark = panel.sparkSession
    if asset is not None:
        panel = panel.where(F.col(cfg.asset_id) == asset)
    trajectories = ml.load_trajectories(cfg, f"{root}/models", spark)
    attributes = ml.load_attributes(cfg, f"{root}/attribute_models", spark)
    starts = attach_static(starting_points(panel, cfg), static, cfg)
    primary = point_forecast(starts, ml.trajectory_scorer(trajectories, cfg), cfg, target_year)
    if not attributes:
        return primary.withColumn("source", F.lit("trajectory"))
    fallback = ml.attribute_forecast(attributes, latest_features(panel, static, cfg), cfg, target_year)
    return combine_forecasts(primary, fallback, [cfg.asset_id, "component"])


def verify_source(raw: DataFrame, cfg: PanelConfig) -> dict[str, DataFrame | list[str] | None]:
    """The four source gates. Units are judged after decoding, losses before it."""
    panel = clean_panel(raw, cfg)
    return {
        "missing_columns": required_columns(raw, cfg),
        "shape": panel_shape(raw, cfg),
        "ranges": value_ranges(panel),
        "decode_loss": decode_loss(raw),
    }


def latest_features(panel: DataFrame, static: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """One engineered row per asset for the attribute forecast."""
    return attach_static(engineer(latest_event(panel, cfg), cfg), static, cfg)
