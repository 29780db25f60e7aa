"""Registered queries on trained models. Their values depend on the learner; a twin supplies the
row counts and the zeros of the invariants."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from wearline.catalogue.outlook_queries import SCREEN, start_rows
from wearline.catalogue.benchmark_queries import BENCHMARK_SQL, KIND, STEPS, stratified_events
from wearline.catalogue.panel_queries import panel, places, static_rows, stored_events
from wearline.catalogue.sql import band, is_test, sql
from wearline.config import PanelConfig, TreeParams
from wearline.operators.features import engineer
from wearline.operators.enrich import attach_static
from wearline.operators.split import is_test_asset
from wearline.plans import jobs
from wearline.plans import models as ml
from wearline.plans import outlook as plan
from wearline.plans.benchmark import benchmark as rule_benchmark
from wearline.plans.benchmark import ranking_quality
from wearline.functions.numbers import clip
from wearline.functions.ratings import horizon_label
from wearline.operators import calibration
from wearline.session import once, settle
from wearline.sources import order_panel as src

CFG = replace(src.CFG, pair_cap=PanelConfig().pair_cap)
PARAMS = TreeParams(rounds=5, depth=4, forest_trees=10)
#: The attribute models that are measured are those of full size.
FULL = TreeParams()


def trained(spark, sf_dir):
    """Pairs and bundles, shared by the queries of one session."""
    def build():
        pairs = jobs.stored_pairs(stored_events(spark, sf_dir), CFG, PARAMS)
        return pairs, ml.fit_all_trajectories(pairs, CFG, PARAMS)

    return once(spark, "trajectories", sf_dir, build)


#: What the queries read of the scored pairs.
SCORED = ("asset_id", "component", "d0", "d1", "horizon", "r0", "r1", "likely", "conservative", "risk_pct",
          "leaf_quantile", "class_quantile", "risk_raw_pct")


def scored_pairs(spark, sf_dir):
    """All held-out pairs with their forecasts, shared by the queries that judge them."""
    def build():
        pairs, models = trained(spark, sf_dir)
        return settle(ml.predict_by_component(models, ml.held_out(pairs, CFG), CFG, detail=True).select(*SCORED), "scored")

    return once(spark, "scored", sf_dir, build)


def features(spark, sf_dir):
    return attach_static(engineer(panel(spark, sf_dir), CFG), static_rows(spark, sf_dir), CFG)


def fitted(spark, sf_dir, params=PARAMS):
    """Attribute models of both types, shared by the queries of one session that want this size."""
    rows = once(spark, "features", sf_dir, lambda: settle(features(spark, sf_dir), "features"))
    return once(spark, f"attributes {params}", sf_dir, lambda: ml.fit_all_attributes(rows, CFG, params))


def model_point_by_horizon(spark, sf_dir):
    return jobs.scored_metrics(scored_pairs(spark, sf_dir), CFG)


def model_risk(spark, sf_dir):
    """AUC and precision at the top of the risk ranking, on held-out assets."""
    scored = scored_pairs(spark, sf_dir).where(F.col("risk_pct").isNotNull())
    points = scored.groupBy("component", "r1", F.col("risk_pct").alias("score")).agg(
        F.count(F.lit(1)).alias("n"))
    return ranking_quality(points, "score", CFG.risk_threshold)


def model_quantile(spark, sf_dir):
    """How much of the later ratings lies at or below the quantile, from leaves and from class shares.

    A rating k counts as spread over (k - 0.5, k + 0.5], as in the quantile itself.
    """
    scored = scored_pairs(spark, sf_dir)

    def share(name):
        return F.avg(clip(F.col(name) - F.col("r1") + 0.5, 0.0, 1.0)) * 100

    return scored.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"), share("leaf_quantile").alias("leaf_pct_at_or_below"),
        share("class_quantile").alias("class_pct_at_or_below"),
        F.avg(F.col("likely") - F.col("conservative")).alias("mean_margin"),
        F.count_if(F.col("conservative") > F.col("likely")).alias("above_likely"))


def model_calibration(spark, sf_dir):
    """On held-out assets: the share that turned poor beside each calibrated risk."""
    scored = scored_pairs(spark, sf_dir)
    return calibration.reliability(scored, ["component"], "risk_pct", F.col("r1") <= CFG.risk_threshold)


def model_calibration_error(spark, sf_dir):
    """Mean distance of forecast and observed share, before and after calibration."""
    scored = scored_pairs(spark, sf_dir)
    poor = F.col("r1") <= CFG.risk_threshold
    raw = scored.withColumn("raw_pct", calibration.score_bin(F.col("risk_raw_pct")) + F.lit(0.5))
    tables = [calibration.calibration_error(calibration.reliability(raw, ["component"], name, poor), ["component"])
              .withColumn("kind", F.lit(kind)) for kind, name in (("raw", "raw_pct"), ("calibrated", "risk_pct"))]
    return tables[0].unionByName(tables[1])


def model_checks(spark, sf_dir):
    """Training and held-out pairs per component, and how many forecasts break a rule."""
    pairs, scored = trained(spark, sf_dir)[0], scored_pairs(spark, sf_dir)
    held_out = F.col(calibration.SIDE) == "test"
    sides = pairs.groupBy("component").agg(F.count_if(held_out).alias("n_held_out"), F.count_if(~held_out).alias("n_training"))

    def outside(name, top):
        return F.count_if(~F.coalesce(F.col(name).between(0, top), F.lit(False))).alias(f"{name}_outside")

    broken = scored.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_scored"), outside("likely", 9), outside("conservative", 9),
        F.count_if(~F.coalesce(F.col("risk_pct"), F.lit(0.0)).between(0, 100)).alias("risk_pct_outside"),
        F.count_if(F.col("conservative") > F.col("likely")).alias("above_likely"),
        F.count_if(~is_test_asset(CFG)).alias("leaks"))
    return sides.join(broken, "component")


CHECKS_SQL = sql(f"""SELECT component, n_held_out, n_training, n_held_out AS n_scored, 0::BIGINT AS likely_outside,
  0::BIGINT AS conservative_outside, 0::BIGINT AS risk_pct_outside, 0::BIGINT AS above_likely, 0::BIGINT AS leaks
FROM (SELECT component, count(*) FILTER ({is_test()}) AS n_held_out, count(*) FILTER (NOT {is_test()}) AS n_training
      FROM pairs GROUP BY component) WHERE n_training >= {CFG.min_pairs} AND n_held_out > 0""", "long")


def grid_checks(spark, sf_dir):
    """Rows of the model grid per component and anchor, and how many break a rule."""
    rows = model_grid(spark, sf_dir)
    carried = F.col("horizon") <= CFG.hybrid_years
    return rows.groupBy("component", "horizon").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(carried & ~F.col("likely").eqNullSafe(F.col("r0"))).alias("not_carried"),
        F.count_if(~F.coalesce(F.col("likely").between(0, 9), F.lit(False))).alias("outside"),
        F.count_if(F.col("conservative") > F.col("likely")).alias("above_likely"))


GRID_CHECKS_SQL = sql(f"""SELECT component, h::DOUBLE AS horizon, count(*) AS n, 0::BIGINT AS not_carried,
  0::BIGINT AS outside, 0::BIGINT AS above_likely
FROM starts CROSS JOIN (VALUES (0), (2), (5), (10), (15), (20)) v(h)
WHERE component IN (SELECT component FROM pairs WHERE NOT {is_test()} GROUP BY component
                    HAVING count(*) >= {CFG.min_pairs})
GROUP BY component, h""", "long")


def _all_methods(spark, sf_dir):
    """The rules and the model on the same held-out pairs, by component and band."""
    rules = rule_benchmark(stratified_events(spark, sf_dir), CFG, src.BANDS, [KIND], STEPS)
    scored = scored_pairs(spark, sf_dir).withColumn("band", horizon_label(F.col("horizon"), src.BANDS))
    usable = F.coalesce(F.col("likely").between(0, 9), F.lit(False))
    model = scored.groupBy("component", "band").agg(
        F.count_if(usable).alias("model_n"), F.avg(F.abs(F.col("likely") - F.col("r1"))).alias("model_mae"))
    return places(rules.join(model, ["component", "band"]), "carry_forward_mae", "age_curve_mae", "markov_mae")


def benchmark_with_model(spark, sf_dir):
    return _all_methods(spark, sf_dir)


def benchmark_with_model_rules(spark, sf_dir):
    """The same table without the learner's own error."""
    return _all_methods(spark, sf_dir).drop("model_mae")


WITH_MODEL_SQL = f"""SELECT component, band, carry_forward_mae, age_curve_mae, markov_mae, n AS model_n
FROM ({BENCHMARK_SQL}) JOIN ({sql(f"SELECT component, {band()} AS band, count(*) AS n FROM pairs WHERE {is_test()} GROUP BY ALL",
                                  "long")}) USING (component, band)"""


def model_watchlist(spark, sf_dir):
    models = trained(spark, sf_dir)[1]
    return plan.watchlist(stored_events(spark, sf_dir), ml.trajectory_scorer(models, CFG), CFG, "deck",
                          SCREEN)


def model_grid(spark, sf_dir):
    models = trained(spark, sf_dir)[1]
    return plan.horizon_grid(start_rows(spark, sf_dir), ml.trajectory_scorer(models, CFG), CFG).select(
        "asset_id", "component", "r0", "horizon", "likely", "conservative", "risk_pct")


def feature_importance(spark, sf_dir):
    return ml.trajectory_importance(trained(spark, sf_dir)[1], spark)


def attributes_only(spark, sf_dir):
    """Held-out measures of both attribute model types at full size, per component and on average."""
    metrics = settle(fitted(spark, sf_dir, FULL)[1], "metrics")
    means = ml.mean_by_type(metrics).withColumn("component", F.lit("all"))
    return metrics.unionByName(means, allowMissingColumns=True)


def attribute_importance(spark, sf_dir):
    return ml.attribute_importance(fitted(spark, sf_dir)[0], spark)


def combined_forecast(spark, sf_dir):
    """Trajectory forecasts for one year, attribute forecasts where an asset has none."""
    bundles = trained(spark, sf_dir)[1]
    models, _ = fitted(spark, sf_dir)
    primary = plan.point_forecast(start_rows(spark, sf_dir), ml.trajectory_scorer(bundles, CFG), CFG, 2010)
    latest = jobs.latest_features(stored_events(spark, sf_dir), None, CFG)
    fallback = ml.attribute_forecast(models, latest, CFG, 2010)
    return plan.combine_forecasts(primary, fallback, ["asset_id", "component"])


QUERIES = {
    "model_checks": (model_checks, CHECKS_SQL),
    "grid_checks": (grid_checks, GRID_CHECKS_SQL),
    "benchmark_with_model": (benchmark_with_model, None),
    "benchmark_with_model_rules": (benchmark_with_model_rules, WITH_MODEL_SQL),
    "model_point_by_horizon": (model_point_by_horizon, None),
    "model_risk": (model_risk, None),
    "model_quantile": (model_quantile, None),
    "model_calibration": (model_calibration, None),
    "model_calibration_error": (model_calibration_error, None),
    "model_watchlist": (model_watchlist, None),
    "model_grid": (model_grid, None),
    "feature_importance": (feature_importance, None),
    "attributes_only": (attributes_only, None),
    "attribute_importance": (attribute_importance, None),
    "combined_forecast": (combined_forecast, None),
}
