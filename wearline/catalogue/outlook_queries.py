"""Registered queries on watch-lists, grids, region summaries and payloads, with rule scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalogue.benchmark_queries import KIND, stratified_events
from wearline.catalogue.panel_queries import COVERED, places, stored_events
from wearline.catalogue.sql import outlook, sql
from wearline.config import Screen
from wearline.operators.enrich import with_coverage
from wearline.plans import jobs
from wearline.plans import outlook as plan
from wearline.plans.benchmark import markov_outlook
from wearline.session import work_path
from wearline.sources import order_panel as src

CFG = src.CFG
# Inspection steps that each far anchor spans in the rule forecasts.
FAR_STEPS = {"5": 1, "10": 2, "15": 3, "20": 4}
SCREEN = Screen(horizon_years=10, current_min=5, current_max=7, poor_threshold=4.2)
SCORE_NAMES = ("likely", "conservative", "risk_pct")


def rule_scorer(spark, sf_dir, steps=None):
    table = markov_outlook(stratified_events(spark, sf_dir), CFG, [KIND], steps or FAR_STEPS)
    return plan.rule_scorer(table, CFG, [KIND], F.col("horizon").cast("int").cast("string"))


def start_rows(spark, sf_dir):
    return with_coverage(plan.starting_points(stored_events(spark, sf_dir), CFG), COVERED)


def grid(spark, sf_dir):
    return plan.horizon_grid(start_rows(spark, sf_dir), rule_scorer(spark, sf_dir), CFG)


def watchlist_rule(spark, sf_dir):
    """Deck watch-list of on-system assets; conservative is the Markov quantile."""
    return plan.watchlist(stored_events(spark, sf_dir), rule_scorer(spark, sf_dir, {"10": 2}), CFG,
                          "deck", SCREEN)


def watchlist_region(spark, sf_dir):
    """The same list for one region and all systems, the worst 25."""
    screen = Screen(horizon_years=10, current_min=4, current_max=8, poor_threshold=5.0,
                    on_system_only=False)
    listed = plan.watchlist(stored_events(spark, sf_dir), rule_scorer(spark, sf_dir, {"10": 2}), CFG,
                            "superstructure", screen, region="3")
    return listed.limit(25)


def _watch_sql(component, lo, hi, threshold, where, tail=""):
    return sql(f"""SELECT asset_id, component, region, year_built, year(event_date)::INT AS last_inspection_year,
  r0 AS current_rating, risk_poor_pct, forecast_likely, forecast_conservative,
  round_even(r0 - forecast_likely, 1) AS predicted_decline
FROM (SELECT st.*, round_even(o.likely, 1) AS forecast_likely,
        round_even(o.conservative, 1) AS forecast_conservative, round_even(o.risk_pct, 0) AS risk_poor_pct
      FROM starts st LEFT JOIN static s USING (asset_id)
      JOIN outlook o ON o.component = st.component AND o.structure_kind = coalesce(s.structure_kind, 'unknown')
        AND o.r0 = st.r0 AND o.band = '10'
      WHERE st.component = '{component}' AND st.r0 BETWEEN {lo} AND {hi} AND {where})
WHERE forecast_conservative <= {threshold}
ORDER BY risk_poor_pct DESC NULLS LAST, forecast_conservative ASC NULLS LAST, asset_id {tail}""",
               "markov", extra=outlook({"10": 2}))


GRID_CTE = outlook(FAR_STEPS) + """,
covered AS (
  SELECT st.*, s.structure_kind,
    CAST(l.adt IS NOT NULL AS INT) + CAST(l.latitude IS NOT NULL AS INT) + CAST(l.longitude IS NOT NULL AS INT)
    + CAST(s.structure_kind IS NOT NULL AS INT) + CAST(s.num_spans_main IS NOT NULL AS INT)
    + CAST(s.wearing_surface IS NOT NULL AS INT) + CAST(l.year_reconstructed IS NOT NULL AS INT)
      AS feat_present
  FROM starts st JOIN latest l USING (asset_id) LEFT JOIN static s USING (asset_id)),
grid AS (
  SELECT c.*, CAST(h AS DOUBLE) AS horizon, r0 AS likely, r0 AS conservative,
    CAST(NULL AS DOUBLE) AS risk_pct FROM covered c CROSS JOIN (VALUES (0), (2)) v(h)
  UNION ALL
  SELECT c.*, CAST(h AS DOUBLE), round_even(o.likely, 1), round_even(o.conservative, 1),
    round_even(o.risk_pct, 0)
  FROM covered c CROSS JOIN (VALUES (5), (10), (15), (20)) v(h)
  LEFT JOIN outlook o ON o.component = c.component AND o.structure_kind = coalesce(c.structure_kind, 'unknown')
    AND o.r0 = c.r0 AND o.band = CAST(h AS VARCHAR))"""


def horizon_grid(spark, sf_dir):
    return grid(spark, sf_dir).select("asset_id", "component", "r0", "horizon", *SCORE_NAMES)


GRID_SQL = sql("SELECT asset_id, component, r0, horizon, likely, conservative, risk_pct FROM grid",
               "markov", extra=GRID_CTE)


def horizon_grid_interp(spark, sf_dir):
    """Forecasts between and on the anchors, with route, band and flags."""
    maps = plan.horizon_maps(grid(spark, sf_dir), ["asset_id", "component", "r0"])
    years = F.explode(F.array(*[F.lit(float(y)) for y in (0, 3, 7, 10, 18)]))
    out = plan.read_maps(maps.withColumn("asked", years), CFG, F.col("asked")).select(
        "asset_id", "component", "years", "likely_at", "conservative_at", "risk_at", "route",
        "band_at", "decline_flag", "risk_flag")
    return places(out, "likely_at", "conservative_at", "risk_at")


def _interp_sql():
    def value(name, y, lo, hi):
        at = lambda h: f"max({name}) FILTER (horizon = {h})"
        if lo == hi:
            return at(lo)
        a, b = at(lo), at(hi)
        return f"coalesce({a} + ({b} - {a}) * {float(y - lo)} / {float(hi - lo)}, {a}, {b})"

    parts = []
    for y, lo, hi, route in ((0, 0, 0, "observed"), (3, 2, 5, "carry"), (7, 5, 10, "interpolated"),
                             (10, 10, 10, "model"), (18, 15, 20, "interpolated")):
        risk = value("risk_pct", y, lo, hi) if y > 3 else "CAST(NULL AS DOUBLE)"
        parts.append(f"""SELECT asset_id, component, r0, CAST({y} AS DOUBLE) AS years,
  CAST({value('likely', y, lo, hi)} AS DOUBLE) AS likely_at,
  CAST({value('conservative', y, lo, hi)} AS DOUBLE) AS conservative_at,
  CAST({risk} AS DOUBLE) AS risk_at, '{route}' AS route FROM grid GROUP BY asset_id, component, r0""")
    return sql(f"""SELECT asset_id, component, years, round_even(likely_at, 6) AS likely_at,
  round_even(conservative_at, 6) AS conservative_at, round_even(risk_at, 6) AS risk_at, route,
  CASE WHEN likely_at IS NULL THEN 'not rated' WHEN likely_at >= 7 THEN 'good'
       WHEN likely_at >= 5 THEN 'fair' ELSE 'poor' END AS band_at,
  CASE WHEN likely_at - r0 <= -1 THEN 'severe' WHEN likely_at - r0 < -0.05 THEN 'mild' ELSE 'none' END
    AS decline_flag,
  CASE WHEN risk_at >= 50 THEN 'high' WHEN risk_at >= 25 THEN 'raised' ELSE 'none' END AS risk_flag
FROM ({' UNION ALL '.join(parts)})""", "markov", extra=GRID_CTE)


def region_pack_summary(spark, sf_dir):
    """Per region and in total: assets, trending poor, coverage and system split."""
    out = plan.region_summary(grid(spark, sf_dir), CFG, SCREEN)
    return places(out, "poor_pct", "coverage_pct")


REGIONS_BODY = f"""SELECT region, count(*) AS assets, count(*) FILTER (poor) AS poor,
  round_even(count(*) FILTER (poor) * 100.0::DOUBLE / count(*), 6) AS poor_pct,
  round_even(avg(share) * 100, 6) AS coverage_pct, count(*) FILTER (is_on) AS on_assets,
  count(*) FILTER (NOT is_on) AS off_assets
FROM (SELECT asset_id, coalesce(region, 'unknown') AS region, max(feat_present / CAST({len(COVERED)} AS DOUBLE)) AS share,
        bool_or(coalesce(on_system = 'ON', false)) AS is_on,
        bool_or(coalesce(horizon = 10 AND r0 BETWEEN 5 AND 7 AND conservative <= 4.2, false)) AS poor
      FROM grid GROUP BY asset_id, coalesce(region, 'unknown'))
GROUP BY ROLLUP (region)"""
REGIONS_SQL = sql(REGIONS_BODY, "markov", extra=GRID_CTE)


def coverage_confound(spark, sf_dir):
    out = plan.coverage_confound(plan.region_summary(grid(spark, sf_dir), CFG, SCREEN))
    return places(out, "correlation", "lowest_pct", "highest_pct", to=5)


CONFOUND_SQL = sql("""SELECT regions, round_even(c, 5) AS correlation, round_even(lowest, 5) AS lowest_pct,
  round_even(highest, 5) AS highest_pct,
  CASE WHEN regions < 8 THEN 'too few' WHEN c <= -0.5 THEN 'confounded' ELSE 'comparable' END AS verdict
FROM (SELECT count(*) AS regions, corr(coverage_pct, poor_pct) AS c, min(coverage_pct) AS lowest,
        max(coverage_pct) AS highest FROM regions WHERE region <> 'unknown')""", "markov",
                   extra=GRID_CTE + f", regions AS ({REGIONS_BODY.replace(', 6)', ', 12)')})")


def point_forecast(spark, sf_dir):
    """The hybrid rule for one calendar year over all assets."""
    scorer = rule_scorer(spark, sf_dir, {str(y): max(1, y // 2) for y in range(1, 11)})
    return plan.point_forecast(start_rows(spark, sf_dir), scorer, CFG, 2004).withColumn(
        "last_inspection_year", F.col("last_inspection_year").cast("bigint"))


POINT_SQL = sql("""SELECT st.asset_id, st.component,
  CASE WHEN y <= 0 THEN 'current' WHEN y <= 3 THEN 'carry_forward' ELSE 'model' END AS method,
  round_even(CASE WHEN y > 3 THEN o.likely ELSE st.r0 END, 1) AS prediction,
  round_even(CASE WHEN y > 3 THEN o.conservative ELSE st.r0 END, 1) AS prediction_conservative,
  round_even(CASE WHEN y > 3 THEN o.risk_pct END, 0) AS risk_poor_pct, st.r0 AS current_rating,
  year(event_date) AS last_inspection_year, CAST(y AS DOUBLE) AS horizon_years
FROM (SELECT *, 2004 - year(event_date) AS y FROM starts) st LEFT JOIN static s USING (asset_id)
LEFT JOIN outlook o ON o.component = st.component AND o.structure_kind = coalesce(s.structure_kind, 'unknown')
  AND o.r0 = st.r0 AND o.band = CAST(y AS VARCHAR)""", "markov",
                extra=outlook({str(y): max(1, y // 2) for y in range(1, 11)}))


def published_watchlist(spark, sf_dir):
    """The published deck list of on-system assets, read back with its ranks."""
    root = work_path(spark, "published")
    path = jobs.publish_watchlist(stored_events(spark, sf_dir), None, rule_scorer(spark, sf_dir, {"10": 2}),
                                  CFG, "deck", root, screen=SCREEN)
    return spark.read.parquet(path).withColumn("region", F.col("region").cast("string"))


WATCH_SQL = _watch_sql("deck", 5, 7, 4.2, "upper(on_system) LIKE 'ON%'")
RANKED_SQL = f"""SELECT *, rank() OVER (ORDER BY risk_poor_pct DESC NULLS LAST,
  forecast_conservative ASC NULLS LAST) AS rank FROM ({WATCH_SQL})"""


def published_regions(spark, sf_dir):
    """The published index of regions, with the number of assets found in each region's pack."""
    paths = jobs.publish_regions(grid(spark, sf_dir), CFG, work_path(spark, "published"), screen=SCREEN)
    packs = spark.read.parquet(paths["packs"]).groupBy("region").agg(
        F.countDistinct("id").alias("pack_assets"))
    index = spark.read.parquet(paths["index"])
    return places(index.join(packs, "region", "left"), "poor_pct", "coverage_pct")


PUBLISHED_SQL = sql(f"""SELECT *, CASE WHEN region IS NOT NULL THEN assets END AS pack_assets
FROM ({REGIONS_BODY})""", "markov", extra=GRID_CTE)


def forecast_payload(spark, sf_dir):
    """One JSON document per asset with its nested forecasts."""
    rows = plan.asset_payload(grid(spark, sf_dir), CFG, ("adt", "structure_length", "structure_kind"))
    return rows.select("id", F.to_json(F.struct(*rows.columns)).alias("payload"))


QUERIES = {
    "watchlist_rule": (watchlist_rule, WATCH_SQL),
    "published_watchlist": (published_watchlist, RANKED_SQL),
    "published_regions": (published_regions, PUBLISHED_SQL),
    "watchlist_region": (watchlist_region,
                         _watch_sql("superstructure", 4, 8, 5.0, "region = '3'", "LIMIT 25")),
    "horizon_grid": (horizon_grid, GRID_SQL),
    "horizon_grid_interp": (horizon_grid_interp, _interp_sql()),
    "region_pack_summary": (region_pack_summary, REGIONS_SQL),
    "coverage_confound": (coverage_confound, CONFOUND_SQL),
    "point_forecast": (point_forecast, POINT_SQL),
    "forecast_payload": (forecast_payload, None),
}
