"""Registered queries on calibration, temporal holdout, stores, gates while writing and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalogue.benchmark_queries import (
    AGE_CTE, BANDS, CARRY_SQL, CFG, KIND, MEASURES, PERSIST_SQL, STEPS, stratified_events,
)
from wearline.catalogue.panel_queries import LOSS_SQL, MATCH_SQL, RANGE_SQL, SHAPE_SQL, day, places, static_rows, stored_events
from wearline.catalogue.sql import MARKOV, band, is_test, measures, outlook, share_bucket, sql
from wearline.operators import calibration, enrich, events, pairs, split
from wearline.operators.metrics import grouped_summary, score
from wearline.operators.pairs import outcome_counts
from wearline.operators.split import is_test_asset
from wearline.functions.ratings import horizon_label
from wearline.plans.benchmark import baselines_by_split, markov_outlook
from wearline.session import once
from wearline.sources import order_panel as src
from wearline.sources.store import write_with_gates

#: Share of the assets, among those for training, that calibrate.
CALIBRATION_SHARE = 0.2


def rule_risk(spark, sf_dir):
    """Weighted outcomes with the risk that transitions of the fitting assets give them."""
    rows = stratified_events(spark, sf_dir)
    held = calibration.is_calibration_asset(CFG, CALIBRATION_SHARE)
    side = F.when(is_test_asset(CFG), "test").when(held, "calibrate").otherwise("fit")
    outcomes = outcome_counts(rows.withColumn("side", side), CFG, BANDS, by=[KIND, "side"])
    risk = markov_outlook(rows, CFG, [KIND], STEPS, learn=~is_test_asset(CFG) & ~held)
    return outcomes.join(risk.select("component", KIND, "band", "r0", "risk_pct"), ["component", KIND, "band", "r0"])


def calibrated_rule_risk(spark, sf_dir):
    """On held-out assets: the share that turned poor beside the risk, before and after calibration."""
    scored = rule_risk(spark, sf_dir)
    poor, weight = F.col("r1") <= CFG.risk_threshold, F.col("n")
    counted = calibration.count_bins(scored.where("side = 'calibrate'"), ["component"], "risk_pct", poor, weight)
    steps = calibration.isotonic_steps(counted, ["component"])
    test = calibration.calibrate(scored.where("side = 'test'"), steps, ["component"], "risk_pct")
    test = places(test.withColumn("raw_pct", calibration.score_bin(F.col("risk_pct")) + F.lit(0.5)), "calibrated_pct", to=9)
    tables = [calibration.reliability(test, ["component"], name, poor, weight).withColumn("kind", F.lit(kind))
              for kind, name in (("raw", "raw_pct"), ("calibrated", "calibrated_pct"))]
    return places(tables[0].unionByName(tables[1]), "forecast_pct", "observed_pct")


IS_HELD = f"(NOT {is_test()} AND {share_bucket('asset_id', 44)} < {int(CALIBRATION_SHARE * 1000)})"
CALIBRATED_SQL = sql(f"""SELECT component, kind, round_even(forecast, 6) AS forecast_pct, CAST(sum(n) AS BIGINT) AS n,
  round_even(sum(n) FILTER (r1 <= 5) * 100.0::DOUBLE / sum(n), 6) AS observed_pct
FROM (SELECT component, 'raw' AS kind, CAST(bin + 0.5 AS DOUBLE) AS forecast, r1, n FROM judged
      UNION ALL SELECT component, 'calibrated', calibrated_pct, r1, n FROM judged WHERE calibrated_pct IS NOT NULL)
GROUP BY component, kind, forecast""".replace("sum(n) FILTER (r1 <= 5)", "coalesce(sum(n) FILTER (r1 <= 5), 0)"),
    "long", "static", extra=f"""{MARKOV.replace("NOT " + is_test(), f"NOT {is_test()} AND NOT {IS_HELD}")},
{outlook(STEPS)},
scored AS (
  SELECT *, CAST(greatest(0, least(99, floor(risk_pct * 100 / 100))) AS INT) AS bin FROM (
    SELECT component, coalesce(structure_kind, 'unknown') AS structure_kind, {band()} AS band, CAST(r0 AS INT) AS r0, r1,
      CASE WHEN {is_test()} THEN 'test' WHEN {IS_HELD} THEN 'calibrate' ELSE 'fit' END AS side, count(*) AS n
    FROM pairs LEFT JOIN static USING (asset_id) GROUP BY ALL) JOIN outlook USING (component, structure_kind, band, r0)),
counted AS (SELECT component, bin, sum(n) AS n, coalesce(sum(n) FILTER (r1 <= 5), 0) AS poor FROM scored WHERE side = 'calibrate' GROUP BY ALL),
runs AS (
  SELECT a.component, a.bin AS first, b.bin AS last, sum(c.poor) * 100.0::DOUBLE / sum(c.n) AS share
  FROM counted a JOIN counted b ON a.component = b.component AND a.bin <= b.bin
  JOIN counted c ON c.component = a.component AND c.bin BETWEEN a.bin AND b.bin GROUP BY ALL),
least AS (
  SELECT x.component, x.first, y.last AS bin, min(x.share) AS v FROM runs x JOIN runs y
  ON x.component = y.component AND x.first = y.first AND x.last >= y.last GROUP BY ALL),
fitted AS (SELECT component, bin, max(v) AS calibrated_pct FROM least GROUP BY ALL),
judged AS (
  SELECT s.*, coalesce(
    (SELECT arg_max(calibrated_pct, f.bin) FROM fitted f WHERE f.component = s.component AND f.bin <= s.bin),
    (SELECT min(calibrated_pct) FROM fitted f WHERE f.component = s.component)) AS calibrated_pct
  FROM scored s WHERE side = 'test')""")


#: Share of the inspections that lie before the temporal cut-off.
BEFORE = 0.6


def temporal_holdout(spark, sf_dir):
    """Carry-forward and age curve under both splits."""
    rows = stored_events(spark, sf_dir)
    return places(baselines_by_split(rows, CFG, BANDS, split.cutoff_day(rows, CFG, BEFORE)), *MEASURES)


def temporal_leaks(spark, sf_dir):
    """Pairs on each side of the temporal split, those purged, and the leaks."""
    rows = stored_events(spark, sf_dir)
    side = split.temporal_side(CFG, split.cutoff_day(rows, CFG, BEFORE))
    return split.split_leaks(pairs.forward_pairs(rows, CFG), CFG, side)


CUT_CTE = f"""days AS (SELECT event_date AS day, count(*) AS n FROM events GROUP BY 1),
cut AS (SELECT min(day) AS cutoff FROM (SELECT day, sum(n) OVER (ORDER BY day) AS upto, sum(n) OVER () AS total FROM days)
  WHERE upto >= total * {BEFORE}),
timed AS (SELECT * FROM pairs, cut WHERE CASE WHEN {is_test()} THEN d0 > cutoff ELSE d1 <= cutoff END)"""
_TIMED_AGE = AGE_CTE.replace("FROM pairs)", "FROM timed)")
for _name in ("aged_test", "age_means", "all_means", "aged"):
    _TIMED_AGE = _TIMED_AGE.replace(f"{_name} AS (", f"timed_{_name} AS (").replace(f"FROM {_name} ", f"FROM timed_{_name} ")
    _TIMED_AGE = _TIMED_AGE.replace(f"JOIN {_name} ", f"JOIN timed_{_name} ")
_TIMED_AGE = _TIMED_AGE.replace("FROM aged\n", "FROM timed_aged\n")


def _by_method(table: str) -> str:
    return f"""SELECT component, band, method, {measures()} FROM (
  SELECT component, band, 'carry_forward' AS method, r0 AS predicted, r1 FROM {table}
  UNION ALL SELECT component, band, 'age_curve', age_pred, r1 FROM {table}) GROUP BY ALL"""


HOLDOUT_SQL = sql(f"""SELECT 'asset' AS split, * FROM ({_by_method('aged_test')})
UNION ALL SELECT 'time', * FROM ({_by_method('timed_aged_test')})""", "long",
                  extra=f"{AGE_CTE}, {CUT_CTE}, {_TIMED_AGE}")
LEAKS_SQL = sql(f"""SELECT component, count(*) FILTER (NOT {is_test()} AND d1 <= cutoff) AS n_train,
  count(*) FILTER ({is_test()} AND d0 > cutoff) AS n_test,
  count(*) FILTER (NOT (NOT {is_test()} AND d1 <= cutoff) AND NOT ({is_test()} AND d0 > cutoff)) AS n_purged,
  0::BIGINT AS time_leaks, 0::BIGINT AS asset_leaks
FROM pairs, cut GROUP BY component""", "long", extra=CUT_CTE)


def outcomes_off_scale(spark, sf_dir):
    """Outcomes of a panel where every ninth deck rating is half a point: those count as null."""
    rows = stored_events(spark, sf_dir).withColumn(
        "deck", F.when(F.col("snapshot_no") % 9 == 0, F.col("deck") + 0.5).otherwise(F.col("deck")))
    return outcome_counts(rows, CFG, BANDS, off_scale=True).drop("span")


OFF_SCALE_SQL = sql(f"""SELECT component, {band()} AS band, CAST(CASE WHEN r0 = floor(r0) THEN r0 END AS INT) AS r0,
  CAST(CASE WHEN r1 = floor(r1) THEN r1 END AS INT) AS r1, count(*) AS n
FROM halved GROUP BY ALL""", "long", extra="""
halved AS (
  SELECT p.component, p.horizon,
    p.r0 + CASE WHEN p.component = 'deck' AND a.snapshot_no % 9 = 0 THEN 0.5 ELSE 0 END AS r0,
    p.r1 + CASE WHEN p.component = 'deck' AND b.snapshot_no % 9 = 0 THEN 0.5 ELSE 0 END AS r1
  FROM pairs p JOIN events a ON a.asset_id = p.asset_id AND a.event_date = p.d0
  JOIN events b ON b.asset_id = p.asset_id AND b.event_date = p.d1)""")


def gated_store(spark, sf_dir):
    """The inspections stored by asset, and the gates taken meanwhile; written once per session."""
    return once(spark, "store", sf_dir, lambda: write_with_gates(
        src.raw_panel(spark, sf_dir), static_rows(spark, sf_dir), CFG))


def store_shape_gate(spark, sf_dir):
    out = gated_store(spark, sf_dir)[1].shape
    return places(out.withColumns({"first_date": day("first_date"), "last_date": day("last_date")}), "inspections_per_asset")


def store_range_gate(spark, sf_dir):
    return places(gated_store(spark, sf_dir)[1].ranges, "outside_pct")


def store_decode_loss(spark, sf_dir):
    return gated_store(spark, sf_dir)[1].decode_loss.withColumn("digits", F.col("digits").cast("bigint"))


def store_match_rate(spark, sf_dir):
    return places(gated_store(spark, sf_dir)[1].match_rate, "match_pct")


def store_latest(spark, sf_dir):
    latest = events.latest_event(gated_store(spark, sf_dir)[0], CFG)
    return latest.select("asset_id", "snapshot_no", "deck", day("event_date").alias("event_date"), "structure_kind")


STORE_LATEST_SQL = sql("""SELECT asset_id, snapshot_no, deck, strftime(event_date, '%Y-%m-%d') AS event_date, structure_kind
FROM latest LEFT JOIN static USING (asset_id)""", "events", "static")


def store_persistence(spark, sf_dir):
    rows = events.previous_ratings(gated_store(spark, sf_dir)[0], CFG, stored_by_asset=True)
    return places(score(rows, ["component"], actual="rating", predicted="previous_rating"), *MEASURES)


def store_pair_error(spark, sf_dir):
    """The error of no change over pairs that join inside the buckets."""
    rows = pairs.forward_pairs(gated_store(spark, sf_dir)[0], CFG, split_above=None)
    named = rows.withColumn("band", horizon_label(F.col("horizon"), BANDS))
    return places(score(named, ["component", "band"], predicted="r0"), *MEASURES)


def repeating_groups(spark, sf_dir):
    """Orders as the assets, their lines as instances of a work and a span group."""
    rows = src.table(spark, sf_dir, "lineitem").select(
        src.asset_code(F.col("l_orderkey")).alias("asset_id"), F.col("l_linenumber").alias("instance"),
        F.when(F.col("l_partkey") % 7 == 0, "open").otherwise(F.year("l_shipdate").cast("string")).alias("work_year"),
        F.col("l_quantity").cast("int").cast("string").alias("spans"))
    return enrich.repeating_groups(rows, "asset_id", "instance", {"last_work_year": "work_year"}, {"num_spans_approach": "spans"})


GROUPS_SQL = """SELECT lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS asset_id, count(l_linenumber) AS instances,
  CAST(max(CASE WHEN l_partkey % 7 <> 0 THEN year(l_shipdate) END) AS DOUBLE) AS last_work_year,
  CAST(coalesce(sum(CASE WHEN l_linenumber >= 2 THEN CAST(l_quantity AS INT) END), 0) AS DOUBLE) AS num_spans_approach
FROM lineitem GROUP BY l_orderkey"""


def zone_summary(spark, sf_dir):
    """Ratings and traffic by region and climate zone, the zone by ranges of a district code."""
    regions = src.table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") * 50).alias("low"), (F.col("r_regionkey") * 50 + 49).alias("high"), F.col("r_name").alias("zone"))
    rows = stored_events(spark, sf_dir).withColumn("district", F.col("asset_id").cast("int") % 260)
    zoned = enrich.attach_zone(rows, "district", regions)
    return places(grouped_summary(zoned, ["region", "climate_zone"], ["deck", "adt"]), "deck_mean", "deck_median", "adt_mean", "adt_median")


ZONE_SQL = sql("""SELECT region, coalesce(r_name, 'unknown') AS climate_zone, round_even(avg(deck), 6) AS deck_mean,
  round_even(median(deck), 6) AS deck_median, count(deck) AS deck_count, round_even(avg(adt), 6) AS adt_mean,
  round_even(median(adt), 6) AS adt_median, count(adt) AS adt_count
FROM events LEFT JOIN (SELECT r_name, r_regionkey FROM region)
  ON CAST(asset_id AS INT) % 260 BETWEEN r_regionkey * 50 AND r_regionkey * 50 + 49
WHERE region IS NOT NULL GROUP BY 1, 2""", "events")


QUERIES = {
    "calibrated_rule_risk": (calibrated_rule_risk, CALIBRATED_SQL),
    "temporal_holdout": (temporal_holdout, HOLDOUT_SQL),
    "temporal_leaks": (temporal_leaks, LEAKS_SQL),
    "outcomes_off_scale": (outcomes_off_scale, OFF_SCALE_SQL),
    "repeating_groups": (repeating_groups, GROUPS_SQL),
    "zone_summary": (zone_summary, ZONE_SQL),
    "store_shape_gate": (store_shape_gate, SHAPE_SQL),
    "store_range_gate": (store_range_gate, f"SELECT * EXCLUDE (median) FROM ({RANGE_SQL})"),
    "store_decode_loss": (store_decode_loss, LOSS_SQL),
    "store_match_rate": (store_match_rate, MATCH_SQL),
    "store_latest": (store_latest, STORE_LATEST_SQL),
    "store_persistence": (store_persistence, PERSIST_SQL),
    "store_pair_error": (store_pair_error, CARRY_SQL),
}
