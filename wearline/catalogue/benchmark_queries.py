"""Registered queries on error measures, baselines, transitions and exhibits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.catalogue.panel_queries import panel, places, stored_events
from wearline.catalogue.sql import COMPONENTS, DIRECT_PAIRS, band, clip, is_test, measures, outlook, sql
from wearline.functions.dates import age_on
from wearline.functions.numbers import half_even
from wearline.config import UNKNOWN
from wearline.operators import events, pairs
from wearline.operators.markov import matrix_powers, transition_counts, transition_table
from wearline.operators.metrics import best_gain as gain
from wearline.operators.metrics import by_method, group_mean, guarded_corr, score
from wearline.operators.metrics import weighted_overall as overall
from wearline.operators.split import is_test_asset
from wearline.plans import benchmark as plan
from wearline.sources import order_panel as src

CFG = src.CFG
BANDS = src.BANDS
STEPS = {"1": 1, "2": 2, "3": 3, "4": 4}
#: An age curve needs this many rated rows of known age.
MIN_ROWS = 10
MEASURES = ("mae", "rmse", "r2", "within_1")
KIND = "structure_kind"


def stratified_events(spark, sf_dir):
    """Events with the attribute the transitions are stratified by; without one it is "unknown"."""
    return stored_events(spark, sf_dir).withColumn(KIND, F.coalesce(KIND, F.lit(UNKNOWN)))


def carry_forward_by_horizon(spark, sf_dir):
    return places(plan.carry_forward_by_band(stored_events(spark, sf_dir), CFG, BANDS), *MEASURES)


CARRY_SQL = sql(f"SELECT component, {band()} AS band, {measures()} "
                "FROM (SELECT *, r0 AS predicted FROM pairs) GROUP BY ALL", "long")


def baseline_by_horizon(spark, sf_dir):
    return places(plan.baselines_by_band(stored_events(spark, sf_dir), CFG, BANDS), *MEASURES)


AGE_CTE = f"""aged AS (
  SELECT *, {band()} AS band, {is_test()} AS held_out,
    CAST(round_even(age_t0 + horizon, 0) AS INT) AS age_bin FROM pairs),
age_means AS (SELECT component, age_bin, avg(r1) AS m FROM aged
  WHERE NOT held_out AND age_bin IS NOT NULL GROUP BY ALL),
all_means AS (SELECT component, avg(r1) AS g FROM aged WHERE NOT held_out GROUP BY ALL),
aged_test AS (
  SELECT a.*, coalesce(m, g) AS age_pred FROM aged a
  LEFT JOIN age_means USING (component, age_bin) LEFT JOIN all_means USING (component)
  WHERE held_out)"""
BASELINE_SQL = sql(f"""SELECT component, band, method, {measures()} FROM (
  SELECT component, band, 'carry_forward' AS method, r0 AS predicted, r1 FROM aged_test
  UNION ALL SELECT component, band, 'age_curve', age_pred, r1 FROM aged_test) GROUP BY ALL""",
                   "long", extra=AGE_CTE)


def persistence_baseline(spark, sf_dir):
    rows = events.previous_ratings(stored_events(spark, sf_dir), CFG)
    return places(score(rows, ["component"], actual="rating", predicted="previous_rating"), *MEASURES)


PERSIST_SQL = sql(f"""SELECT component, {measures('rating')} FROM (
  SELECT *, lag(rating) OVER (PARTITION BY asset_id, component ORDER BY event_date) AS predicted
  FROM long) WHERE predicted IS NOT NULL GROUP BY component""", "long")


def age_curve_baseline(spark, sf_dir):
    """Rating from age alone, judged on held-out assets; fitted on counts per age and rating."""
    rows = events.by_component(stored_events(spark, sf_dir), CFG)
    rows = rows.withColumns({
        "age_bin": half_even(age_on(F.col("event_date"), F.col("year_built"))).cast("int"),
        "is_test": is_test_asset(CFG)}).where(F.col("age_bin").isNotNull())
    counts = rows.groupBy("component", "age_bin", "is_test", "rating").agg(
        F.count(F.lit(1)).alias("n"))
    curve = group_mean("rating", "n", ~F.col("is_test"), ["component", "age_bin"], ["component"])
    enough = F.sum("n").over(Window.partitionBy("component")) >= MIN_ROWS
    counts = counts.withColumn("_enough", enough).where("_enough").drop("_enough")
    held_out = counts.withColumn("predicted", curve).where("is_test")
    return places(score(held_out, ["component"], actual="rating", weight="n"), *MEASURES)


AGE_CURVE_SQL = sql(f"""SELECT component, {measures('rating')} FROM (
  SELECT t.component, t.rating, coalesce(m, g) AS predicted
  FROM (SELECT * FROM ages WHERE held_out) t
  LEFT JOIN (SELECT component, age_bin, avg(rating) AS m FROM ages WHERE NOT held_out GROUP BY ALL)
    USING (component, age_bin)
  LEFT JOIN (SELECT component, avg(rating) AS g FROM ages WHERE NOT held_out GROUP BY ALL)
    USING (component)) GROUP BY component""", "long", extra=f"""ages AS (
  SELECT component, rating, CAST({clip('(year(event_date) - year_built)')} AS INT) AS age_bin,
    {is_test()} AS held_out FROM long WHERE year_built IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY component) >= 10)""")


def metric_suite(spark, sf_dir):
    """All error measures of two rule predictors, and their average by predictor."""
    rows = events.previous_ratings(stored_events(spark, sf_dir), CFG)
    scored = by_method(rows, {"persistence": F.col("previous_rating"),
                              "half_step": F.col("previous_rating") * 1.5 - 2})
    table = score(scored, ["component", "method"], actual="rating", predicted="predicted",
                  steps=(0.5, 1.0, 2.0))
    means = table.groupBy("method").agg(
        F.lit("all").alias("component"), F.sum("n").alias("n"),
        *[F.avg(m).alias(m) for m in ("mae", "rmse", "r2", "within_0_5", "within_1", "within_2")])
    return places(table.unionByName(means), "mae", "rmse", "r2", "within_0_5", "within_1", "within_2",
                  to=5)


SUITE_MEASURES = measures("rating", steps=(0.5, 1.0, 2.0)).replace(", 6)", ", 12)")
SUITE_NAMES = ("mae", "rmse", "r2", "within_0_5", "within_1", "within_2")
SUITE_SQL = sql(f"""SELECT component, method, n,
  {', '.join(f'round_even({m}, 5) AS {m}' for m in SUITE_NAMES)} FROM (
  SELECT * FROM suite UNION ALL
  SELECT 'all' AS component, method, CAST(sum(n) AS BIGINT) AS n,
    {', '.join(f'avg({m}) AS {m}' for m in SUITE_NAMES)} FROM suite GROUP BY method)""",
                "long", extra=f"""stepped AS (
  SELECT component, rating, lag(rating) OVER (PARTITION BY asset_id, component ORDER BY event_date)
    AS previous_rating FROM long),
suite AS (SELECT component, method, {SUITE_MEASURES} FROM (
  SELECT component, rating, 'persistence' AS method, previous_rating AS predicted FROM stepped
  UNION ALL SELECT component, rating, 'half_step', previous_rating * 1.5 - 2 FROM stepped)
  WHERE predicted IS NOT NULL GROUP BY component, method)""")


def markov_transitions(spark, sf_dir):
    keys = ["component", KIND]
    source = stratified_events(spark, sf_dir).where(~is_test_asset(CFG))
    return places(transition_table(transition_counts(source, CFG, keys), keys), "p")


TRANSITIONS_SQL = sql("""SELECT component, structure_kind, f AS from_rating, t AS to_rating, n,
  round_even(p, 6) AS p FROM seen JOIN train_steps USING (component, structure_kind, f, t)""", "markov")


def markov_kstep(spark, sf_dir):
    keys = ["component", KIND]
    table = plan.stratified_transitions(stratified_events(spark, sf_dir), CFG, [KIND])
    powers = matrix_powers(table, keys, [1, 2, 4])
    long = powers.select(*keys, "k", "from_rating", F.posexplode("p").alias("to_rating", "p"))
    return places(long, "p")


KSTEP_SQL = sql("SELECT component, structure_kind, k, from_rating, to_rating, round_even(p, 6) AS p FROM ("
                + " UNION ALL ".join(f"SELECT component, structure_kind, {k} AS k, f AS from_rating, "
                                     f"t AS to_rating, p FROM m{k}" for k in (1, 2, 4)) + ")", "markov")


def _judged(spark, sf_dir):
    """Held-out outcomes next to the Markov outlook of their band."""
    rows = stratified_events(spark, sf_dir)
    outcomes = plan.outcome_table(rows, CFG, BANDS, by=[KIND]).where("is_test")
    return outcomes.join(plan.markov_outlook(rows, CFG, [KIND], STEPS),
                         ["component", KIND, "band", "r0"])


JUDGED_CTE = outlook(STEPS) + f""",
judged AS (
  SELECT p.asset_id, p.component, p.band, p.d0, p.d1, p.horizon, p.r0, p.r1,
    coalesce(s.structure_kind, 'unknown') AS structure_kind,
    o.likely, o.conservative, o.risk_pct
  FROM (SELECT *, {band()} AS band FROM pairs WHERE {is_test()}) p
  LEFT JOIN static s USING (asset_id)
  JOIN outlook o ON o.component = p.component AND o.structure_kind = coalesce(s.structure_kind, 'unknown')
    AND o.band = p.band AND o.r0 = p.r0)"""


def markov_outlook(spark, sf_dir):
    rows = plan.markov_outlook(stratified_events(spark, sf_dir), CFG, [KIND], STEPS)
    return places(rows, "likely", "conservative", "risk_pct")


OUTLOOK_SQL = sql("""SELECT component, structure_kind, band, r0, round_even(likely, 6) AS likely,
  round_even(conservative, 6) AS conservative, round_even(risk_pct, 6) AS risk_pct FROM outlook""",
                  "markov", extra=outlook(STEPS))


def benchmark_by_method(spark, sf_dir):
    out = plan.benchmark(stratified_events(spark, sf_dir), CFG, BANDS, [KIND], STEPS)
    return places(out, "carry_forward_mae", "age_curve_mae", "markov_mae")


BENCHMARK_SQL = sql("""SELECT j.component, j.band,
  round_even(avg(abs(j.r1 - j.r0)), 6) AS carry_forward_mae,
  round_even(avg(abs(j.r1 - coalesce(m, g))), 6) AS age_curve_mae,
  round_even(avg(abs(j.r1 - likely)), 6) AS markov_mae
FROM judged j
JOIN (SELECT asset_id, component, d0, d1, CAST(round_even(age_t0 + horizon, 0) AS INT) AS age_bin
      FROM pairs) b USING (asset_id, component, d0, d1)
LEFT JOIN kind_ages USING (component, age_bin) LEFT JOIN kind_all USING (component)
GROUP BY ALL""", "markov", extra=JUDGED_CTE + f""",
kind_pairs AS (
  SELECT component, r1, CAST(round_even(age_t0 + horizon, 0) AS INT) AS age_bin
  FROM pairs WHERE NOT {is_test()}),
kind_ages AS (SELECT component, age_bin, avg(r1) AS m FROM kind_pairs WHERE age_bin IS NOT NULL GROUP BY ALL),
kind_all AS (SELECT component, avg(r1) AS g FROM kind_pairs GROUP BY ALL)""")


def accuracy_by_start(spark, sf_dir):
    out = plan.accuracy_by_start(_judged(spark, sf_dir), F.col("likely"))
    return places(out, "mean_predicted", "mean_actual", "mae", "within_1")


START_SQL = sql(f"""SELECT component, CAST(r0 AS INT) AS r0, n, mae, within_1, mean_predicted, mean_actual FROM (
  SELECT component, r0, {measures()}, round_even(avg(predicted), 6) AS mean_predicted,
    round_even(avg(r1), 6) AS mean_actual
  FROM (SELECT *, likely AS predicted FROM judged) GROUP BY component, r0)""",
                "markov", extra=JUDGED_CTE)


def decline_by_group(spark, sf_dir):
    out = plan.decline_by_group(_judged(spark, sf_dir), KIND, F.col("likely"), top=4)
    return places(out, "mean_from", "mean_predicted", "mean_actual", "pred_decline", "actual_decline",
                  "gap")


DECLINE_SQL = sql("""SELECT structure_kind, count(*) AS n, round_even(avg(r0), 6) AS mean_from,
  round_even(avg(likely), 6) AS mean_predicted, round_even(avg(r1), 6) AS mean_actual,
  round_even(avg(r0) - avg(likely), 6) AS pred_decline, round_even(avg(r0) - avg(r1), 6) AS actual_decline,
  round_even(abs((avg(r0) - avg(likely)) - (avg(r0) - avg(r1))), 6) AS gap
FROM judged GROUP BY structure_kind ORDER BY n DESC, structure_kind LIMIT 4""",
                  "markov", extra=JUDGED_CTE)


def bias_by_horizon(spark, sf_dir):
    return places(plan.bias_by_band(_judged(spark, sf_dir), F.col("likely")), "bias")


BIAS_SQL = sql("""SELECT component, band, count(*) AS n, round_even(avg(likely - r1), 6) AS bias
FROM judged GROUP BY ALL""", "markov", extra=JUDGED_CTE)


def catch_rate(spark, sf_dir):
    out = plan.catch_rates(_judged(spark, sf_dir), {
        "likely": F.col("likely"), "conservative": F.col("conservative"), "carry": F.col("r0")})
    return places(out, "catch_pct", "false_alarm_pct")


CATCH_SQL = sql("""SELECT component, method, count(*) FILTER (r0 - r1 >= 2) AS decliners,
  count(*) FILTER (r0 - r1 >= 2 AND r0 - predicted >= 1) AS caught,
  round_even(count(*) FILTER (r0 - r1 >= 2 AND r0 - predicted >= 1) * 100.0::DOUBLE
    / nullif(count(*) FILTER (r0 - r1 >= 2), 0), 6) AS catch_pct,
  round_even(count(*) FILTER (r0 - r1 < 2 AND r0 - predicted >= 1) * 100.0::DOUBLE
    / nullif(count(*) FILTER (r0 - r1 < 2), 0), 6) AS false_alarm_pct
FROM (SELECT component, 'likely' AS method, r0, r1, likely AS predicted FROM judged UNION ALL
      SELECT component, 'conservative', r0, r1, conservative FROM judged UNION ALL
      SELECT component, 'carry', r0, r1, r0 FROM judged) GROUP BY ALL""", "markov", extra=JUDGED_CTE)


def precision_at_k(spark, sf_dir):
    rows = _judged(spark, sf_dir).withColumn("score", half_even(F.col("risk_pct"), 6))
    out = plan.ranking_quality(rows, "score", CFG.risk_threshold)
    return places(out, "auc", "precision_top", "base_rate")


PRECISION_SQL = sql("""SELECT component, CAST(sum(n) AS BIGINT) AS n,
  round_even(sum((n - pos) * (pos_above + pos / 2.0::DOUBLE)) / (sum(pos) * sum(n - pos)), 6) AS auc,
  round_even(sum(greatest(0, least(n, cut - above)) * pos / CAST(n AS DOUBLE))
    / sum(greatest(0, least(n, cut - above))), 6) AS precision_top,
  round_even(sum(pos) / CAST(sum(n) AS DOUBLE), 6) AS base_rate
FROM (SELECT *, ceil(sum(n) OVER (PARTITION BY component) * 0.01::DOUBLE) AS cut,
        coalesce(sum(n) OVER w, 0) AS above, coalesce(sum(pos) OVER w, 0) AS pos_above
      FROM (SELECT component, round_even(risk_pct, 6) AS s, count(*) AS n,
              count(*) FILTER (r1 <= 5) AS pos FROM judged GROUP BY ALL)
      WINDOW w AS (PARTITION BY component ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
GROUP BY component""", "markov", extra=JUDGED_CTE)


def backtest_sample(spark, sf_dir):
    """Held-out pairs, a repeatable two in a hundred, with the no-change forecast."""
    rows = pairs.forward_pairs(stored_events(spark, sf_dir), CFG)
    return plan.backtest_sample(rows, CFG, F.col("r0"))


BACKTEST_SQL = sql(f"""SELECT asset_id, component, strftime(d0, '%Y-%m-%d') AS from_date, r0 AS current,
  round_even(horizon, 1) AS years_ahead, r0 AS predicted, r1 AS actual, r0 - r1 AS error
FROM direct WHERE {is_test()} AND CAST('0x' || substr(md5(asset_id || '|' || component || '|'
  || strftime(d0, '%Y-%m-%d') || '|' || strftime(d1, '%Y-%m-%d')), 1, 8) AS BIGINT) % 1000 < 20""", "events", extra=DIRECT_PAIRS)


def weighted_overall(spark, sf_dir):
    by_start = plan.accuracy_by_start(_judged(spark, sf_dir), F.col("likely"))
    return places(overall(by_start), "mae", "within_1")


OVERALL_SQL = sql(f"""SELECT n, mae, within_1 FROM (
  SELECT {measures()} FROM (SELECT r1, likely AS predicted FROM judged))""", "markov", extra=JUDGED_CTE)


def best_gain(spark, sf_dir):
    table = plan.benchmark(stratified_events(spark, sf_dir), CFG, BANDS, [KIND], STEPS)
    return places(gain(table.where("band = '4'"), "markov_mae", "carry_forward_mae"), "best_gain")


GAIN_SQL = sql("""SELECT round_even(max(1 - m / nullif(c, 0)), 6) AS best_gain FROM (
  SELECT component, avg(abs(r1 - r0)) AS c, avg(abs(r1 - likely)) AS m
  FROM judged WHERE band = '4' GROUP BY component)""", "markov", extra=JUDGED_CTE)

DRIVERS = ("adt", "structure_length", "deck_width", "skew_angle", "inventory_load", "operating_load",
           "year_reconstructed")


def top_drivers_per_group(spark, sf_dir):
    """The three attributes that move most with each component's rating, and whether any other
    component names them too. Co-moments of all attributes come from one aggregation."""
    rows = panel(spark, sf_dir)
    moments = rows.agg(*[guarded_corr(c, d).alias(f"{c}|{d}") for c in COMPONENTS for d in DRIVERS])
    entries = F.array(*[F.struct(F.lit(c).alias("component"), F.lit(d).alias("feature"),
                                 half_even(F.abs(F.col(f"{c}|{d}")), 6).alias("importance"))
                        for c in COMPONENTS for d in DRIVERS])
    table = moments.select(F.inline(entries))
    order = Window.partitionBy("component").orderBy(F.col("importance").desc(), "feature")
    top = table.withColumn("place", F.row_number().over(order)).where("place <= 3")
    named = top.groupBy("feature").agg(F.count(F.lit(1)).alias("components"))
    return top.join(named, "feature").withColumn("place", F.col("place").cast("bigint"))


DRIVERS_SQL = sql("""SELECT component, feature, importance, place,
  count(*) OVER (PARTITION BY feature) AS components FROM (
  SELECT *, row_number() OVER (PARTITION BY component ORDER BY importance DESC, feature) AS place
  FROM drivers) WHERE place <= 3""", "panel", extra="drivers AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS component, '{d}' AS feature, round_even(abs(corr({c}, {d})), 6) AS importance FROM panel"
    for c in COMPONENTS for d in DRIVERS) + ")")

QUERIES = {
    "carry_forward_by_horizon": (carry_forward_by_horizon, CARRY_SQL),
    "baseline_by_horizon": (baseline_by_horizon, BASELINE_SQL),
    "persistence_baseline": (persistence_baseline, PERSIST_SQL),
    "age_curve_baseline": (age_curve_baseline, AGE_CURVE_SQL),
    "metric_suite": (metric_suite, SUITE_SQL),
    "markov_transitions": (markov_transitions, TRANSITIONS_SQL),
    "markov_kstep": (markov_kstep, KSTEP_SQL),
    "markov_outlook": (markov_outlook, OUTLOOK_SQL),
    "benchmark_by_method": (benchmark_by_method, BENCHMARK_SQL),
    "accuracy_by_start": (accuracy_by_start, START_SQL),
    "decline_by_group": (decline_by_group, DECLINE_SQL),
    "bias_by_horizon": (bias_by_horizon, BIAS_SQL),
    "catch_rate": (catch_rate, CATCH_SQL),
    "precision_at_k": (precision_at_k, PRECISION_SQL),
    "backtest_sample": (backtest_sample, BACKTEST_SQL),
    "weighted_overall": (weighted_overall, OVERALL_SQL),
    "best_gain": (best_gain, GAIN_SQL),
    "top_drivers_per_group": (top_drivers_per_group, DRIVERS_SQL),
}
