import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wearline.catalogue import model_queries
from wearline.config import ANCHOR_HORIZONS, PanelConfig, Screen, TreeParams
from wearline.functions import trees
from wearline.operators.calibration import side_of
from wearline.operators.markov import matrix_powers, pool_unseen
from wearline.operators.split import is_test_asset
from wearline.operators.metrics import best_gain, by_method, grouped_summary, score, weighted_overall
from wearline.plans import jobs, models as ml, outlook as plan
from wearline.plans.benchmark import catch_rates, ranking_quality
from wearline.session import settle

CFG = replace(PanelConfig(), components=("deck",))
SMALL = TreeParams(rounds=2, depth=3, forest_trees=3)


def constant(likely, conservative=None, risk=70.0):
    low = likely if conservative is None else conservative
    return plan.Scorer(("deck",), lambda rows: rows.withColumns({
        "likely": F.lit(likely), "conservative": F.lit(low), "risk_pct": F.lit(risk)}))


def panel(spark, rows):
    schema = "asset_id string, raw_date string, deck double, year_built double, region string"
    return spark.createDataFrame(rows, schema).withColumn(
        "snapshot_no", F.monotonically_increasing_id()).withColumn("on_system", F.lit("ON"))


def test_metrics(spark):
    df = spark.createDataFrame([(5.0, 5.0), (6.0, 6.0), (7.0, 7.0)], "r1 double, p double")
    row, = score(df, [], predicted="p").collect()
    assert (row.mae, row.within_1, row.r2) == (0, 100, 1)
    one = spark.createDataFrame([(9.0, 12.0)], "r1 double, p double")
    row, = score(one, [], predicted="p").collect()
    assert row.mae == 0 and row.r2 is None
    flat = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0)], "r1 double, p double")
    row, = score(flat, [], predicted="p").collect()
    assert row.r2 == 0 and row.rmse == pytest.approx(0.5 ** 0.5)
    weighted = spark.createDataFrame([(5.0, 5.0, 3), (5.0, 7.0, 1)], "r1 double, p double, n int")
    row, = score(weighted, [], predicted="p", weight="n").collect()
    assert (row.n, row.mae, row.within_1) == (4, 0.5, 75)


def test_summary_and_averages(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", None), (None, 3.0)],
                               "region string, v double")
    out = {r.region: r for r in grouped_summary(df, ["region", "zone"], ["v"]).collect()}
    assert (out["a"].v_mean, out["a"].v_median, out["a"].v_count) == (3, 2, 3)
    assert (out["b"].v_mean, out["b"].v_median, out["b"].v_count) == (None, None, 0)
    assert None not in out and grouped_summary(df, ["zone"], ["v"]) is None
    table = spark.createDataFrame([(1, 0.5, 100.0), (3, 1.5, 0.0)], "n int, mae double, within_1 double")
    row, = weighted_overall(table).collect()
    assert (row.n, row.mae, row.within_1) == (4, 1.25, 25)
    gains = spark.createDataFrame([(0.4, 0.8), (0.3, 0.0), (0.1, None)], "m double, c double")
    assert best_gain(gains, "m", "c").first().best_gain == 0.5


def test_ranking_and_catching(spark):
    df = spark.createDataFrame(
        [("deck", 90.0, 7, 5, 1), ("deck", 80.0, 7, 4, 1), ("deck", 10.0, 7, 7, 2), ("deck", 5.0, 7, 5, 1)],
        "component string, s double, r0 int, r1 int, n int")
    row, = ranking_quality(df, "s", 5.0, share=0.2).collect()
    assert (row.n, row.precision_top) == (5, 1.0) and row.auc == pytest.approx(4 / 6)
    scored = df.withColumn("p", F.when(F.col("s") > 50, 5.5).otherwise(7.0))
    row, = catch_rates(scored, {"m": F.col("p")}).collect()
    assert (row.decliners, row.caught, row.false_alarm_pct) == (3, 2, 0)


def test_matrix_powers(spark):
    table = spark.createDataFrame([("g", 7, 7, 0.5), ("g", 7, 6, 0.5), ("g", 6, 6, 1.0)],
                                  "g string, from_rating int, to_rating int, p double")
    out = {(r.k, r.from_rating): r.p for r in matrix_powers(table, ["g"], [1, 3]).collect()}
    assert out[(1, 7)][6:8] == [0.5, 0.5] and out[(3, 7)][6:8] == [0.875, 0.125]
    assert out[(3, 2)][2] == 1.0 and sum(out[(3, 7)]) == 1.0


def test_point_forecast_routes(spark):
    rows = plan.starting_points(panel(spark, [("A", "5152010", 8.0, 1990.0, "12"),
                                              ("A", "5152020", 7.0, 1990.0, "12")]), CFG)
    far, = plan.point_forecast(rows, constant(4.2, 4.0), CFG, 2040).collect()
    assert (far.method, far.prediction, far.prediction_conservative, far.risk_poor_pct,
            far.last_inspection_year) == ("model", 4.2, 4.0, 70, 2020)
    near, = plan.point_forecast(rows, constant(4.2), CFG, 2022).collect()
    assert (near.method, near.prediction, near.risk_poor_pct) == ("carry_forward", 7.0, None)
    past, = plan.point_forecast(rows, constant(4.2), CFG, 2018).collect()
    assert (past.method, past.prediction) == ("current", 7.0)
    assert plan.point_forecast(rows.where("asset_id = 'Z'"), constant(4.2), CFG, 2040).count() == 0
    refusing = plan.Scorer(CFG.components, lambda asked: constant(4.2).predict(asked).withColumn(
        "likely", F.expr("CASE WHEN horizon > 0 THEN raise_error('asked') END").cast("double")))
    assert plan.point_forecast(rows, refusing, CFG, 2022).first().method == "carry_forward"


def test_watchlist_screen(spark):
    data = panel(spark, [("A", "5152020", 6.0, 1980.0, "12"), ("B", "5152020", 8.0, 1980.0, "12"),
                         ("C", "5152020", 3.0, 1980.0, "12")])
    row, = plan.watchlist(data, constant(4.2, 4.0), CFG, "deck").collect()
    assert (row.asset_id, row.current_rating, row.forecast_conservative, row.risk_poor_pct,
            row.predicted_decline) == ("A", 6.0, 4.0, 70.0, 1.8)
    assert plan.watchlist(data, constant(4.2), CFG, "deck", region="99").count() == 0
    with pytest.raises(ValueError):
        plan.watchlist(data, constant(4.2), CFG, "roof")
    off = data.withColumn("on_system", F.lit("OFF"))
    assert plan.watchlist(off, constant(4.2), CFG, "deck").count() == 0
    assert plan.watchlist(off, constant(4.2), CFG, "deck", Screen(on_system_only=False)).count() == 1
    rounded = plan.watchlist(data, constant(5.04), CFG, "deck")
    assert rounded.first().forecast_conservative == 5.0


def test_grid_payload_and_regions(spark):
    data = panel(spark, [("A", "5152020", 6.0, 1980.0, "12"), ("B", "5152020", 8.0, None, "3")])
    rows = plan.starting_points(data, CFG).withColumns({
        "feat_total": F.lit(4), "feat_present": F.lit(2)})
    grid = plan.horizon_grid(rows, constant(4.2, 4.0), CFG)
    a = {r.horizon: r for r in grid.where("asset_id = 'A'").collect()}
    assert sorted(a) == [float(h) for h in ANCHOR_HORIZONS]
    assert (a[2.0].likely, a[2.0].risk_pct, a[5.0].likely, a[5.0].risk_pct) == (6.0, None, 4.2, 70.0)
    payload = plan.asset_payload(grid, CFG)
    doc = json.loads(payload.where("id = 'A'").select(F.to_json(F.struct("*"))).first()[0])
    assert doc["targets"]["deck"]["likely"]["10"] == 4.2 and doc["last_year"] == 2020
    regions = [r.asDict() for r in plan.region_summary(grid, CFG).collect()]
    assert [r["region"] for r in regions] == ["3", "12", None]
    assert [r["poor"] for r in regions] == [0, 1, 1] and regions[2]["assets"] == 2
    assert plan.coverage_confound(plan.region_summary(grid, CFG)).first().verdict == "too few"


def test_confound_verdicts(spark):
    def verdict(points):
        df = spark.createDataFrame([(str(i), float(c), float(p)) for i, (c, p) in enumerate(points)],
                                   "region string, coverage_pct double, poor_pct double")
        return plan.coverage_confound(df).first()

    steep = verdict([(50 + i, 90 - i) for i in range(9)])
    assert steep.verdict == "confounded" and steep.correlation == pytest.approx(-1)
    flat = verdict([(80, i) for i in range(9)])
    assert flat.verdict == "comparable" and flat.correlation == 0
    assert verdict([(50, 1), (60, 2), (70, 0)]).verdict == "too few"


def wear_history(spark, assets=60):
    """Ratings that fall with time, so that a trained model has something to find."""
    rows = []
    for a in range(assets):
        for i in range(9):
            rows.append((f"A{a:03d}", f"{1996 + 3 * i}-06-01", float(max(2, 9 - (i * (1 + a % 3)) // 3)),
                         1950.0 + a, str(a % 4)))
    return panel(spark, rows).withColumns({
        "owner": F.concat(F.lit("o"), F.col("region")), "adt": F.col("year_built") * 2})


def test_trajectory_models_train_score_save_load(spark, tmp_path):
    pairs = ml.settled_pairs(jobs.training_pairs(wear_history(spark), None, CFG))
    models = ml.fit_all_trajectories(pairs, CFG, SMALL)
    assert list(models) == ["deck"]
    scored = ml.predict_by_component(models, pairs, CFG)
    bad = scored.where("conservative > likely OR likely NOT BETWEEN 0 AND 9 "
                       "OR conservative NOT BETWEEN 0 AND 9 OR risk_pct NOT BETWEEN 0 AND 100")
    assert bad.count() == 0 and scored.count() == pairs.count()
    metrics = {(r.band, r.method): r.mae for r in jobs.trajectory_metrics(pairs, models, CFG).collect()}
    assert metrics[("~20y", "model")] < metrics[("~20y", "carry_forward")]
    ml.save_trajectories(models, str(tmp_path), spark)
    again = ml.load_trajectories(PanelConfig(), str(tmp_path), spark)
    assert list(again) == ["deck"]
    cols = ["asset_id", "d0", "d1", "likely", "conservative", "risk_pct"]
    a = sorted(map(tuple, scored.select(cols).collect()))
    b = sorted(map(tuple, ml.predict_by_component(again, pairs, CFG).select(cols).collect()))
    assert a == b
    unseen = pairs.limit(1).withColumn("owner", F.lit("new")).withColumn("adt", F.lit(None).cast("double"))
    assert ml.predict_by_component(models, unseen, CFG).first().likely is not None
    importance = ml.trajectory_importance(models, spark)
    assert importance.where("feature = 'r0'").first().importance > 0
    few = ml.fit_all_trajectories(pairs.limit(20), CFG, SMALL)
    assert few == {}


def test_the_cap_bounds_training_only(spark):
    pairs = ml.settled_pairs(jobs.training_pairs(wear_history(spark), None, CFG))
    small = replace(CFG, pair_cap=60, min_pairs=10)
    models = ml.fit_all_trajectories(pairs, small, SMALL)
    held_out = pairs.where(is_test_asset(small))
    scored = jobs.trajectory_metrics(pairs, models, small).where("method = 'model'")
    assert scored.agg(F.sum("n")).first()[0] == held_out.where("component = 'deck'").count() > 60


def test_no_models_give_no_rows(spark):
    pairs = ml.settled_pairs(jobs.training_pairs(wear_history(spark, 5), None, CFG))
    none = ml.predict_by_component({}, pairs, CFG)
    assert none.count() == 0 and {"likely", "conservative", "risk_pct"} <= set(none.columns)


def test_attribute_models_save_and_load(spark, tmp_path):
    rows = wear_history(spark)
    model, _ = ml.fit_attributes(rows, "deck", CFG, SMALL)
    ml.save_attributes({"deck": model}, str(tmp_path), spark)
    again = ml.load_attributes(PanelConfig(), str(tmp_path), spark)
    assert list(again) == ["deck"]
    cols = ["asset_id", "raw_date", "deck_boosted_predicted", "deck_linear_predicted"]
    a = sorted(map(tuple, ml.predict_attributes({"deck": model}, rows).select(cols).collect()))
    assert a == sorted(map(tuple, ml.predict_attributes(again, rows).select(cols).collect()))


def test_one_sided_risk_has_no_classifier(spark):
    pairs = ml.settled_pairs(jobs.training_pairs(
        wear_history(spark, 20).withColumn("deck", F.lit(7.0)), None, CFG))
    model = ml.fit_trajectory(pairs, CFG, SMALL)
    assert model.risk is None
    row = model.predict(pairs, 0.25).first()
    assert row.risk_pct is None and row.likely == pytest.approx(7.0)


def test_attribute_models(spark):
    rows = spark.range(120).select(
        F.format_string("A%03d", F.col("id")).alias("asset_id"),
        (F.rand(1) * 100).alias("feat_a"), (F.rand(2) * 50).alias("feat_b"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("double")).alias("feat_c"),
        F.lit(None).cast("double").alias("empty"),
        F.concat(F.lit("o"), F.col("id") % 3).alias("owner"),
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(9.0), 6 + 1.5 * F.randn(3)))).alias("deck"))
    models, metrics = ml.fit_all_attributes(rows, CFG, SMALL)
    found = {r.model_type: r for r in metrics.collect()}
    assert set(found) == {"boosted", "linear"} and found["linear"].mae < 5
    assert found["linear"].n_train + found["linear"].n_test == 120
    predicted = ml.predict_attributes(models, rows)
    assert predicted.where("deck_linear_predicted BETWEEN 0 AND 9").count() == 120
    kinds = {r.model_type for r in ml.attribute_importance(models, spark).collect()}
    assert kinds == {"boosted", "linear"}
    assert ml.fit_attributes(rows.limit(5), "deck", CFG, SMALL) is None
    with pytest.raises(ValueError):
        ml.fit_attributes(rows, "deck", CFG, SMALL, kinds=("cubic",))
    grid = {"maxIter": (1, 2), "maxDepth": (2, 3)}
    _, tuned = ml.fit_attributes(rows, "deck", CFG, SMALL, kinds=("boosted",),
                                 tuning={"tries": 2, "folds": 2, "grid": grid})
    best = json.loads(tuned.first().best_params)
    assert set(best) == {"maxIter", "maxDepth"}


def test_combined_forecast_prefers_history(spark):
    first = spark.createDataFrame([("A", "deck", 4.0)], "asset_id string, component string, prediction double")
    second = spark.createDataFrame([("A", "deck", 5.0), ("B", "deck", 6.0)],
                                   "asset_id string, component string, prediction double")
    out = {r.asset_id: (r.prediction, r.source) for r in
           plan.combine_forecasts(first, second, ["asset_id", "component"]).collect()}
    assert out == {"A": (4.0, "trajectory"), "B": (6.0, "attributes")}


def test_train_job_writes_all_tables(spark, tmp_path):
    raw = wear_history(spark, 40).withColumn("deck", F.col("deck").cast("string"))
    written = jobs.train(raw, None, CFG, SMALL, str(tmp_path))
    assert {"trajectory_metrics", "metrics", "predictions", "feature_importance", "summary",
            "panel"} == set(written)
    assert spark.read.parquet(written["summary"]).count() == 4
    clean = spark.read.parquet(written["panel"])
    every = jobs.forecast_year(clean, None, CFG, str(tmp_path), 2040)
    assert every.where("prediction NOT BETWEEN 0 AND 9").count() == 0
    ids = {r.asset_id for r in every.select("asset_id").collect()}
    one = jobs.forecast_year(clean, None, CFG, str(tmp_path), 2040, asset=min(ids))
    assert {r.asset_id for r in one.collect()} == {min(ids)}
    gates = jobs.verify_source(raw, CFG)
    assert gates["missing_columns"] == [] and gates["shape"].first().is_panel


def test_by_method_keeps_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    out = by_method(df, {"x": F.col("a"), "y": F.col("b")})
    assert out.columns == ["a", "b", "method", "predicted"] and out.count() == 2


def test_unseen_strata_take_the_component_chain(spark):
    counts = spark.createDataFrame([("deck", "a", 7, 7, 3), ("deck", "b", 7, 6, 1)],
                                   "component string, g string, from_rating int, to_rating int, n long")
    groups = spark.createDataFrame([("deck", "a"), ("deck", "b"), ("deck", "c")], "component string, g string")
    out = {tuple(r) for r in pool_unseen(counts, groups, ["component", "g"]).collect()}
    assert out == {("deck", "a", 7, 7, 3), ("deck", "b", 7, 6, 1), ("deck", "c", 7, 7, 3), ("deck", "c", 7, 6, 1)}


def test_ranks_share_places_and_order_nulls_last(spark):
    listed = spark.createDataFrame(
        [("A", "deck", 90.0, 4.0), ("B", "deck", 90.0, 4.0), ("C", "deck", 90.0, 4.1), ("D", "deck", None, 3.0),
         ("E", "culvert", 1.0, 1.0)],
        "asset_id string, component string, risk_poor_pct double, forecast_conservative double")
    assert {r.asset_id: r["rank"] for r in plan.with_rank(listed).collect()} == {"A": 1, "B": 1, "C": 3, "D": 4, "E": 1}
    assert plan.with_rank(listed.where("false")).count() == 0


def test_ranking_over_many_slices(spark):
    import random
    draw = random.Random(1)
    rows = [("deck", draw.choice([draw.random() * 100, 50.0]), draw.randint(3, 7), 1) for _ in range(400)]
    row, = ranking_quality(spark.createDataFrame(rows, "component string, s double, r1 int, n int"), "s", 5.0).collect()
    poor, good = [s for _, s, r, _ in rows if r <= 5], [s for _, s, r, _ in rows if r > 5]
    wins = sum((a > b) + (a == b) / 2 for a in poor for b in good)
    assert row.n == 400 and row.auc == pytest.approx(wins / len(poor) / len(good))


def test_regions_keep_assets_without_one(spark):
    rows = panel(spark, [("A", "5152010", 6.0, 1990.0, None), ("B", "5152010", 6.0, 1990.0, "12")])
    grid = plan.horizon_grid(plan.starting_points(rows, CFG), constant(4.0), CFG).withColumns(
        {"feat_total": F.lit(2), "feat_present": F.lit(1)})
    found = {r.region: r.assets for r in plan.region_summary(grid, CFG).collect()}
    assert found == {"12": 1, "unknown": 1, None: 2}
    with pytest.raises(ValueError):
        plan.region_summary(grid, CFG, at=7)


def scored_by(model, rows, how):
    out = getattr(model, how)(rows, 0.25, True)
    names = ["asset_id", "d0", "d1", "likely", "leaf_quantile", "class_quantile", "risk_raw_pct"]
    return sorted(map(tuple, out.select(*names).collect()))


def test_trees_as_expressions_score_like_the_models(spark, monkeypatch):
    pairs = ml.settled_pairs(jobs.training_pairs(wear_history(spark, 40), None, CFG))
    model = ml.fit_trajectory(pairs, CFG, TreeParams(rounds=7, depth=4, forest_trees=6))
    rows = pairs.where("d0 < '2005-01-01'").withColumns({
        "owner": F.when(F.col("r0") > 7, "new").when(F.col("r0") > 5, F.col("owner")),
        "adt": F.when(F.col("horizon") > 5, F.col("adt"))})
    a, b = scored_by(model, rows, "_by_expressions"), scored_by(model, rows, "_by_models")
    assert len(a) == rows.count() > 100 and len({r[3:] for r in a}) > 20
    for left, right in zip(a, b, strict=True):
        assert left[:3] == right[:3] and left[3:] == pytest.approx(right[3:], abs=1e-9)
    assert model.is_small(True) and "UDF(features" not in model.predict(rows, 0.25, True)._jdf.queryExecution().optimizedPlan().toString()
    listed = model.predict(rows, 0.25).where("conservative <= 5")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in listed.splitlines() if "Filter" in line]
    assert filters and not any("__f" in line or "get(" in line for line in filters)  # no trees in a filter
    monkeypatch.setattr(ml.trees, "MAX_NODES", 0)
    assert not model.is_small(False)
    large = sorted(map(tuple, model.predict(rows, 0.25).select("likely", "conservative", "risk_pct").collect()))
    monkeypatch.undo()
    small = sorted(map(tuple, model.predict(rows, 0.25).select("likely", "conservative", "risk_pct").collect()))
    assert len(large) == len(small) and all(x == pytest.approx(y, abs=1e-9) for x, y in zip(large, small))
    odd = rows.withColumn("adt", F.lit(float("nan")))
    for how in ("_by_expressions", "_by_models"):
        with pytest.raises(Exception, match="NaN"):
            scored_by(model, odd, how)


def test_large_sums_of_trees_compile_in_pieces(spark):
    """One method of the whole projection would pass the 64 KB that the JVM takes."""
    wide = [f"x{i}" for i in range(40)]
    rows = spark.range(50).select(*[(F.col("id") * (i + 1) % 17).cast("int").alias(n) for i, n in enumerate(wide)])
    table = [[[float(k + t + n) for k in range(2)] for n in range(17)] for t in range(400)]
    names = [wide[t % 40] for t in range(400)]
    sums = [trees.sum_of_leaves(table, names, k) for k in range(2)]
    out = rows.selectExpr(*[f"{trees.in_pieces(s)} AS s{k}" for k, s in enumerate(sums)])
    assert out._jdf.queryExecution().executedPlan().toString().startswith("Project")  # not *(1) Project
    want = [tuple(float(sum(k + t + (i * (t % 40 + 1)) % 17 for t in range(400))) for k in range(2)) for i in range(50)]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_wide_pairs_read_long_are_the_pairs(spark):
    data = wear_history(spark, 20).withColumns({
        "culvert": F.when(F.col("year_built") > 1960, F.lit(6.0)), "superstructure": F.lit(None).cast("double")})
    cfg = PanelConfig()
    rows = jobs.enriched_events(data, None, cfg)
    want = jobs.pairs_with_inputs(rows, cfg)
    got = jobs.stored_pairs(rows, cfg, SMALL)
    assert got.drop("_side").columns == want.columns
    assert got.count() == want.count() > 0 and want.exceptAll(got.drop("_side")).count() == 0
    side = {tuple(r) for r in got.select("asset_id", "_side").distinct().collect()}
    share = SMALL.calibration_share
    assert side == {tuple(r) for r in got.select("asset_id", side_of(cfg, share)).distinct().collect()}
    one = got.where("component = 'deck' AND _side = 'learn'")
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "r0__culvert" not in one._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    models, again = (ml.fit_all_trajectories(p, cfg, SMALL) for p in (got, want))
    assert set(models) == set(again) == {"deck", "culvert"}


def test_settled_folders_hold_all_rows(spark):
    df = spark.range(300).select((F.col("id") % 3).cast("string").alias("g"), "id", F.lit(None).cast("string").alias("none"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    out = settle(df, "folders", by=["g"])
    assert out.columns == df.columns and out.exceptAll(df).count() == 0 and out.count() == 300
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_held_out_pairs_are_scored_once_and_only_if_asked_for(spark, monkeypatch):
    source, calls, names = "/root/testdata/sf0.001/.", [], []
    predict, write = ml.predict_by_component, model_queries.settle
    monkeypatch.setattr(ml, "predict_by_component", lambda *a, **k: calls.append(1) or predict(*a, **k))
    monkeypatch.setattr(model_queries, "settle", lambda df, name, **k: names.append(name) or write(df, name, **k))
    assert model_queries.feature_importance(spark, source).count() > 0
    assert names == [] and len(calls) == 1  # the calibrating pairs
    assert model_queries.model_risk(spark, source).count() > 0
    assert model_queries.model_point_by_horizon(spark, source).count() > 0
    assert names == ["scored"] and len(calls) == 2
