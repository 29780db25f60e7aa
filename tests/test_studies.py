import datetime
import random
import statistics
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wearline import session
from wearline.catalogue import model_queries
from wearline.config import HorizonBands, PanelConfig, TreeParams
from wearline.operators import calibration, enrich, events, features, medians, pairs, quality, split
from wearline.operators.clean import clean_panel
from wearline.operators.medians import medians_by
from wearline.operators.split import is_test_asset
from wearline.plans import models as ml
from wearline.plans.benchmark import baselines_by_split
from wearline.sources import order_panel as src, store
from wearline.sources.store import write_by_asset, write_with_gates

CFG = PanelConfig()
SF = "/root/testdata/sf0.001"


def pooled(counts):
    """Pool adjacent violators over (bin, n, poor)."""
    blocks = []
    for b, n, p in sorted(counts):
        blocks.append([[b], n, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] > blocks[-1][2] * blocks[-2][1]:
            bins, m, q = blocks.pop()
            blocks[-1] = [blocks[-1][0] + bins, blocks[-1][1] + m, blocks[-1][2] + q]
    return {b: 100 * p / n for bins, n, p in blocks for b in bins}


@pytest.mark.parametrize("seed", range(3))
def test_isotonic_steps_equal_pooling(spark, seed):
    rnd = random.Random(seed)
    counts = [(g, b, n, rnd.randint(0, n)) for g in "ab" for b in rnd.sample(range(20), 12) for n in [rnd.randint(1, 9)]]
    df = spark.createDataFrame(counts, "g string, bin int, n long, poor long")
    got = {(r.g, r.bin): r.calibrated_pct for r in calibration.isotonic_steps(df, ["g"], bins=20).collect()}
    assert len(got) == 40
    for g in "ab":
        want = pooled([(b, n, p) for k, b, n, p in counts if k == g])
        filled = min(want.values())
        for b in range(20):
            filled = want.get(b, filled)
            assert got[g, b] == pytest.approx(filled)


def test_calibrated_scores_and_reliability(spark):
    df = spark.createDataFrame([("a", 0.0, 5.0), ("a", 99.9, 6.0), ("a", 100.0, 4.0), ("a", None, 4.0), ("b", 50.0, None)],
                               "g string, s double, r1 double")
    poor = F.col("r1") <= 5
    counted = calibration.count_bins(df, ["g"], "s", poor)
    assert sorted(map(tuple, counted.collect())) == [("a", 0, 1, 1), ("a", 99, 2, 1)]
    out = calibration.calibrate(df, calibration.isotonic_steps(counted, ["g"]), ["g"], "s")
    assert sorted((r.g, r.s, r.calibrated_pct) for r in out.collect() if r.s is not None) == [
        ("a", 0.0, pytest.approx(200 / 3)), ("a", 99.9, pytest.approx(200 / 3)), ("a", 100.0, pytest.approx(200 / 3)), ("b", 50.0, None)]
    table = calibration.reliability(out, ["g"], "calibrated_pct", poor)
    assert [(r.n, round(r.observed_pct, 6)) for r in table.collect()] == [(3, 66.666667)]
    assert calibration.isotonic_steps(counted.limit(0), ["g"]).collect() == []


def stored(spark):
    return events.inspection_events(clean_panel(src.raw_panel(spark, SF), src.CFG), src.CFG)


def test_temporal_split_leaks_nothing(spark):
    rows = stored(spark)
    cutoff = split.cutoff_day(rows, src.CFG, 0.6)
    days = sorted(r.event_date for r in rows.select("event_date").collect())
    assert cutoff == next(d for i, d in enumerate(days, 1) if days.index(d) >= 0 and sum(x <= d for x in days) >= 0.6 * len(days))
    every = pairs.forward_pairs(rows, src.CFG)
    sided = every.withColumn("side", split.temporal_side(src.CFG, cutoff)).withColumn("held", is_test_asset(src.CFG)).collect()
    for r in sided:
        want = ("test" if r.held and r.d0 > cutoff else "train" if not r.held and r.d1 <= cutoff else "purged")
        assert r.side == want
    leaks = split.split_leaks(every, src.CFG, split.temporal_side(src.CFG, cutoff)).collect()
    assert sum(r.n_train + r.n_test + r.n_purged for r in leaks) == len(sided)
    assert all(r.time_leaks == 0 and r.asset_leaks == 0 for r in leaks)
    # By asset alone the test pairs start while training still goes on.
    by_asset = F.when(is_test_asset(src.CFG), "test").otherwise("train")
    assert sum(r.time_leaks for r in split.split_leaks(every, src.CFG, by_asset).collect()) > 0
    # By time alone assets are on both sides.
    by_time = F.when(F.col("d1") <= F.lit(cutoff), "train").when(F.col("d0") > F.lit(cutoff), "test").otherwise("purged")
    assert sum(r.asset_leaks for r in split.split_leaks(every, src.CFG, by_time).collect()) > 0
    kept = split.temporal_events(rows, src.CFG, cutoff)
    assert pairs.forward_pairs(kept, src.CFG).count() == sum(r.side != "purged" for r in sided)
    table = baselines_by_split(rows, src.CFG, src.BANDS, cutoff)
    assert {r.split for r in table.select("split").distinct().collect()} == {"asset", "time"}
    with pytest.raises(ValueError, match="no dated"):
        split.cutoff_day(rows.limit(0), src.CFG)


def test_cap_is_exact_and_scans_once(spark):
    rows = pairs.forward_pairs(stored(spark), src.CFG)
    settled, sizes = pairs.settle_counted(rows, src.CFG)
    assert sizes == {r.component: r.n for r in settled.groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = pairs.cap_pairs(settled, src.CFG, 300, sizes)
    assert "near-cap" in out._jdf.queryExecution().optimizedPlan().toString() or out.columns == settled.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "/pairs-" not in plan and "near-cap" in plan
    key = lambda r: (r.asset_id, r.component, r.d0, r.d1)
    import hashlib
    draw = lambda r: hashlib.md5(f"{r.asset_id}|{r.component}|{r.d0}|{r.d1}|{src.CFG.seed}".encode()).hexdigest()
    want = set()
    for c in sizes:
        want |= {key(r) for r in sorted(settled.where(F.col("component") == c).collect(), key=draw)[:300]}
    assert {key(r) for r in out.collect()} == want
    assert pairs.cap_pairs(settled, src.CFG, 10**6, sizes) is settled


def test_medians_in_rounds(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("xyz"), rnd.choice([rnd.random(), float(rnd.randint(0, 5))])) for _ in range(5000)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.v for r in medians_by(df, ["g"], ["v"], bound=4).collect()}
    assert got == {g: statistics.median(v for k, v in data if k == g) for g in "xyz"}
    assert medians_by(df.limit(0), ["g"], ["v"]).collect() == []


def test_median_of_ten_million_distinct_values(spark):
    n = 10_000_001
    df = spark.range(n).select((F.col("id") * 7_368_787 % n).cast("double").alias("v"))
    row, = medians_by(df, [], ["v"]).collect()
    assert row.v == n // 2


def exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning(asset_id" in line or "Exchange hashpartitioning(_a#" in line]


def test_store_needs_no_exchange_by_asset(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = write_by_asset(stored(spark), src.CFG)
        latest = events.latest_event(rows, src.CFG)
        lagged = events.previous_ratings(rows, src.CFG, stored_by_asset=True)
        joined = pairs.forward_pairs(rows, src.CFG, split_above=None)
        counted = pairs.outcome_counts(rows, src.CFG, src.BANDS, stored_by_asset=True)
        for df in (latest, lagged, joined, counted):
            assert exchanges(df) == [], df._jdf.queryExecution().executedPlan().toString()
        plain = pairs.forward_pairs(stored(spark), src.CFG)
        assert joined.select(*plain.columns).exceptAll(plain).count() == 0 and joined.count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gates_while_writing_equal_the_gates(spark):
    raw = src.raw_panel(spark, SF)
    odd = spark.createDataFrame([(None, "1012000"), ("  ", "1012001"), ("777", None), ("778", "junk"), ("779", "1012002")],
                                "asset_id string, raw_date string")
    raw = raw.unionByName(odd, allowMissingColumns=True)
    static = enrich.static_attributes(src.extract_rows(spark, SF), src.CFG, "as_id", src.EXTRACT_ORDER)
    rows, gates = write_with_gates(raw, static, src.CFG)
    assert gates.shape.collect() == quality.panel_shape(raw, src.CFG).collect()
    by_column = lambda df: sorted(map(tuple, df.collect()))
    assert by_column(gates.ranges) == by_column(quality.value_ranges(raw, with_median=False))
    assert by_column(gates.decode_loss) == by_column(quality.decode_loss(raw).select(*gates.decode_loss.columns))
    want = enrich.attach_static(events.inspection_events(clean_panel(raw, src.CFG), src.CFG), static, src.CFG)
    assert tuple(gates.match_rate.first()) == tuple(enrich.match_rate(want, "num_spans_main").first())
    assert rows.select(*want.columns).exceptAll(want).count() == 0 and rows.count() == want.count()
    _, empty = write_with_gates(raw.limit(0), None, src.CFG)
    assert empty.shape.first().rows == 0 and empty.ranges.collect() == [] and empty.match_rate.first().match_pct is None


def test_repeating_groups(spark):
    df = spark.createDataFrame([("a", "1", "2001", "3"), ("a", "2", "1999", "4"), ("a", "3", None, None), ("b", "1", "junk", "5"),
                                ("c", None, "2010", "6"), (None, "2", "2011", "7")], "k string, i string, y string, n string")
    out = enrich.repeating_groups(df, "k", "i", {"last_year": "y"}, {"approach": "n"})
    assert sorted(map(tuple, out.collect())) == [("a", 3, 2001.0, 4.0), ("b", 1, None, 0.0), ("c", 0, 2010.0, 0.0)]


def test_zones_by_range(spark):
    ranges = spark.createDataFrame([(1, 5, "dry"), (6, 6, "wet"), (9, 8, "none")], "low int, high int, zone string")
    df = spark.createDataFrame([("3",), ("6",), ("7",), (None,), ("x",)], "code string")
    out = enrich.attach_zone(df, "code", ranges)
    assert {r.code: r.climate_zone for r in out.collect()} == {"3": "dry", "6": "wet", "7": "unknown", None: "unknown", "x": "unknown"}
    with pytest.raises(ValueError, match="overlap at code 5"):
        enrich.zone_codes(ranges.unionByName(spark.createDataFrame([(5, 5, "odd")], ranges.schema)))
    with pytest.raises(ValueError, match="more than 3"):
        enrich.zone_codes(ranges, limit=3)


def test_outcomes_of_a_store_equal_those_of_events(spark):
    rows = stored(spark)
    deck = replace(src.CFG, components=("deck", "culvert"))
    bands = HorizonBands((0.0, 1.0, 7.0), ("near", "far"))
    a = pairs.outcome_counts(rows, deck, bands)
    b = pairs.outcome_counts(write_by_asset(rows, deck), deck, bands, stored_by_asset=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_cutoff_is_a_day(spark):
    assert isinstance(split.cutoff_day(stored(spark), src.CFG), datetime.date)


def test_gate_metrics_read_no_text(spark):
    """A metric is evaluated by itself: the numbers it counts are read from text before, once a row."""
    raw = spark.createDataFrame([("1", "01022001", "5", "9999", "12345678", "junk")],
                                "asset_id string, raw_date string, deck string, year_built string, latitude string, longitude string")
    metrics = store._source_metrics(raw)
    assert len(metrics) == 52 and not any("cast" in str(m).lower() for m in metrics)
    row, = store._with_source_values(raw, CFG).agg(*metrics).collect()
    assert (row.rows, row.parsed_rows, row.deck__out, row.year_built__out, row.latitude__lost_8, row.longitude__n) == (1, 1, 0, 1, 1, 0)
    kept, = store._with_source_values(raw.withColumn("latitude", F.lit("30595900")), CFG).agg(*metrics).collect()
    assert kept.latitude__lost_8 == 0


def test_subset_medians_come_from_one_pass(spark, monkeypatch):
    data = [(i, float(i * 7919 % 5003) if i % 11 else None, i % 3, float("nan") if i % 5 == 0 else float(i % 4)) for i in range(4000)]
    df = spark.createDataFrame(data, "i long, x double, k int, y double")
    subsets = {"all": F.lit(True), "odd": F.col("i") % 2 == 1, "k1": F.col("k") == 1, "none": F.col("i") < 0, "blank": F.lit(None).cast("boolean")}
    got = {r.subset: (r.x, r.y) for r in medians.subset_medians(df, subsets, ["x", "y"], default=0.0, bound=100).collect()}
    want = {n: tuple(medians_by(df.where(c), [], ["x", "y"]).first()) for n, c in subsets.items() if n not in ("none", "blank")}
    assert got == want
    monkeypatch.setattr(medians, "FEW_GROUPS", 0)
    assert {r.subset: (r.x, r.y) for r in medians.subset_medians(df, subsets, ["x", "y"], default=0.0, bound=100).collect()} == want
    passes = []
    monkeypatch.setattr(ml, "impute_values", lambda *a: passes.append(a) or features.impute_values(*a))
    rows = spark.createDataFrame([(f"a{i}", float(i % 9), float(i % 5), float(i)) for i in range(120)],
                                 "asset_id string, deck double, culvert double, adt double")
    models, _ = ml.fit_all_attributes(rows, CFG, TreeParams(rounds=1, depth=2), kinds=("linear",))
    assert set(models) == {"deck", "culvert"} and len(passes) == 1


def test_attributes_are_measured_at_full_size(spark, monkeypatch):
    sizes = []

    def fit(rows, cfg, params):
        sizes.append(params)
        return {}, spark.createDataFrame([("deck", "linear", 0.5, 0.5, 0.5, 0.5)],
                                         "component string, model_type string, mae double, rmse double, r2 double, within_1 double")

    monkeypatch.setattr(model_queries.ml, "fit_all_attributes", fit)
    monkeypatch.setattr(model_queries, "features", lambda s, d: spark.range(1).toDF("id"))
    assert {r.component for r in model_queries.attributes_only(spark, "/no/such/tables").collect()} == {"deck", "all"}
    assert sizes == [TreeParams()]


def test_rounds_are_checkpointed(spark, monkeypatch):
    used = []
    monkeypatch.setattr(ml, "with_checkpoints", lambda s: used.append(session.with_checkpoints(s)))
    rows = spark.createDataFrame([(f"a{i}", float(i % 9), float(i % 7)) for i in range(120)], "asset_id string, deck double, adt double")
    models, metrics = ml.fit_all_attributes(rows, CFG, TreeParams(rounds=12, depth=2), kinds=("boosted",))
    assert used and spark.sparkContext.getCheckpointDir() is not None
    assert models["deck"].models["boosted"].getNumTrees == 12 and metrics.count() == 1


def test_side_by_side_keeps_the_order():
    assert session.side_by_side([lambda i=i: i for i in range(9)], 4) == list(range(9))
    assert session.side_by_side([], 4) == []
    with pytest.raises(ZeroDivisionError):
        session.side_by_side([lambda: 1, lambda: 1 // 0], 2)
