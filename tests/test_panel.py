import datetime as dt
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wearline.config import EXTRACT_COLUMNS, HorizonBands, PanelConfig
from wearline.operators import clean, eav, enrich, events, features, pairs, quality, split
from wearline.operators.medians import medians_by
from wearline.sources import order_panel as src, readers, writers

CFG = replace(PanelConfig(), components=("deck",), min_pairs=5)


def panel(spark, rows, schema="asset_id string, raw_date string, deck double"):
    return spark.createDataFrame(rows, schema).withColumn(
        "snapshot_no", F.monotonically_increasing_id())


def test_clean_renames_coerces_and_drops(spark):
    cfg = replace(PanelConfig(), components=("deck", "culvert"))
    raw = spark.createDataFrame(
        [("A", 5152010, "N", "N", "5000", "State", 1), (" B ", 5152010, "7", None, "x", "City", 2)],
        "code string, raw_date int, deck string, culvert string, adt string, owner string, extra int")
    named = clean.rename_headers(raw, {"code": "asset_id", "absent": "nothing"})
    out = clean.clean_panel(named, cfg)
    assert "extra" not in out.columns
    row, = out.collect()
    assert (row.asset_id, row.deck, row.culvert, row.adt, row.owner) == ("B", 7.0, None, None, "City")
    gaps = clean.missing_columns(named, cfg)
    assert "asset_age" in gaps["engineered"] and "structure_kind" in gaps["from_extract"]
    assert "latitude" in gaps["absent"]


def test_events_collapse_and_pairs(spark):
    rows = [("A", "3211991", 7.0), ("A", "3211991", 7.0), ("A", "5152000", 6.0), ("B", "6011995", 8.0),
            ("nan", "6011995", 8.0), ("C", "junk", 8.0)]
    found = events.inspection_events(panel(spark, rows), CFG)
    assert sorted(r.asset_id for r in found.collect()) == ["A", "A", "B"]
    pair, = pairs.forward_pairs(found, CFG).collect()
    assert (pair.r0, pair.r1) == (7.0, 6.0) and 9.0 < pair.horizon < 9.4


def test_events_keep_the_smallest_tiebreak(spark):
    rows = [("A", "3211991", 5.0, 9), ("A", "3211991", 7.0, 2), ("A", "3211991", 6.0, 4)]
    df = spark.createDataFrame(rows, "asset_id string, raw_date string, deck double, snapshot_no int")
    row, = events.inspection_events(df, CFG).collect()
    assert row.deck == 7.0
    row, = events.latest_event(df, CFG).collect()
    assert row.deck == 7.0


def history(spark, assets=7, hot=200, seed=3):
    """A few short histories and one asset with a third or more of all inspections."""
    import random
    rng = random.Random(seed)
    start = dt.date(1996, 1, 1)
    out, n = [], 0
    for a in range(assets):
        for _ in range(hot if a == 0 else 30):
            day = start + dt.timedelta(days=rng.randrange(9000))
            out.append((f"A{a}", day.isoformat(), float(rng.randrange(10)), float(rng.choice([4, 7])),
                        1950.0 + a, n))
            n += 1
    schema = ("asset_id string, raw_date string, deck double, culvert double, year_built double, "
              "snapshot_no int")
    return out, spark.createDataFrame(out, schema)


def brute_pairs(data, limit=25 * 365.25):
    first = {}
    for asset, day, deck, culvert, built, n in data:
        first.setdefault((asset, day), (deck, culvert, built))
    by_asset = defaultdict(list)
    for (asset, day), values in first.items():
        by_asset[asset].append((dt.date.fromisoformat(day), values))
    for asset, items in by_asset.items():
        for d0, v0 in items:
            for d1, v1 in items:
                gap = (d1 - d0).days
                if 0 < gap <= limit:
                    for i, name in enumerate(("deck", "culvert")):
                        yield asset, name, d0, gap, v0[i], v1[i], v0[2]


@pytest.mark.parametrize("cuts", [(), (0.5, 1.5, 10.0)])
def test_counts_equal_brute_force_pairs(spark, cuts):
    cfg = replace(CFG, components=("deck", "culvert"))
    data, df = history(spark)
    bands = HorizonBands()
    edges = sorted({*bands.edges, *cuts})
    expected = defaultdict(int)
    for _, name, _, gap, r0, r1, _ in brute_pairs(data):
        upper = next(e for e in edges[1:] if gap / 365.25 <= e)
        expected[(name, r0, r1, upper)] += 1
    found = pairs.outcome_counts(events.inspection_events(df, cfg), cfg, bands, extra_edges=cuts)
    assert {(r.component, float(r.r0), float(r.r1), r.span): r.n for r in found.collect()} == expected


@pytest.mark.parametrize("split_above", [1024, 16])
def test_pairs_equal_brute_force(spark, split_above):
    cfg = replace(CFG, components=("deck", "culvert"))
    data, df = history(spark, assets=3, hot=60)
    expected = sorted((a, c, d0.isoformat(), gap, r0, r1) for a, c, d0, gap, r0, r1, _ in brute_pairs(data))
    rows = pairs.forward_pairs(events.inspection_events(df, cfg), cfg, split_above=split_above)
    found = rows.select("asset_id", "component", F.col("d0").cast("string"),
                        F.datediff("d1", "d0"), "r0", "r1").collect()
    assert sorted(tuple(r) for r in found) == expected


def test_off_scale_ratings_are_rows_of_their_own(spark):
    df = events.inspection_events(panel(spark, [("A", "3211991", 6.5), ("A", "5152000", 6.0), ("A", "7012003", 11.0)]), CFG)
    deck = replace(CFG, components=("deck",))
    found = pairs.outcome_counts(df, deck, HorizonBands(), off_scale=True).groupBy("r0", "r1").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, found.collect()), key=repr) == [(6, None, 1), (None, 6, 1), (None, None, 1)]
    assert pairs.outcome_counts(df, deck, HorizonBands()).collect() == []


def test_half_points_are_counted_on_their_own_scale(spark):
    df = events.inspection_events(panel(spark, [("A", "3211991", 6.5), ("A", "5152000", 6.0),
                                                ("A", "7012003", 6.5)]), CFG)
    deck = replace(CFG, components=("deck",))
    scale = pairs.occurring_ratings(df, deck)
    assert scale == [6.0, 6.5]
    found = pairs.outcome_counts(df, deck, HorizonBands(), ratings=scale).groupBy("r0", "r1").agg(
        F.sum("n").alias("n")).collect()
    assert sorted(map(tuple, found)) == [(6.0, 6.5, 1), (6.5, 6.0, 1), (6.5, 6.5, 1)]
    with pytest.raises(ValueError, match="more than 1"):
        pairs.occurring_ratings(df, deck, limit=1)


def test_cap_is_exact_and_repeatable(spark):
    cfg = replace(CFG, components=("deck", "culvert"))
    _, df = history(spark, assets=4, hot=80)
    rows = pairs.forward_pairs(events.inspection_events(df, cfg), cfg)
    a = pairs.cap_pairs(rows, cfg, 500)
    b = pairs.cap_pairs(rows.repartition(7), cfg, 500)
    key = ["component", "asset_id", "d0", "d1"]
    assert {r.component: r["count"] for r in a.groupBy("component").count().collect()} == \
        {"deck": 500, "culvert": 500}
    assert sorted(map(tuple, a.select(key).collect())) == sorted(map(tuple, b.select(key).collect()))
    assert pairs.cap_pairs(rows, cfg, 10**6).count() == rows.count()


def test_previous_ratings(spark):
    rows = [("A", "2000-05-15", 7.0), ("A", "2002-05-15", 7.0), ("A", "2004-05-15", 6.0),
            ("B", "2001-01-01", 8.0)]
    found = events.previous_ratings(events.inspection_events(panel(spark, rows), CFG), CFG).collect()
    assert sorted((r.previous_rating, r.rating) for r in found) == [(7.0, 6.0), (7.0, 7.0)]


def test_system_class_follows_the_last_flag(spark):
    schema = "asset_id string, raw_date string, deck double, on_system string"
    rows = [("A", "2000-01-01", 7.0, "ON"), ("A", "2010-01-01", 7.0, "OFF"),
            ("B", "2000-01-01", 7.0, "OFF"), ("B", "2001-01-01", 7.0, " on "),
            ("B", "2002-01-01", 7.0, None), ("C", "2000-01-01", 7.0, "ON")]
    row, = events.system_counts(panel(spark, rows, schema), CFG).collect()
    assert row.asDict() == {"on_assets": 2, "off_assets": 1, "reclassified_assets": 2, "assets": 3}


def test_qualified_history_never_multiplies(spark):
    hist = spark.createDataFrame([(" 1 ", "x"), ("1", "y"), ("2", "z")], "id string, v string")
    core = spark.createDataFrame([(10, "1"), (11, "1"), (12, "2")], "link int, num string")
    qual = spark.createDataFrame([(10,), (10,), (11,)], "link int")
    found = events.qualified_history(hist, core, qual, key="id", core_key="num", link="link")
    assert sorted(r.v for r in found.collect()) == ["x", "y"]


def extract_line(as_id, **values):
    return tuple(values.get(c, as_id if c == "as_id" else "NULL") for c in EXTRACT_COLUMNS)


def test_extract_with_and_without_header(spark, tmp_path):
    lines = [extract_line("0001", num_spans_main="4", deck_type="C01", scour_vulnerability="A"),
             extract_line("0002", num_spans_main="2", deck_type="0", scour_vulnerability="B")]
    assert len(EXTRACT_COLUMNS) == 41
    plain, headed = tmp_path / "plain.csv", tmp_path / "headed.csv"
    body = "\n".join(",".join(line) for line in lines) + "\n"
    plain.write_text(body)
    headed.write_text(", ".join(EXTRACT_COLUMNS) + "\n" + body)
    a = readers.read_extract(spark, str(plain))
    b = readers.read_extract(spark, str(headed), has_header=True)
    assert a.collect() == b.collect()
    static = enrich.static_attributes(a, CFG, "as_id", ["as_id"])
    one = {r.asset_id: r for r in static.collect()}
    assert one["0001"].num_spans_main == 4.0 and one["0001"].deck_type == "C01"
    assert one["0002"].structure_kind is None
    base = spark.createDataFrame([("0001", 1), ("0009", 2)], "asset_id string, num_beam_lines int")
    joined = {r.asset_id: r for r in enrich.attach_static(base, static, CFG).collect()}
    assert joined["0009"].num_spans_main is None and joined["0001"].num_beam_lines == 1
    assert readers.read_optional_extract(spark, str(tmp_path / "none.csv")) is None
    assert enrich.attach_static(base, None, CFG) is base
    with pytest.raises(Exception):
        readers.read_optional_extract(spark, str(tmp_path / "none.csv"), strict=True)


def test_extract_status_rules_and_uniqueness(spark):
    assets = spark.createDataFrame(
        [(i, f"{i % 3}{i:013d}", 1, 0, 0, s) for i, s in ((1, 0), (2, 1), (3, 2), (4, 1))],
        "as_id int, as_code string, at_id int, as_root int, as_deleted int, asset_status_id int")
    statuses = spark.createDataFrame([(0,), (1,), (2,)], "asset_status_id int")
    values = spark.createDataFrame(
        [(1, 2005800, "6"), (2, 2005800, "6"), (3, 2300701, "7"), (4, 2300701, "5"), (4, 1, "z")],
        "as_id int, fe_id int, cv_value string")
    out = {r.as_id: r for r in eav.attribute_extract(assets, statuses, values, PanelConfig()).collect()}
    assert (out[1].deck, out[2].deck, out[3].deck, out[4].deck) == ("6", None, None, "5")
    doubled = values.unionByName(values.limit(1))
    row, = quality.duplicate_keys(doubled, ["as_id", "fe_id"]).collect()
    assert (row["keys"], row.repeated_keys, row.surplus_rows) == (5, 1, 1)


def test_keyword_search_ignores_case(spark):
    names = spark.createDataFrame([(1, "Deck Width"), (2, "Paint"), (3, "SKEW angle")],
                                  "fe_id int, fe_name string")
    assert [r.fe_id for r in eav.search_names(names).collect()] == [1, 3]
    assert [r.fe_id for r in eav.lookup_features(names, [3, 2]).collect()] == [2, 3]


def test_engineered_features(spark):
    df = spark.createDataFrame(
        [("5152010", 1990.0, 0.0, 100.0, 10.0, 5000.0), ("5152010", 110.0, 2015.0, 200.0, 20.0, 20000.0),
         ("5152010", 9650.0, 2000.0, 300.0, 0.0, 1000.0), ("5152010", 1970.0, 2000.0, None, 1.0, 1.0)],
        "raw_date string, year_built double, year_reconstructed double, structure_length double, "
        "deck_width double, adt double")
    a, b, c, d = features.engineer(df, CFG).collect()
    assert (a.asset_age, a.years_since_reconstruction, a.deck_area, a.traffic_density) == (20, 20, 1000, 5)
    assert (b.year_built, b.asset_age, b.years_since_reconstruction) == (None, None, 0)
    assert (c.year_built, c.asset_age, c.traffic_density) == (None, None, None)
    assert (d.asset_age, d.years_since_reconstruction, d.deck_area) == (40, 10, None)
    dated = df.withColumn("deck", F.lit(5.0))
    assert not {"deck", "raw_date"} & set(features.model_columns(dated, CFG))


def test_future_projection(spark):
    schema = ("asset_id string, year_built double, year_reconstructed int, asset_age int, "
              "years_since_reconstruction int")
    df = spark.createDataFrame([("a", 1980.0, 0, 46, 46), ("b", 1980.0, 2010, 46, 16),
                                ("c", None, 0, 46, 46), ("d", 2060.0, 0, 0, 0)], schema)
    out = {r.asset_id: r for r in features.project_to_year(df, 2050, CFG).collect()}
    assert (out["a"].asset_age, out["a"].years_since_reconstruction) == (70, 70)
    assert (out["b"].asset_age, out["b"].years_since_reconstruction) == (70, 40)
    assert not out["c"].projectable and out["d"].asset_age == 0


def test_codes_and_alignment(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "owner string")
    codes = features.category_codes(train, ["owner"])
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "owner string")
    found = {r.owner: r.owner_idx for r in features.apply_codes(new, codes, ["owner"]).collect()}
    assert found == {"a": 0.0, "b": 1.0, "z": None, None: None}
    out = features.align(new, ["x"], ["owner"])
    assert out.columns == ["x", "owner"] and out.where("x IS NOT NULL").count() == 0


def test_medians_match_a_plain_median(spark):
    import random
    import statistics
    rng = random.Random(5)
    data = [(f"g{min(i % 7, 2)}", rng.choice([float(rng.randrange(9)), rng.random() * 1000]),
             None if i % 3 else 1.5) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x double, y double").withColumn(
        "z", F.lit(None).cast("double"))
    out = {r.g: r for r in medians_by(df, ["g"], ["x", "y", "z"], default=0.0).collect()}
    for g in ("g0", "g1", "g2"):
        assert out[g].x == statistics.median(x for k, x, _ in data if k == g)
        assert out[g].y == 1.5 and out[g].z == 0.0
    many = spark.range(300_001).select((F.col("id") * F.col("id") % 999_983).cast("double").alias("x"))
    row, = medians_by(many, [], ["x"]).collect()
    assert row.x == statistics.median(float(i * i % 999_983) for i in range(300_001))
    row, = medians_by(spark.createDataFrame([(None,)], "x double"), [], ["x"], default=0.0).collect()
    assert row.x == 0.0
    row, = medians_by(spark.createDataFrame([(20.0,), (30.0,)], "x double"), [], ["x"]).collect()
    assert row.x == 25.0


def test_group_split_does_not_leak(spark):
    df = spark.range(2000).withColumn("asset_id", (F.col("id") % 400).cast("string"))
    sides = split.with_split(df, CFG).groupBy("asset_id").agg(
        F.countDistinct("is_test").alias("sides"), F.max("is_test").alias("t"))
    assert sides.where("sides > 1").count() == 0
    assert 0.2 < sides.where("t").count() / 400 < 0.4
    folds = df.withColumn("f", split.fold_of(CFG, 3)).groupBy("asset_id").agg(
        F.countDistinct("f").alias("n"))
    assert folds.where("n > 1").count() == 0


def test_coverage(spark):
    df = spark.createDataFrame([("r", 1, None), ("r", None, None)], "region string, a int, b int")
    one, two = enrich.with_coverage(df, ["a", "b", "absent"]).orderBy("feat_present").collect()
    assert (one.feat_present, one.feat_missing) == (0, [0, 1, 2])
    assert (two.feat_present, two.feat_missing, two.feat_total) == (1, [1, 2], 3)


def test_panel_gate_tells_history_from_current_values(spark):
    many = [("A", f"20{y:02d}-01-01", 7.0) for y in range(4)] + [("B", f"20{y:02d}-01-01", 7.0) for y in range(3)]
    row, = quality.panel_shape(panel(spark, many), CFG).collect()
    assert row.is_panel and row.dated_inspections == 7 and row.assets == 2
    row, = quality.panel_shape(panel(spark, [("A", "2000-01-01", 7.0), ("B", "junk", 7.0)]), CFG).collect()
    assert not row.is_panel and row.parsed_rows == 1
    assert quality.required_columns(panel(spark, many), CFG) == ["on_system", "region"]


def test_range_gate_and_decode_loss(spark):
    df = spark.createDataFrame([(29153429.0, 5.0), (30.0, 5.0), (0.0, 12.0), (12345678.0, 1.0)],
                               "latitude double, deck double")
    flags = {r.column: r for r in quality.value_ranges(df).collect()}
    assert flags["latitude"].out_of_range and flags["latitude"].outside_pct == 75.0
    assert flags["deck"].median == 5.0
    loss = {(r.column, r.digits): (r.implausible, r.recorded_as_zero)
            for r in quality.decode_loss(df, ["latitude"]).collect()}
    assert loss == {("latitude", 8): (1, 0), ("latitude", 0): (0, 1)}


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "01", "deck"), ("2", "A/B", "deck")],
                               "ASSET_ID string, region string, component string")
    df.createOrReplaceTempView("history_view")
    low = readers.read_source(spark, table="history_view", id_columns=["asset_id"])
    assert low.columns == ["asset_id", "region", "component"]
    found = readers.read_source(spark, query="SELECT ASSET_ID AS A FROM history_view")
    assert found.columns == ["a"]
    with pytest.raises(ValueError):
        readers.read_source(spark)
    assert readers.restrict(low, "region", ["01", "it's"]).count() == 1
    writers.write_by_region(low, str(tmp_path), "all")
    writers.write_by_region(low.where("region = '01'"), str(tmp_path), "on")
    writers.write_by_region(low.where("region = '01'").withColumn("asset_id", F.lit("9")),
                            str(tmp_path), "all")
    back = spark.read.schema("asset_id string, region string, component string, scope string, "
                             "region_folder string").parquet(f"{tmp_path}/regions")
    assert sorted((r.asset_id, r.scope, r.region_folder) for r in back.collect()) == \
        [("1", "on", "01"), ("2", "all", "A_B"), ("9", "all", "01")]
    writers.write_watchlist(low, str(tmp_path))
    path = writers.write_payload(low, str(tmp_path))
    assert spark.read.text(path).count() == 2
    ids = tmp_path / "ids.txt"
    ids.write_text(" 1 \n\n2\n")
    assert sorted(r.asset_id for r in readers.read_id_list(spark, str(ids)).collect()) == ["1", "2"]
    assert sorted(r.asset_id for r in readers.split_id_list(spark, "1, ,2").collect()) == ["1", "2"]


def test_pivot_deals_rows_before_sorting(spark, tmp_path):
    """No task sorts all that a file holds: parts are spread, and values are dealt by asset."""
    spark.range(60_000).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    values = src.attribute_values(spark, str(tmp_path))
    sizes = [r["count"] for r in values.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 * 39 and max(sizes) <= 39 * src.PARTS_PER_TASK * 1.2
    rows = [(1, 2300701, str(i % 7)) for i in range(500)] + [(2, 2300701, None), (2, 2300702, "4"), (None, 2300702, "5"), (3, 99, "1")]
    wide = eav.pivot_features(spark.createDataFrame(rows, "as_id long, fe_id int, cv_value string"))
    assert "rebalance" in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {(r.as_id, r.deck, r.superstructure) for r in wide.collect()} == {(1, "6", None), (2, None, "4"), (None, None, "5")}
