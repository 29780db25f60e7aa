"""Registered queries on scans, cleaning, events, pairs, attributes and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.catalogue.sql import COMPONENTS, DIRECT_PAIRS, clip, degrees, is_test, number, share_bucket, sql
from wearline.config import EXTRACT_COLUMNS, EXTRACT_FEATURES, PLAUSIBLE_RANGES
from wearline.functions.dates import inspection_date
from wearline.functions.numbers import half_even
from wearline.operators import clean, eav, enrich, events, features, pairs, quality, split
from wearline.operators.metrics import grouped_summary
from wearline.session import once, settle, work_path
from wearline.sources import order_panel as src
from wearline.sources import readers, writers

CFG = src.CFG
PANEL_NUMBERS = ("year_built", "year_reconstructed", "adt", "structure_length", "deck_width",
                 "skew_angle", "latitude", "longitude", "inventory_load", "operating_load")


def panel(spark, sf_dir) -> DataFrame:
    return clean.clean_panel(src.raw_panel(spark, sf_dir), CFG)


def event_rows(spark, sf_dir) -> DataFrame:
    return events.inspection_events(panel(spark, sf_dir), CFG)


def static_rows(spark, sf_dir) -> DataFrame:
    return enrich.static_attributes(src.extract_rows(spark, sf_dir), CFG, "as_id", src.EXTRACT_ORDER)


def stored_events(spark, sf_dir) -> DataFrame:
    """Events with their attributes, written once: most later queries read them more than once."""
    return once(spark, "events", sf_dir, lambda: settle(enrich.attach_static(
        event_rows(spark, sf_dir), static_rows(spark, sf_dir), CFG), "events"))


def day(name: str):
    return F.col(name).cast("string")


def places(df: DataFrame, *names: str, to: int = 6) -> DataFrame:
    return df.withColumns({n: half_even(F.col(n), to) for n in names})


def clean_panel(spark, sf_dir):
    return places(panel(spark, sf_dir), "latitude", "longitude")


CLEAN_SQL = sql(f"""SELECT asset_id, raw_date, snapshot_no, on_system, {', '.join(COMPONENTS)}, region,
  {', '.join(n for n in PANEL_NUMBERS if n not in ('latitude', 'longitude'))},
  round_even(latitude, 6) AS latitude, round_even(longitude, 6) AS longitude, owner, functional_class
FROM panel""", "panel")


def decode_packed_coordinates(spark, sf_dir):
    raw = src.raw_panel(spark, sf_dir)
    decoded = clean.clean_panel(raw, CFG).select(
        "snapshot_no", "latitude", "longitude", "inventory_load", "operating_load")
    return places(decoded, "latitude", "longitude", "inventory_load", "operating_load")


DECODE_SQL = sql("""SELECT snapshot_no, round_even(latitude, 6) AS latitude,
  round_even(longitude, 6) AS longitude, round_even(inventory_load, 6) AS inventory_load,
  round_even(operating_load, 6) AS operating_load FROM panel""", "panel")


def parse_mixed_dates(spark, sf_dir):
    parsed = inspection_date(F.col("raw_date"))
    return src.mixed_dates(spark, sf_dir).select(
        "snapshot_no", "raw_date", parsed.cast("string").alias("event_date"),
        F.year(parsed).cast("double").alias("event_year"))


DATES_SQL = """WITH written AS (
  SELECT o_orderkey AS snapshot_no, CASE o_orderkey % 6
    WHEN 0 THEN CAST(CAST(strftime(o_orderdate, '%m%d%Y') AS BIGINT) AS VARCHAR)
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 3 THEN 'junk'
    WHEN 4 THEN CAST(CAST(strftime(o_orderdate, '%m%d%Y') AS BIGINT) AS VARCHAR) || '.0'
    ELSE strftime(o_orderdate, '%Y') END AS raw_date FROM orders),
parsed AS (
  SELECT *, CASE WHEN regexp_full_match(t, '[0-9]{1,8}') THEN try_strptime(lpad(t, 8, '0'), '%m%d%Y')
    ELSE coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%m/%d/%Y')) END AS d
  FROM (SELECT *, regexp_replace(raw_date, '[.]0$', '') AS t FROM written))
SELECT snapshot_no, raw_date, strftime(d, '%Y-%m-%d') AS event_date, CAST(year(d) AS DOUBLE) AS event_year
FROM parsed"""

EVENT_COLUMNS = ("asset_id", "snapshot_no", *COMPONENTS, "region", "on_system")


def inspection_events(spark, sf_dir):
    return event_rows(spark, sf_dir).select(*EVENT_COLUMNS, day("event_date").alias("event_date"))


def latest_event(spark, sf_dir):
    return events.latest_event(panel(spark, sf_dir), CFG).select(
        *EVENT_COLUMNS, day("event_date").alias("event_date"))


def _event_sql(name):
    return sql(f"SELECT {', '.join(EVENT_COLUMNS)}, strftime(event_date, '%Y-%m-%d') AS event_date "
               f"FROM {name}", "events")


def system_classification(spark, sf_dir):
    return events.system_counts(panel(spark, sf_dir), CFG)


SYSTEM_SQL = sql("""SELECT count(*) FILTER (last_flag = 'ON') AS on_assets,
  count(*) FILTER (last_flag <> 'ON') AS off_assets,
  count(*) FILTER (ever_on AND ever_off) AS reclassified_assets, count(*) AS assets
FROM (SELECT asset_id, arg_max(on_system, (event_date, snapshot_no)) AS last_flag,
        bool_or(on_system = 'ON') AS ever_on, bool_or(on_system <> 'ON') AS ever_off
      FROM dated WHERE event_date IS NOT NULL GROUP BY asset_id)""", "events")


def region_scope(spark, sf_dir):
    """The latest record of on-system assets of one region, classified by that record."""
    latest = events.latest_event(panel(spark, sf_dir), CFG)
    rows = events.on_system_rows(events.in_region(latest, CFG, " 7 "), CFG)
    return rows.select("asset_id", "region", "on_system", day("event_date").alias("event_date"))


SCOPE_SQL = sql("""SELECT asset_id, region, on_system, strftime(event_date, '%Y-%m-%d') AS event_date
FROM latest WHERE region = '7' AND on_system = 'ON'""", "events")


def forward_pairs(spark, sf_dir):
    rows = pairs.forward_pairs(stored_events(spark, sf_dir), CFG)
    return places(rows.select("asset_id", "component", day("d0").alias("d0"), day("d1").alias("d1"),
                              "horizon", "r0", "r1", "age_t0"), "horizon")


PAIR_COLUMNS = """asset_id, component, strftime(d0, '%Y-%m-%d') AS d0, strftime(d1, '%Y-%m-%d') AS d1,
  round_even(horizon, 6) AS horizon, r0, r1, age_t0"""


def pairs_capped(spark, sf_dir):
    rows = pairs.cap_pairs(pairs.forward_pairs(stored_events(spark, sf_dir), CFG), CFG)
    return rows.select("asset_id", "component", day("d0").alias("d0"), day("d1").alias("d1"), "r0", "r1")


CAPPED_SQL = sql("""SELECT asset_id, component, strftime(d0, '%Y-%m-%d') AS d0,
  strftime(d1, '%Y-%m-%d') AS d1, r0, r1 FROM pairs
QUALIFY row_number() OVER (PARTITION BY component ORDER BY md5(asset_id || '|' || component || '|'
  || strftime(d0, '%Y-%m-%d') || '|' || strftime(d1, '%Y-%m-%d') || '|42')) <= 5000""", "long")

STATIC_COLUMNS = ("num_spans_main", "num_beam_lines", "structure_kind", "wearing_surface",
                  "scour_vulnerability")


def attach_static(spark, sf_dir):
    rows = enrich.attach_static(event_rows(spark, sf_dir), static_rows(spark, sf_dir), CFG)
    return rows.select("asset_id", day("event_date").alias("event_date"), *STATIC_COLUMNS)


ATTACH_SQL = sql(f"""SELECT asset_id, strftime(event_date, '%Y-%m-%d') AS event_date,
  {', '.join(STATIC_COLUMNS)} FROM events LEFT JOIN static USING (asset_id)""", "events", "static")


def static_match_rate(spark, sf_dir):
    rows = enrich.attach_static(event_rows(spark, sf_dir), static_rows(spark, sf_dir), CFG)
    return places(enrich.match_rate(rows, "num_spans_main"), "match_pct")


MATCH_SQL = sql("""SELECT count(*) AS rows, count(num_spans_main) AS matched,
  round_even(count(num_spans_main) * 100.0::DOUBLE / count(*), 6) AS match_pct
FROM events LEFT JOIN static USING (asset_id)""", "events", "static")


def eav_pivot(spark, sf_dir):
    return eav.attribute_extract(src.assets(spark, sf_dir), src.statuses(spark, sf_dir),
                                 src.attribute_values(spark, sf_dir), CFG)


def _eav_sql():
    def value(name):
        fid = EXTRACT_FEATURES[name]
        return f"max(cv_value) FILTER (fe_id = {fid})"

    def column(name):
        if name in ("as_id", "as_code"):
            return f"a.{name}"
        if name in COMPONENTS:
            return (f"CASE WHEN asset_status_id = 2 THEN NULL WHEN asset_status_id = 0 "
                    f"THEN coalesce({value(name)}, {value(name + '_legacy')}) "
                    f"ELSE {value(name)} END AS {name}")
        if name in EXTRACT_FEATURES:
            return f"{value(name)} AS {name}"
        return f"CAST(NULL AS VARCHAR) AS {name}"

    return sql(f"""SELECT {', '.join(column(c) for c in EXTRACT_COLUMNS)}
FROM assets a LEFT JOIN attribute_values v ON a.as_id = v.as_id
WHERE at_id = 1 AND left(as_code, 1) IN ('0', '1', '2') AND as_code <> '0' AND as_root = 0
  AND length(as_code) IN (14, 15) AND as_deleted = 0 AND as_code NOT LIKE '%test%'
  AND as_code NOT LIKE '%##%' AND asset_status_id IN (0, 1, 2)
  AND asset_status_id IN (SELECT r_regionkey FROM region)
GROUP BY a.as_id, as_code, asset_status_id""", "eav")


def keyword_lookup(spark, sf_dir):
    parts = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("fe_id"), F.upper("p_name").alias("fe_name"))
    return eav.search_names(parts, ("ring", "red w", "bolt"))


KEYWORD_SQL = """SELECT p_partkey AS fe_id, upper(p_name) AS fe_name FROM part
WHERE p_name ILIKE '%ring%' OR p_name ILIKE '%red w%' OR p_name ILIKE '%bolt%'
ORDER BY fe_name, fe_id"""


def feature_top(spark, sf_dir):
    return eav.lookup_features(src.attribute_values(spark, sf_dir),
                               (2303005, 2303007, 2303010, 2303011, 2303012), 20, ("as_id", "fe_id"))


TOP_SQL = sql("""SELECT as_id, fe_id, cv_value FROM attribute_values
WHERE fe_id IN (2303005, 2303007, 2303010, 2303011, 2303012) ORDER BY as_id, fe_id LIMIT 20""", "eav")


def qualified_history(spark, sf_dir):
    core = src.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("link"), src.asset_code(F.col("o_custkey")).alias("number"))
    qualifier = src.table(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        & (F.col("l_quantity") >= 45)).select(F.col("l_orderkey").alias("link"))
    history = src.raw_panel(spark, sf_dir)
    return events.qualified_history(history, core, qualifier, key="asset_id", core_key="number",
                                    link="link")


QUALIFIED_SQL = sql("""SELECT * FROM raw
WHERE trim(asset_id) IN (SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders
  JOIN lineitem ON o_orderkey = l_orderkey
  WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 45)""", "raw")


def id_list_semi_join(spark, sf_dir):
    """Latest rows of a requested id list that is written and read back as text."""
    wanted = src.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.concat(F.lit("  "), src.asset_code(F.col("c_custkey"))).alias("value"))
    path = work_path(spark, "ids")
    wanted.write.text(path)
    ids = readers.read_id_list(spark, path)
    latest = events.latest_event(panel(spark, sf_dir), CFG)
    return events.in_id_set(latest, ids, "asset_id", "asset_id").select(
        "asset_id", day("event_date").alias("event_date"), "deck")


IDS_SQL = sql("""SELECT asset_id, strftime(event_date, '%Y-%m-%d') AS event_date, deck FROM latest
WHERE asset_id IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') FROM customer WHERE c_acctbal < 0)""",
              "events")

AGE_COLUMNS = ("year_built", "asset_age", "years_since_reconstruction", "deck_area",
               "traffic_density")


def age_features(spark, sf_dir):
    rows = features.engineer(panel(spark, sf_dir), CFG)
    return places(rows.select("snapshot_no", *AGE_COLUMNS), "traffic_density")


AGE_SQL = sql(f"""SELECT snapshot_no, yb AS year_built, {clip('(y - yb)')} AS asset_age,
  CASE WHEN year_reconstructed > 0 THEN {clip('(y - year_reconstructed)')}
       ELSE {clip('(y - yb)')} END AS years_since_reconstruction,
  structure_length * deck_width AS deck_area,
  round_even(adt / nullif(structure_length * deck_width, 0), 6) AS traffic_density
FROM (SELECT *, year(event_date) AS y,
        CASE WHEN year_built >= 1900 AND year_built <= year(event_date) THEN year_built END AS yb
      FROM dated)""", "events")


def future_projection(spark, sf_dir):
    latest = features.engineer(events.latest_event(panel(spark, sf_dir), CFG), CFG)
    future = features.project_to_year(latest, 2030, CFG)
    return future.select("asset_id", "projectable", "asset_age", "years_since_reconstruction")


FUTURE_SQL = sql(f"""SELECT asset_id, yb IS NOT NULL AS projectable,
  CASE WHEN yb IS NOT NULL THEN {clip('(2030 - yb)')} END AS asset_age,
  CASE WHEN yb IS NOT NULL AND year_reconstructed > 0 THEN {clip('(2030 - year_reconstructed)')}
       WHEN yb IS NOT NULL THEN {clip('(2030 - yb)')}
       WHEN year_reconstructed > 0 THEN {clip('(year(event_date) - year_reconstructed)')}
  END AS years_since_reconstruction
FROM (SELECT *, CASE WHEN year_built >= 1900 AND year_built <= year(event_date) THEN year_built END AS yb
      FROM latest)""", "events")


def aligned_features(spark, sf_dir):
    """Model columns of an engineered panel, aligned to a list with two it does not have."""
    rows = features.engineer(panel(spark, sf_dir), CFG)
    wanted = [*features.model_columns(rows, CFG), "num_beam_lines", "adt_truck"]
    return places(features.align(rows, wanted, keep=["snapshot_no"]),
                  "latitude", "longitude", "traffic_density", "inventory_load", "operating_load")


ALIGNED_SQL = sql(f"""SELECT snapshot_no, yb AS year_built, year_reconstructed, adt, structure_length,
  deck_width, skew_angle, round_even(latitude, 6) AS latitude, round_even(longitude, 6) AS longitude,
  round_even(inventory_load, 6) AS inventory_load, round_even(operating_load, 6) AS operating_load,
  {clip('(y - yb)')} AS asset_age,
  CASE WHEN year_reconstructed > 0 THEN {clip('(y - year_reconstructed)')}
       ELSE {clip('(y - yb)')} END AS years_since_reconstruction,
  structure_length * deck_width AS deck_area,
  round_even(adt / nullif(structure_length * deck_width, 0), 6) AS traffic_density,
  CAST(NULL AS DOUBLE) AS num_beam_lines, CAST(NULL AS DOUBLE) AS adt_truck
FROM (SELECT *, year(event_date) AS y,
        CASE WHEN year_built >= 1900 AND year_built <= year(event_date) THEN year_built END AS yb
      FROM dated)""", "events")


def csv_roundtrip(spark, sf_dir):
    """Panel as CSV and parquet, attributes as headerless CSV; read back, cleaned and joined."""
    root = work_path(spark, "roundtrip")
    raw = src.raw_panel(spark, sf_dir)
    raw.write.option("header", True).csv(f"{root}/raw", ignoreLeadingWhiteSpace=False,
                                         ignoreTrailingWhiteSpace=False)
    back = readers.read_panel(spark, f"{root}/raw", "csv", src.RAW_COLUMNS).withColumn(
        "snapshot_no", F.col("snapshot_no").cast("bigint"))
    stored = spark.read.parquet(writers.write_panel(clean.clean_panel(back, CFG), root))
    columns = ("as_id", "row_order", *STATIC_COLUMNS)
    src.extract_rows(spark, sf_dir).select(*columns).na.fill("NULL").write.csv(f"{root}/extract")
    extract = readers.read_optional_extract(spark, f"{root}/extract", columns=columns).withColumn(
        "row_order", F.col("row_order").cast("bigint"))
    static = enrich.static_attributes(extract, CFG, "as_id", src.EXTRACT_ORDER)
    joined = enrich.attach_static(stored, static, CFG)
    return joined.select("asset_id", "snapshot_no", "deck", "culvert", "region", "adt", *STATIC_COLUMNS)


ROUNDTRIP_SQL = sql(f"""SELECT asset_id, snapshot_no, deck, culvert, region, adt,
  {', '.join(STATIC_COLUMNS)} FROM panel LEFT JOIN static USING (asset_id)""", "panel", "static")


def group_split_check(spark, sf_dir):
    """Sizes of both sides and the number of assets found on both."""
    rows = split.with_split(event_rows(spark, sf_dir), CFG)
    sides = rows.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("in_test"))
    leak = (F.col("in_test") > 0) & (F.col("in_test") < F.col("n"))
    out = sides.agg(
        F.count(F.lit(1)).alias("assets"), F.count_if(F.col("in_test") > 0).alias("test_assets"),
        F.count_if(leak).alias("leaking_assets"), F.sum("n").alias("rows"),
        F.sum("in_test").alias("test_rows"))
    return out.withColumn("test_share", half_even(F.col("test_assets") / F.col("assets"), 6))


SPLIT_SQL = sql(f"""SELECT count(*) AS assets, count(*) FILTER (in_test > 0) AS test_assets,
  count(*) FILTER (in_test > 0 AND in_test < n) AS leaking_assets, CAST(sum(n) AS BIGINT) AS rows,
  CAST(sum(in_test) AS BIGINT) AS test_rows,
  round_even(count(*) FILTER (in_test > 0) / CAST(count(*) AS DOUBLE), 6) AS test_share
FROM (SELECT asset_id, count(*) AS n, count(*) FILTER ({is_test()}) AS in_test
      FROM events GROUP BY asset_id)""", "events")


def category_codes(spark, sf_dir):
    """Codes learned on training rows, applied to all; an unseen category gets none."""
    rows = split.with_split(panel(spark, sf_dir), CFG)
    trained = rows.where(~F.col("is_test") & (F.col("owner") != "HOUSEHOLD"))
    names = ["owner", "functional_class"]
    codes = features.category_codes(trained, names)
    return features.apply_codes(rows, codes, names).select(
        "snapshot_no", "owner", "functional_class", "owner_idx", "functional_class_idx")


CODES_SQL = sql(f"""SELECT snapshot_no, p.owner, p.functional_class, CAST(o.code AS DOUBLE) AS owner_idx,
  CAST(f.code AS DOUBLE) AS functional_class_idx
FROM panel p
LEFT JOIN (SELECT owner, row_number() OVER (ORDER BY owner) - 1 AS code FROM
  (SELECT DISTINCT owner FROM panel WHERE NOT {is_test()} AND owner <> 'HOUSEHOLD')) o USING (owner)
LEFT JOIN (SELECT functional_class, row_number() OVER (ORDER BY functional_class) - 1 AS code FROM
  (SELECT DISTINCT functional_class FROM panel WHERE NOT {is_test()} AND owner <> 'HOUSEHOLD')) f
  USING (functional_class)""", "panel")


def impute_medians(spark, sf_dir):
    rows = split.with_split(panel(spark, sf_dir), CFG).where(~F.col("is_test"))
    rows = rows.withColumn("adt_truck", F.lit(None).cast("double"))
    return places(features.impute_values(rows, [*PANEL_NUMBERS, "adt_truck"]),
                  "latitude", "longitude", "inventory_load", "operating_load")


IMPUTE_SQL = sql(f"""SELECT {', '.join(
    f'round_even(coalesce(median({c}), 0), 6) AS {c}' if c in
    ('latitude', 'longitude', 'inventory_load', 'operating_load')
    else f'coalesce(median({c}), 0) AS {c}' for c in PANEL_NUMBERS)},
  CAST(0 AS DOUBLE) AS adt_truck FROM panel WHERE NOT {is_test()}""", "panel")


def region_summary(spark, sf_dir):
    values = ["deck", "superstructure", "substructure", "adt"]
    out = grouped_summary(panel(spark, sf_dir), ["region", "climate_zone"], values)
    return places(out, *[f"{v}_mean" for v in values])


SUMMARY_SQL = sql("SELECT region, " + ", ".join(
    f"round_even(avg({v}), 6) AS {v}_mean, median({v}) AS {v}_median, count({v}) AS {v}_count"
    for v in ("deck", "superstructure", "substructure", "adt")) + " FROM panel GROUP BY region",
    "panel")

COVERED = ("adt", "latitude", "longitude", "structure_kind", "num_spans_main", "adt_truck",
           "wearing_surface", "year_reconstructed")


def _covered(spark, sf_dir):
    latest = events.latest_event(panel(spark, sf_dir), CFG)
    return enrich.with_coverage(enrich.attach_static(latest, static_rows(spark, sf_dir), CFG), COVERED)


def attribute_coverage(spark, sf_dir):
    return _covered(spark, sf_dir).select(
        "asset_id", "region", F.col("feat_total").cast("bigint").alias("feat_total"),
        F.col("feat_present").cast("bigint").alias("feat_present"),
        F.array_join(F.transform("feat_missing", lambda i: i.cast("string")), ",").alias("feat_missing"))


def _coverage_sql(source):
    from_source = f"{source} LEFT JOIN static USING (asset_id)"
    columns = [c if c != "adt_truck" else "CAST(NULL AS DOUBLE)" for c in COVERED]
    present = " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in columns)
    missing = ", ".join(f"CASE WHEN {c} IS NULL THEN '{i}' END" for i, c in enumerate(columns))
    return f"""SELECT asset_id, region, CAST({len(columns)} AS BIGINT) AS feat_total,
  {present} AS feat_present,
  array_to_string(list_filter([{missing}], lambda x: x IS NOT NULL)[1:6], ',') AS feat_missing
FROM {from_source}"""


COVERAGE_SQL = sql(_coverage_sql("latest"), "events", "static")


def region_coverage(spark, sf_dir):
    return places(enrich.coverage_by(_covered(spark, sf_dir), ["region"]), "coverage_pct")


REGION_COVERAGE_SQL = sql(f"""SELECT region, count(*) AS assets,
  round_even(avg(feat_present / CAST(feat_total AS DOUBLE)) * 100, 6) AS coverage_pct
FROM ({_coverage_sql('latest')}) GROUP BY region""", "events", "static")


def panel_shape_gate(spark, sf_dir):
    out = quality.panel_shape(src.raw_panel(spark, sf_dir), CFG)
    return places(out.withColumns({"first_date": day("first_date"), "last_date": day("last_date")}),
                  "inspections_per_asset")


SHAPE_SQL = sql("""SELECT count(*) AS rows, count(DISTINCT asset_id) AS assets,
  count(event_date) AS parsed_rows, strftime(min(event_date), '%Y-%m-%d') AS first_date,
  strftime(max(event_date), '%Y-%m-%d') AS last_date,
  count(DISTINCT (asset_id, event_date)) FILTER (event_date IS NOT NULL) AS dated_inspections,
  round_even(count(DISTINCT (asset_id, event_date)) FILTER (event_date IS NOT NULL)
    / CAST(count(DISTINCT asset_id) FILTER (event_date IS NOT NULL) AS DOUBLE), 6) AS inspections_per_asset,
  count(DISTINCT (asset_id, event_date)) FILTER (event_date IS NOT NULL)
    / CAST(count(DISTINCT asset_id) FILTER (event_date IS NOT NULL) AS DOUBLE) >= 3.0 AS is_panel
FROM (SELECT trim(asset_id) AS asset_id,
        CAST(try_strptime(lpad(raw_date, 8, '0'), '%m%d%Y') AS DATE) AS event_date FROM raw)""", "raw")


def value_range_gate(spark, sf_dir):
    """Raw units against the plausible ranges; the packed columns must be flagged."""
    out = quality.value_ranges(src.raw_panel(spark, sf_dir))
    return places(out, "outside_pct", "median")


def _range_sql():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high, "
        f"{number(c)} AS v FROM raw" for c, (lo, hi) in PLAUSIBLE_RANGES.items())
    return sql(f"""SELECT "column", low, high, count(v) AS n,
  round_even(count(*) FILTER (v NOT BETWEEN low AND high) * 100.0::DOUBLE / count(v), 6) AS outside_pct,
  count(*) FILTER (v NOT BETWEEN low AND high) * 100.0::DOUBLE / count(v) > 5 AS out_of_range,
  round_even(median(v), 6) AS median
FROM ({rows}) GROUP BY "column", low, high HAVING count(v) > 0""", "raw")


def decode_loss(spark, sf_dir):
    out = quality.decode_loss(src.raw_panel(spark, sf_dir))
    return out.withColumn("digits", F.col("digits").cast("bigint"))


def _loss_sql():
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", v, {sign}({degrees('abs(v)')}) AS d, {lo} AS low, {hi} AS high "
        f"FROM (SELECT {number(c)} AS v FROM raw)"
        for c, sign, lo, hi in (("latitude", "sign(v)*", 24, 38), ("longitude", "-", -108, -92)))
    return sql(f"""SELECT "column",
  CAST(CASE WHEN lost THEN length(CAST(CAST(trunc(abs(v)) AS BIGINT) AS VARCHAR)) ELSE 0 END AS BIGINT) AS digits,
  count(*) FILTER (lost) AS implausible, count(*) FILTER (v = 0) AS recorded_as_zero
FROM (SELECT *, d IS NOT NULL AND d NOT BETWEEN low AND high AS lost FROM ({rows})
      WHERE v IS NOT NULL) WHERE lost OR v = 0 GROUP BY ALL""", "raw")


def uniqueness_gate(spark, sf_dir):
    """Attribute rows per asset are not unique before they are reduced, and are after."""
    rows = src.extract_rows(spark, sf_dir)
    before = quality.duplicate_keys(rows, ["as_id"]).withColumn("source", F.lit("extract"))
    after = quality.duplicate_keys(static_rows(spark, sf_dir), ["asset_id"]).withColumn(
        "source", F.lit("static"))
    values = quality.duplicate_keys(src.attribute_values(spark, sf_dir), ["as_id", "fe_id"]).withColumn(
        "source", F.lit("values"))
    return before.unionByName(after).unionByName(values)


def _unique_sql():
    def one(name, keys, source):
        return f"""SELECT count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
  CAST(sum(n - 1) AS BIGINT) AS surplus_rows, '{name}' AS source
FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"""

    return sql(" UNION ALL ".join([one("extract", "asset_id", "extract_rows"),
                                   one("static", "asset_id", "static"),
                                   one("values", "as_id, fe_id", "attribute_values")]),
               "static", "eav")


PROFILED = ("asset_id", "raw_date", "deck", "culvert", "region", "adt", "latitude", "owner")


def column_profile(spark, sf_dir):
    return places(quality.column_profile(src.raw_panel(spark, sf_dir), PROFILED), "filled_pct")


PROFILE_SQL = sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count({c}) AS filled, "
    f"round_even(count({c}) * 100.0::DOUBLE / count(*), 6) AS filled_pct, "
    f"count(DISTINCT {c}) AS distinct_values FROM raw" for c in PROFILED), "raw")


def column_profile_approx(spark, sf_dir):
    return quality.column_profile(src.raw_panel(spark, sf_dir), PROFILED, exact=False)


def row_split_check(spark, sf_dir):
    """The row-wise split used where no asset id is available."""
    rows = split.with_split(panel(spark, sf_dir), CFG, method="random", row_key=("snapshot_no",))
    return rows.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


ROW_SPLIT_SQL = sql(f"""SELECT {share_bucket('CAST(snapshot_no AS VARCHAR)')} < 300 AS is_test, count(*) AS n
FROM panel GROUP BY 1""", "panel")

RANGE_SQL, LOSS_SQL = _range_sql(), _loss_sql()

QUERIES = {
    "clean_panel": (clean_panel, CLEAN_SQL),
    "decode_packed_coordinates": (decode_packed_coordinates, DECODE_SQL),
    "parse_mixed_dates": (parse_mixed_dates, DATES_SQL),
    "inspection_events": (inspection_events, _event_sql("events")),
    "latest_event": (latest_event, _event_sql("latest")),
    "system_classification": (system_classification, SYSTEM_SQL),
    "region_scope": (region_scope, SCOPE_SQL),
    "forward_pairs": (forward_pairs, sql(f"SELECT {PAIR_COLUMNS} FROM direct", "events", extra=DIRECT_PAIRS)),
    "pairs_capped": (pairs_capped, CAPPED_SQL),
    "attach_static": (attach_static, ATTACH_SQL),
    "static_match_rate": (static_match_rate, MATCH_SQL),
    "eav_pivot": (eav_pivot, _eav_sql()),
    "keyword_lookup": (keyword_lookup, KEYWORD_SQL),
    "feature_top": (feature_top, TOP_SQL),
    "qualified_history": (qualified_history, QUALIFIED_SQL),
    "id_list_semi_join": (id_list_semi_join, IDS_SQL),
    "age_features": (age_features, AGE_SQL),
    "future_projection": (future_projection, FUTURE_SQL),
    "aligned_features": (aligned_features, ALIGNED_SQL),
    "csv_roundtrip": (csv_roundtrip, ROUNDTRIP_SQL),
    "group_split_check": (group_split_check, SPLIT_SQL),
    "row_split_check": (row_split_check, ROW_SPLIT_SQL),
    "category_codes": (category_codes, CODES_SQL),
    "impute_medians": (impute_medians, IMPUTE_SQL),
    "region_summary": (region_summary, SUMMARY_SQL),
    "attribute_coverage": (attribute_coverage, COVERAGE_SQL),
    "region_coverage": (region_coverage, REGION_COVERAGE_SQL),
    "panel_shape_gate": (panel_shape_gate, SHAPE_SQL),
    "value_range_gate": (value_range_gate, RANGE_SQL),
    "decode_loss": (decode_loss, LOSS_SQL),
    "uniqueness_gate": (uniqueness_gate, _unique_sql()),
    "column_profile": (column_profile, PROFILE_SQL),
    "column_profile_approx": (column_profile_approx, None),
}
