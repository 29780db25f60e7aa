"""Inspections stored by asset, and the source gates taken while they are written.

The store is bucketed by asset, so whatever works per asset later (latest row, previous rating, running
counts, pair joins) reads it without moving rows again. Writing it needs one shuffle by asset after the
inspections are reduced to one per day, which bounds what any asset contributes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wearline.config import COORDINATE_BOX, PLAUSIBLE_RANGES, PanelConfig
from wearline.functions.dates import inspection_date
from wearline.functions.numbers import decode_degrees, to_number
from wearline.operators.clean import clean_panel
from wearline.operators.enrich import attach_static
from wearline.operators.events import first_row
from wearline.operators.quality import MAX_OUTSIDE_PCT, MIN_INSPECTIONS
from wearline.session import observed, work_path

#: A number of degrees is written with this many digits at most; a bigint has no more.
WIDTHS = range(1, 20)


def write_by_asset(events: DataFrame, cfg: PanelConfig, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Events as a table in buckets of whole assets, each sorted by asset and date.

    The number of buckets is that of the shuffle unless given; rows that come from a shuffle by asset
    then make one file per bucket.
    """
    spark = events.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"events_{uuid.uuid4().hex}"
    (events.write.format("parquet").option("path", path or work_path(spark, "events"))
     .bucketBy(buckets, cfg.asset_id).sortBy(cfg.asset_id, cfg.event_date).saveAsTable(table))
    return spark.table(table)


@dataclass(frozen=True)
class Gates:
    """What the four source gates and the match rate found, as tables of the same columns."""

    shape: DataFrame
    ranges: DataFrame
    decode_loss: DataFrame
    match_rate: DataFrame


def _value(name: str) -> str:
    return f"_{name}__value"


def _width(name: str) -> str:
    return f"_{name}__width"


def _with_source_values(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    """raw with what its gates count: numbers and dates read once, digits of coordinates that are lost.

    A metric is evaluated by itself, so one that reads its number from text would read it once more.
    A coordinate is lost if it decodes to an impossible place.
    """
    numbers = raw.withColumns({
        "_source_date": inspection_date(F.col(cfg.raw_date)),
        **{_value(c): to_number(F.col(c)) for c in dict.fromkeys([*PLAUSIBLE_RANGES, *COORDINATE_BOX]) if c in raw.columns}})
    places = [c for c in COORDINATE_BOX if c in raw.columns]
    degrees = numbers.withColumns({f"_{c}__degrees": decode_degrees(F.col(_value(c)), west=c == "longitude") for c in places})
    return degrees.withColumns({
        _width(c): F.when(~F.col(f"_{c}__degrees").between(*COORDINATE_BOX[c]),
                          F.length(F.abs(F.col(_value(c))).cast("bigint").cast("string"))) for c in places})


def _source_names(raw: DataFrame) -> list[str]:
    ranged = [f"{c}__{kind}" for c in PLAUSIBLE_RANGES if c in raw.columns for kind in ("n", "out")]
    places = [f"{c}__{kind}" for c in COORDINATE_BOX if c in raw.columns for kind in ("zero", *[f"lost_{w}" for w in WIDTHS])]
    return ["rows", "parsed_rows", "first_date", "last_date", *ranged, *places]


def _source_metrics(raw: DataFrame) -> list[Column]:
    """Metrics of the rows that ``_with_source_values`` gives."""
    date = F.col("_source_date")
    metrics = [F.count(F.lit(1)).alias("rows"), F.count(date).alias("parsed_rows"),
               F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    for c, (low, high) in PLAUSIBLE_RANGES.items():
        if c in raw.columns:
            value = F.col(_value(c))
            metrics += [F.count(value).alias(f"{c}__n"), F.count_if(~value.between(low, high)).alias(f"{c}__out")]
    for c in COORDINATE_BOX:
        if c in raw.columns:
            metrics.append(F.count_if(F.col(_value(c)) == 0).alias(f"{c}__zero"))
            metrics += [F.count_if(F.col(_width(c)) == w).alias(f"{c}__lost_{w}") for w in WIDTHS]
    return metrics


def write_with_gates(raw: DataFrame, static: DataFrame | None, cfg: PanelConfig, path: str | None = None,
                     buckets: int | None = None) -> tuple[DataFrame, Gates]:
    """Clean, reduce, enrich and store the inspections of a raw panel, measuring the gates meanwhile.

    One job reads the source once. The rows of the source, the assets with their dated inspections
    and the rows joined to attributes are each observed on their way to the store. Of rows with the
    same asset and date a rated one stays, the smallest tiebreak first; assets and dates without any
    rating count for the shape and are not stored. Ranges and losses are those of the numbers as
    written, before decoding.
    """
    source, assets, joined = Observation(), Observation(), Observation()
    seen = _with_source_values(raw, cfg).observe(source, *_source_metrics(raw))
    ratings = [c for c in cfg.components if c in raw.columns]
    rows = clean_panel(seen, cfg, keep_unrated=True).withColumns({
        cfg.event_date: inspection_date(F.col(cfg.raw_date)),
        "_rated": F.coalesce(*[F.col(c) for c in ratings]).isNotNull()})
    rows = rows.where(F.col(cfg.asset_id).isNotNull())
    one = first_row(rows, [cfg.asset_id, cfg.event_date], [F.col("_rated").desc(), F.col(cfg.tiebreak).asc()])
    place = F.row_number().over(Window.partitionBy(cfg.asset_id).orderBy(F.col(cfg.event_date).asc_nulls_last()))
    first, dated = F.col("_place") == 1, F.col(cfg.event_date).isNotNull()
    counted = one.withColumn("_place", place).observe(
        assets, F.count_if(first).alias("assets"), F.count_if(first & dated).alias("dated_assets"),
        F.count_if(dated).alias("dated_inspections"))
    events = counted.where(dated & F.col("_rated")).drop("_place", "_rated", cfg.raw_date)
    with_static = attach_static(events, static, cfg)
    added = [c for c in with_static.columns if c not in events.columns]
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias("matched") for c in added[:1]]]
    stored = write_by_asset(with_static.observe(joined, *metrics), cfg, path, buckets)
    found = [{name: value or 0 for name, value in observed(o, names).items()} for o, names in (
        (source, _source_names(raw)), (assets, ["assets", "dated_assets", "dated_inspections"]), (joined, ["rows", "matched"]))]
    return stored, _gates(raw.sparkSession, raw, *found)


def _gates(spark: SparkSession, raw: DataFrame, source: dict, assets: dict, joined: dict) -> Gates:
    per = assets["dated_inspections"] / assets["dated_assets"] if assets["dated_assets"] else 0.0
    shape = spark.createDataFrame(
        [(source["rows"], assets["assets"], source["parsed_rows"], source["first_date"] or None, source["last_date"] or None,
          assets["dated_inspections"], per, per >= MIN_INSPECTIONS)],
        "rows long, assets long, parsed_rows long, first_date date, last_date date, dated_inspections long, "
        "inspections_per_asset double, is_panel boolean")
    ranges = []
    for c, (low, high) in PLAUSIBLE_RANGES.items():
        n = source.get(f"{c}__n", 0)
        if n:
            share = source[f"{c}__out"] * 100.0 / n
            ranges.append((c, float(low), float(high), n, share, share > MAX_OUTSIDE_PCT))
    losses = []
    for c in COORDINATE_BOX:
        if c in raw.columns:
            if source[f"{c}__zero"]:
                losses.append((c, 0, 0, source[f"{c}__zero"]))
            losses += [(c, w, source[f"{c}__lost_{w}"], 0) for w in WIDTHS if source[f"{c}__lost_{w}"]]
    matched = joined.get("matched", 0)
    rate = spark.createDataFrame([(joined["rows"], matched, matched * 100.0 / joined["rows"] if joined["rows"] else None)],
                                 "rows long, matched long, match_pct double")
    return Gates(shape, spark.createDataFrame(ranges, "column string, low double, high double, n long, outside_pct double, out_of_range boolean"),
                 spark.createDataFrame(losses, "column string, digits int, implausible long, recorded_as_zero long"), rate)
