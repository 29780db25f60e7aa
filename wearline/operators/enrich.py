"""Static attributes: one row per asset, attached to a panel, and how complete they are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.config import UNKNOWN, PanelConfig
from wearline.functions.numbers import to_number
from wearline.functions.text import clean_id
from wearline.operators.events import first_row
from wearline.session import small_side


def static_attributes(extract: DataFrame, cfg: PanelConfig, id_column: str,
                      order: Sequence[str]) -> DataFrame:
    """The configured attributes, typed, the first extract row per asset under ``order``."""
    numeric = [c for c in cfg.static_numeric if c in extract.columns]
    categorical = [c for c in cfg.static_categorical if c in extract.columns]
    rows = extract.withColumn(cfg.asset_id, clean_id(F.col(id_column))).where(
        F.col(cfg.asset_id).isNotNull())
    first = first_row(rows, [cfg.asset_id], [F.col(c).asc() for c in order])
    return first.select(cfg.asset_id, *[to_number(F.col(c)).alias(c) for c in numeric],
                        *[F.col(c).cast("string").alias(c) for c in categorical])


def attach_static(df: DataFrame, static: DataFrame | None, cfg: PanelConfig) -> DataFrame:
    """Left join on the asset; columns the frame already has win over the attribute's.

    The attribute table grows with the assets, so no broadcast is forced: the optimizer picks one
    only below its size threshold.
    """
    if static is None:
        return df
    fresh = [c for c in static.columns if c not in df.columns]
    if not fresh:
        return df
    return df.join(static.select(cfg.asset_id, *fresh), cfg.asset_id, "left")


def match_rate(df: DataFrame, column: str) -> DataFrame:
    """Share of rows that found their attribute row, judged by one attached column."""
    found = F.col(column).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(found).alias("matched"),
                  (F.count_if(found) * F.lit(100.0) / F.count(F.lit(1))).alias("match_pct"))


def present_count(columns: Sequence[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def missing_positions(columns: Sequence[str], limit: int = 6) -> Column:
    """Positions of the first missing attributes, in column order."""
    marks = F.array(*[F.when(F.col(c).isNull(), F.lit(i)) for i, c in enumerate(columns)])
    return F.slice(F.filter(marks, lambda m: m.isNotNull()), 1, limit)


def with_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds how many attributes a row has, of how many, and which are missing first.

    An attribute the frame lacks altogether counts as missing on every row.
    """
    padded = df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})
    return padded.withColumns({
        "feat_total": F.lit(len(columns)),
        "feat_present": present_count(columns),
        "feat_missing": missing_positions(columns),
    }).select(*df.columns, "feat_total", "feat_present", "feat_missing")


def coverage_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    share = F.col("feat_present") / F.col("feat_total")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("assets"),
                               (F.avg(share) * 100).alias("coverage_pct"))


def repeating_groups(rows: DataFrame, key: str, instance: str, latest: Mapping[str, str],
                     later: Mapping[str, str]) -> DataFrame:
    """One row per asset out of the instances of repeating attribute groups.

    ``latest`` names the greatest value over all instances (the last year of work), ``later`` the sum
    over all but the first instance (approach spans); an asset with one instance has none, that is 0.
    Values without a number are left out. Partial sums leave one row per asset and map task.
    """
    numbered = F.col(instance).cast("int")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(numbered).alias("instances"),
        *[F.max(to_number(F.col(c))).alias(name) for name, c in latest.items()],
        *[F.coalesce(F.sum(F.when(numbered >= 2, to_number(F.col(c)))), F.lit(0.0)).alias(name)
          for name, c in later.items()])


def zone_codes(ranges: DataFrame, low: str = "low", high: str = "high", zone: str = "zone",
               limit: int = 50_000) -> DataFrame:
    """(code, zone) of a table of closed code ranges; ranges that share a code are an error.

    The ranges are a lookup table: they may span ``limit`` codes in all.
    """
    spans = ranges.where(F.col(low) <= F.col(high))
    size = spans.agg(F.sum(F.col(high).cast("long") - F.col(low) + 1)).first()[0] or 0
    if size > limit:
        raise ValueError(f"the ranges span {size} codes, more than {limit}")
    codes = spans.select(F.explode(F.sequence(F.col(low).cast("int"), F.col(high).cast("int"))).alias("_code"), F.col(zone).alias(zone))
    shared = codes.groupBy("_code").count().where("count > 1").orderBy("_code").limit(5).collect()
    if shared:
        raise ValueError(f"ranges overlap at code {', '.join(str(r['_code']) for r in shared)}")
    return codes


def attach_zone(df: DataFrame, code: str, ranges: DataFrame, name: str = "climate_zone", **columns) -> DataFrame:
    """df with the zone of its code as a further grouping key; codes outside all ranges are unknown."""
    zone = columns.get("zone", "zone")
    codes = small_side(zone_codes(ranges, **columns).withColumnRenamed(zone, name))
    number = to_number(F.col(code)).cast("int")
    return df.join(codes, number == F.col("_code"), "left").drop("_code").withColumn(name, F.coalesce(name, F.lit(UNKNOWN)))
