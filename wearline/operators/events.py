"""Real inspections out of annual snapshots, and what is latest or previous among them.

Skew: an asset may own any share of the raw rows. Every reduction here is keyed so that each
map task keeps at most one row per key before the shuffle (``row_number() = 1`` is planned with a
partial group limit, aggregates with a partial aggregate). After ``inspection_events`` an asset
holds at most one row per calendar day, which bounds every later per-asset window and join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import PanelConfig
from wearline.functions.dates import inspection_date
from wearline.functions.text import clean_id, is_on_system


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key under a total order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def dated_rows(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Rows with a usable identifier and a readable date, as ``event_date``."""
    return (
        panel.withColumns({
            cfg.asset_id: clean_id(F.col(cfg.asset_id)),
            cfg.event_date: inspection_date(F.col(cfg.raw_date)),
        })
        .dropna(subset=[cfg.asset_id, cfg.event_date])
        .drop(cfg.raw_date)
    )


def inspection_events(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row per asset and inspection date; among copies the smallest tiebreak stays."""
    return first_row(dated_rows(panel, cfg), [cfg.asset_id, cfg.event_date],
                     [F.col(cfg.tiebreak).asc()])


def latest_event(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The last inspection of every asset.

    Works on dated rows as well as on events: the last date's smallest tiebreak is the same row,
    so the whole panel needs one reduction and not two.
    """
    rows = panel if cfg.event_date in panel.columns else dated_rows(panel, cfg)
    return first_row(rows, [cfg.asset_id],
                     [F.col(cfg.event_date).desc(), F.col(cfg.tiebreak).asc()])


def by_component(df: DataFrame, cfg: PanelConfig, value: str = "rating") -> DataFrame:
    """Wide ratings to one row per component that exists on the asset.

    ``inline`` of an array keeps the input partitioning, so the long form needs no new shuffle.
    """
    present = [c for c in cfg.components if c in df.columns]
    entries = ", ".join(f"struct('{c}' AS component, `{c}` AS {value})" for c in present)
    rest = [c for c in df.columns if c not in present]
    return df.selectExpr(*[f"`{c}`" for c in rest], f"inline(array({entries}))").where(
        F.col(value).isNotNull())


def previous_ratings(events: DataFrame, cfg: PanelConfig, stored_by_asset: bool = False) -> DataFrame:
    """Each rating with the same component's previous one; first inspections are left out.

    Events that are stored by asset are not moved."""
    order = Window.partitionBy(cfg.asset_id, "component").orderBy(cfg.event_date)
    long = by_component(events if stored_by_asset else events.repartition(cfg.asset_id), cfg)
    return (
        long.withColumn("previous_rating", F.lag("rating").over(order))
        .where(F.col("previous_rating").isNotNull())
    )


def system_of_asset(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One system class per asset from its last dated record that carries a flag."""
    flag = F.upper(F.trim(F.col(cfg.on_system)))
    on = is_on_system(F.col(cfg.on_system))
    rows = dated_rows(panel, cfg).where(F.col(cfg.on_system).isNotNull())
    return rows.groupBy(cfg.asset_id).agg(
        F.max_by(flag, F.struct(cfg.event_date, cfg.tiebreak)).alias("last_flag"),
        F.bool_or(on).alias("ever_on"),
        F.bool_or(~on).alias("ever_off"),
    )


def system_counts(panel: DataFrame, cfg: PanelConfig) -> DataFrame:
    """On, off and reclassified assets, each asset counted once by its last flag."""
    on = F.col("last_flag") == "ON"
    return system_of_asset(panel, cfg).agg(
        F.count_if(on).alias("on_assets"),
        F.count_if(~on).alias("off_assets"),
        F.count_if(F.col("ever_on") & F.col("ever_off")).alias("reclassified_assets"),
        F.count(F.lit(1)).alias("assets"),
    )


def in_region(df: DataFrame, cfg: PanelConfig, region: str) -> DataFrame:
    return df.where(F.trim(F.col(cfg.region)) == F.lit(str(region).strip()))


def on_system_rows(df: DataFrame, cfg: PanelConfig, prefix: bool = False) -> DataFrame:
    return df.where(is_on_system(F.col(cfg.on_system), prefix))


def in_id_set(df: DataFrame, ids: DataFrame, key: str, id_key: str) -> DataFrame:
    """Keep rows whose trimmed key occurs in ``ids``; the row count never grows."""
    wanted = ids.select(F.trim(F.col(id_key)).alias("_id")).distinct()
    return df.join(wanted, F.trim(F.col(key)) == F.col("_id"), "left_semi")


def qualified_history(history: DataFrame, core: DataFrame, qualifier: DataFrame, *,
                      key: str, core_key: str, link: str) -> DataFrame:
    """History rows whose id belongs to a core record with at least one qualifying row.

    The qualifier is reduced to distinct links first: a link with very many rows shuffles as one
    row per map task.
    """
    linked = core.join(qualifier.select(link).distinct(), link, "left_semi")
    return in_id_set(history, linked, key, core_key)
