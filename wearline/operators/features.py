"""Derived features, model column choice and alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.config import PanelConfig
from wearline.functions.dates import believable_built_year, inspection_date
from wearline.functions.numbers import clip, ratio
from wearline.session import small_side
from wearline.operators.medians import medians_by, subset_medians


def engineer(df: DataFrame, cfg: PanelConfig, reference_year: int | None = None) -> DataFrame:
    """Age, years since reconstruction, deck area and traffic density, where inputs exist.

    Ages refer to the inspection year; without a date column ``reference_year`` stands in.
    """
    have = set(df.columns)
    if cfg.event_date in have:
        year = F.year(cfg.event_date)
    elif cfg.raw_date in have:
        year = F.year(inspection_date(F.col(cfg.raw_date)))
    elif reference_year is not None:
        year = F.lit(reference_year)
    else:
        raise ValueError("without an inspection date a reference year is needed")
    out = df
    if cfg.year_built in have:
        built = believable_built_year(F.col(cfg.year_built).cast("double"), year)
        out = out.withColumn(cfg.year_built, built)
        out = out.withColumn("asset_age", clip(year - F.col(cfg.year_built), 0.0, 130.0))
        if "year_reconstructed" in have:
            since = clip(year - F.col("year_reconstructed").cast("double"), 0.0, 130.0)
            out = out.withColumn("years_since_reconstruction", F.when(
                F.col("year_reconstructed") > 0, since).otherwise(F.col("asset_age")))
    if "deck_area" not in have and {"structure_length", "deck_width"} <= have:
        out = out.withColumn("deck_area", F.col("structure_length") * F.col("deck_width"))
    if "adt" in have and "deck_area" in out.columns:
        out = out.withColumn("traffic_density", ratio(F.col("adt").cast("double"), F.col("deck_area")))
    return out


def project_to_year(df: DataFrame, target_year: Column | int, cfg: PanelConfig) -> DataFrame:
    """Ages as they will be in ``target_year``; rows without a built year are not projectable."""
    year = F.lit(target_year) if isinstance(target_year, int) else target_year
    built = F.col(cfg.year_built)
    age = clip(year - built.cast("double"), 0.0, 130.0)
    out = df.withColumn("projectable", built.isNotNull())
    if "years_since_reconstruction" in df.columns:
        rebuilt = F.col("year_reconstructed").cast("double")
        since = F.when(rebuilt > 0, clip(year - rebuilt, 0.0, 130.0)).otherwise(age)
        out = out.withColumn("years_since_reconstruction", F.when(
            F.col("projectable"), since).otherwise(F.col("years_since_reconstruction")))
    now = F.col("asset_age") if "asset_age" in df.columns else F.lit(None).cast("double")
    return out.withColumn("asset_age", F.when(F.col("projectable"), age).otherwise(now))


def model_columns(df: DataFrame, cfg: PanelConfig) -> list[str]:
    """Numeric columns other than ratings, groupings, the id and the dates."""
    reserved = {*cfg.components, cfg.region, "climate_zone", cfg.asset_id, cfg.raw_date,
                cfg.event_date, cfg.tiebreak}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in reserved]


def trajectory_columns(columns: Sequence[str], cfg: PanelConfig) -> tuple[list[str], list[str]]:
    """Numeric and categorical inputs of the trajectory models that a frame has.

    Panel inputs come first; an attribute also listed as a panel input is not taken twice.
    """
    panel_numeric = [c for c in cfg.trajectory_numeric if c in columns]
    panel_text = [c for c in cfg.trajectory_categorical if c in columns]
    taken = {*panel_numeric, *panel_text}
    static_numeric = [c for c in cfg.static_numeric if c in columns and c not in taken]
    static_text = [c for c in cfg.static_categorical if c in columns and c not in taken]
    return ([*panel_numeric, *static_numeric, "r0", "horizon", "age_t0"],
            [*panel_text, *static_text])


def align(df: DataFrame, numeric: Sequence[str], text: Sequence[str] = (),
          keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's columns: absent ones all null, numbers as double."""
    def take(name, kind):
        column = F.col(name) if name in df.columns else F.lit(None)
        return column.cast(kind).alias(name)

    return df.select(*keep, *[take(c, "double") for c in numeric], *[take(c, "string") for c in text])


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Code table (column, category, code): categories numbered alphabetically from 0."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
                        for c in columns])
    found = df.select(F.explode(F.filter(entries, lambda e: e["category"].isNotNull())).alias("_e"))
    distinct = found.select("_e.column", "_e.category").distinct()
    order = Window.partitionBy("column").orderBy("category")
    return distinct.withColumn("code", F.row_number().over(order) - 1)


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_idx``; unseen and missing categories have no code."""
    out, codes = df, small_side(codes)
    for c in columns:
        table = codes.where(F.col("column") == c).select(
            F.col("category").alias(c), F.col("code").cast("double").alias(f"{c}_idx"))
        out = out.join(table, c, "left")
    return out


def impute_values(train: DataFrame, columns: Sequence[str], subsets: Mapping[str, Column] | None = None) -> DataFrame:
    """Per-column medians of the training rows, 0 for a column without any value.

    With ``subsets`` there is one row for each of these that has any value: the training rows of several
    models, which share most rows, are then counted in one pass.
    """
    if subsets is not None:
        return subset_medians(train, subsets, columns, default=0.0)
    return medians_by(train, [], columns, default=0.0)
