"""From a raw panel to typed, decoded, configured columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.config import COORDINATE_BOX, PanelConfig
from wearline.functions.numbers import decode_degrees, decode_hundredths, to_number, within
from wearline.functions.text import bare_code, clean_id

PACKED_FACTORS = ("inventory_load", "operating_load")


def rename_headers(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the headers that are present; the rest stay."""
    return df.withColumnsRenamed(dict(names))


def wanted_columns(cfg: PanelConfig) -> list[str]:
    names = [cfg.asset_id, cfg.tiebreak, cfg.on_system, cfg.raw_date, *cfg.components,
             *cfg.numeric, *cfg.categorical]
    return list(dict.fromkeys(names))


def missing_columns(df: DataFrame, cfg: PanelConfig) -> dict[str, list[str]]:
    """Configured columns the source lacks, by where they will come from instead."""
    absent = [c for c in wanted_columns(cfg) if c not in df.columns and c != cfg.tiebreak]
    supplied = set(cfg.static_numeric) | set(cfg.static_categorical)
    return {
        "from_extract": sorted(c for c in absent if c in supplied),
        "engineered": sorted(c for c in absent if c in cfg.engineered and c not in supplied),
        "absent": sorted(c for c in absent if c not in supplied and c not in cfg.engineered),
    }


def clean_panel(df: DataFrame, cfg: PanelConfig, keep_unrated: bool = False) -> DataFrame:
    """Project, coerce, drop rows without any rating, undo packed encodings: one narrow stage.

    Numbers are read once and decoded in a second projection, which keeps the expressions short.
    """
    keep = [c for c in wanted_columns(cfg) if c in df.columns]
    numeric = set(cfg.components) | set(cfg.numeric)
    readers = {cfg.asset_id: clean_id, cfg.region: bare_code, **dict.fromkeys(numeric, to_number)}
    typed = df.select(*[readers[c](F.col(c)).alias(c) if c in readers else F.col(c) for c in keep])
    ratings = [c for c in cfg.components if c in keep]
    if not keep_unrated:
        typed = typed.dropna(how="all", subset=ratings)
    packed = [c for c in COORDINATE_BOX if c in keep]
    degrees = typed.withColumns({
        c: decode_degrees(F.col(c), west=c == "longitude") for c in packed})
    return degrees.withColumns({
        **{c: within(F.col(c), *COORDINATE_BOX[c]) for c in packed},
        **{c: decode_hundredths(F.col(c)) for c in PACKED_FACTORS if c in keep}})
