"""Sinks. Each takes an output root so a trial run only needs another root."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.functions.text import file_safe


def write_panel(df: DataFrame, root: str) -> str:
    path = f"{root}/panel"
    df.write.mode("overwrite").parquet(path)
    return path


def write_results(tables: Mapping[str, DataFrame | None], root: str) -> dict[str, str]:
    """Predictions, metrics, importances and the grouped summary, each if there is one."""
    written = {}
    for name, table in tables.items():
        if table is not None and table.columns:
            written[name] = f"{root}/{name}"
            table.write.mode("overwrite").parquet(written[name])
    return written


def write_watchlist(df: DataFrame, root: str) -> str:
    path = f"{root}/watchlist"
    spread = df.hint("rebalance", "component", "region")
    spread.write.mode("overwrite").partitionBy("component", "region").parquet(path)
    return path


def write_by_region(df: DataFrame, root: str, scope: str) -> str:
    """One folder per scope and region; a rerun replaces only the folders it writes.

    Rows are rebalanced by region: small regions become one file, a large one is split over
    several tasks and files.
    """
    path = f"{root}/regions"
    (
        df.withColumns({"scope": F.lit(scope), "region_folder": file_safe(F.col("region"))})
        .hint("rebalance", "region_folder")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("scope", "region_folder").parquet(path)
    )
    return path


def write_payload(df: DataFrame, root: str) -> str:
    """One JSON object per line."""
    path = f"{root}/payload"
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
    return path
