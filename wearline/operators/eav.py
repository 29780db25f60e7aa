"""Attribute-value rows to the wide extract, and searches in the feature catalogue."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.config import EXTRACT_COLUMNS, EXTRACT_FEATURES, FEATURE_KEYWORDS, PanelConfig


def pivot_features(values: DataFrame, features: dict[str, int] | None = None) -> DataFrame:
    """(as_id, fe_id, cv_value) to one row per asset: one aggregation for all attributes.

    The id list is explicit, so no extra job looks for pivot values, and the filter on it
    reaches the scan. Text maxima are found by sorting, so the rows are first dealt by asset to
    tasks of an even size: more rows make more tasks. Rebalancing splits what a very large asset
    fills, and the last aggregation meets at most one row per asset and task.
    """
    features = features or EXTRACT_FEATURES
    ids = list(features.values())
    dealt = values.where(F.col("fe_id").isin(ids)).withColumn("_deal", F.xxhash64("as_id")).hint("rebalance", "_deal")
    wide = dealt.groupBy("as_id").pivot("fe_id", ids).agg(F.max("cv_value"))
    return wide.select("as_id", *[F.col(str(i)).alias(name) for name, i in features.items()])


def eligible_assets(assets: DataFrame, statuses: DataFrame) -> DataFrame:
    """Live, top-level, properly coded assets whose status exists."""
    code = F.col("as_code")
    kept = assets.where(
        (F.col("at_id") == 1) & F.left(code, F.lit(1)).isin("0", "1", "2") & (code != "0")
        & (F.col("as_root") == 0) & F.length(code).isin(14, 15) & (F.col("as_deleted") == 0)
        & ~code.like("%test%") & ~code.like("%##%") & F.col("asset_status_id").isin(0, 1, 2)
    )
    return kept.join(statuses.select("asset_status_id").distinct(), "asset_status_id", "left_semi")


def attribute_extract(assets: DataFrame, statuses: DataFrame, values: DataFrame,
                      cfg: PanelConfig) -> DataFrame:
    """The 41-column extract. Ratings follow the asset's status: none once it is retired, the
    legacy code as a stand-in while it is being migrated, the current code otherwise."""
    wide = eligible_assets(assets, statuses).join(pivot_features(values), "as_id", "left")
    status = F.col("asset_status_id")
    ratings = {
        c: F.when(status == 0, F.coalesce(c, f"{c}_legacy")).when(status != 2, F.col(c))
        for c in cfg.components
    }
    wide = wide.withColumns(ratings)
    return wide.select(*[
        F.col(c) if c in wide.columns else F.lit(None).cast("string").alias(c)
        for c in EXTRACT_COLUMNS])


def search_names(catalogue: DataFrame, words: Sequence[str] = FEATURE_KEYWORDS,
                 name: str = "fe_name") -> DataFrame:
    """Entries whose name contains any of the words, upper or lower case, ordered by name."""
    pattern = "|".join(re.escape(w.lower()).replace("\\ ", " ") for w in words)
    return catalogue.where(F.lower(name).rlike(pattern)).orderBy(name, "fe_id")


def lookup_features(rows: DataFrame, ids: Sequence[int], top: int | None = None,
                    order: Sequence[str] = ("fe_id",)) -> DataFrame:
    found = rows.where(F.col("fe_id").isin(list(ids))).orderBy(*order)
    return found if top is None else found.limit(top)
