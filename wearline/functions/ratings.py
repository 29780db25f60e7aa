"""Rating bands, horizon labels, interpolation between anchors and display flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearline.config import ANCHOR_HORIZONS, HorizonBands


def horizon_label(years: Column, bands: HorizonBands) -> Column:
    """Right-closed band label; null outside (first edge, last edge]."""
    label = F.when(years <= bands.edges[0], F.lit(None))
    for edge, name in zip(bands.edges[1:], bands.labels):
        label = label.when(years <= edge, F.lit(name))
    return label


def rating_band(rating: Column) -> Column:
    return (
        F.when(rating.isNull(), "not rated").when(rating >= 7, "good").when(rating >= 5, "fair")
        .otherwise("poor")
    )


def forecast_route(years: Column, hybrid_years: float,
                   anchors: Sequence[int] = ANCHOR_HORIZONS) -> Column:
    """How a number at this horizon comes about."""
    return (
        F.when(years == 0, "observed").when(years <= hybrid_years, "carry")
        .when(years.isin(*anchors), "model").otherwise("interpolated")
    )


def decline_flag(change: Column) -> Column:
    return F.when(change <= -1, "severe").when(change < -0.05, "mild").otherwise("none")


def risk_flag(risk: Column) -> Column:
    return F.when(risk >= 50, "high").when(risk >= 25, "raised").otherwise("none")


def at_horizon(values: Column, years: Column,
               anchors: Sequence[int] = ANCHOR_HORIZONS) -> Column:
    """Read a map anchor -> value at any horizon by a straight line between its neighbours.

    A missing neighbour yields the other one; an anchor's own value is never replaced. Beyond the
    grid the first and last anchors bracket.
    """
    exact = F.try_element_at(values, years.cast("int"))
    low, high = F.lit(anchors[0]), F.lit(anchors[-1])
    for left, right in zip(anchors, anchors[1:]):
        inside = (years > left) & (years < right)
        low = F.when(inside, left).otherwise(low)
        high = F.when(inside, right).otherwise(high)
    below, above = F.try_element_at(values, low), F.try_element_at(values, high)
    line = below + (above - below) * (years - low) / (high - low)
    return F.when(years.isin(*anchors), exact).otherwise(F.coalesce(line, below, above))


def quantile_of(probabilities: Column, q: float) -> Column:
    """Quantile of a 0..9 rating distribution given as an array of ten probabilities.

    The mass of rating k is spread evenly over (k - 0.5, k + 0.5], which keeps the result
    continuous; the result is held within 0..9. The small tolerance keeps a sum of rounded
    probabilities from falling just short of ``q``.
    """
    start = F.struct(F.lit(0.0).alias("below"), F.lit(None).cast("double").alias("at"),
                     F.lit(0).alias("k"))

    def step(state: Column, p: Column) -> Column:
        reached = state["at"].isNull() & (state["below"] + p >= F.lit(q - 1e-9)) & (p > 0)
        inside = state["k"] - F.lit(0.5) + (F.lit(q) - state["below"]) / p
        return F.struct(
            (state["below"] + p).alias("below"),
            F.when(reached, inside).otherwise(state["at"]).alias("at"),
            (state["k"] + 1).alias("k"),
        )

    return F.aggregate(
        probabilities, start, step,
        lambda state: F.greatest(F.lit(0.0), F.least(F.lit(9.0), F.coalesce(state["at"], F.lit(9.0)))),
    )


def mean_of(probabilities: Column) -> Column:
    return F.aggregate(
        F.transform(probabilities, lambda p, k: p * k), F.lit(0.0), lambda total, x: total + x)


def mass_at_or_below(probabilities: Column, threshold: float) -> Column:
    return F.aggregate(
        F.slice(probabilities, 1, int(threshold) + 1), F.lit(0.0), lambda total, x: total + x)
