"""Transition tables between consecutive inspections, and their powers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import PanelConfig
from wearline.operators.events import previous_ratings
from wearline.operators.pairs import RATINGS


def transition_counts(events: DataFrame, cfg: PanelConfig, by: Sequence[str]) -> DataFrame:
    """(by, from_rating, to_rating, n) over consecutive inspections."""
    steps = previous_ratings(events, cfg).dropna(subset=list(by))
    return steps.groupBy(
        *by, F.col("previous_rating").cast("int").alias("from_rating"),
        F.col("rating").cast("int").alias("to_rating"),
    ).agg(F.count(F.lit(1)).alias("n"))


def pool_unseen(counts: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds, for every group without a transition, the transitions of its whole component.

    ``groups`` holds the distinct groups to cover. Both sides are as small as the code lists that
    the groups come from.
    """
    pooled = counts.groupBy("component", "from_rating", "to_rating").agg(F.sum("n").alias("n"))
    unseen = groups.select(*by).join(counts.select(*by).distinct(), list(by), "left_anti")
    return counts.unionByName(unseen.join(pooled, "component").select(*counts.columns))


def transition_table(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row-normalised probabilities ``p``."""
    out_of = Window.partitionBy(*by, "from_rating")
    return counts.withColumn("p", F.col("n") / F.sum("n").over(out_of))


def matrix_powers(table: DataFrame, by: Sequence[str], steps: Sequence[int]) -> DataFrame:
    """``steps``-fold transition rows for each wanted number of steps.

    A group's table is at most 10 x 10, so a group becomes one row holding its matrix and the
    powers are array arithmetic within that row: no joins, and no lineage that grows with the
    steps. A rating never left in the data keeps its whole mass.
    """
    cells = table.groupBy(*by).agg(*[
        F.expr(f"coalesce(sum(CASE WHEN from_rating = {i} AND to_rating = {j} THEN p END), 0D) "
               f"AS _p{i}_{j}") for i in RATINGS for j in RATINGS])

    def row(i):
        seen = " + ".join(f"_p{i}_{j}" for j in RATINGS) + " > 0"
        stay = ", ".join(f"{float(i == j)}D" for j in RATINGS)
        return f"if({seen}, array({', '.join(f'_p{i}_{j}' for j in RATINGS)}), array({stay}))"

    base = cells.selectExpr(*by, f"array({', '.join(row(i) for i in RATINGS)}) AS _m")

    def times(state, matrix):
        # One distribution moved one step: weighted sum of the matrix rows.
        zero = F.array(*[F.lit(0.0) for _ in RATINGS])
        weighted = F.zip_with(state, matrix, lambda w, line: F.transform(line, lambda x: x * w))
        return F.aggregate(weighted, zero,
                           lambda total, line: F.zip_with(total, line, lambda x, y: x + y))

    powers = base.select(*by, "_m", F.explode(F.array(*[F.lit(int(k)) for k in steps])).alias("k"))
    raised = powers.withColumn("_power", F.aggregate(
        F.sequence(F.lit(2), F.greatest(F.col("k"), F.lit(2))), F.col("_m"),
        lambda state, step: F.when(
            step <= F.col("k"), F.transform(state, lambda line: times(line, F.col("_m")))
        ).otherwise(state)))
    return raised.select(*by, "k", F.posexplode("_power").alias("from_rating", "p"))
