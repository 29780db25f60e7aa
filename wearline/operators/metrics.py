"""Error measures over weighted outcomes, and the simple predictors they judge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.functions.numbers import clip


def error_measures(actual: Column, predicted: Column, weight: Column | None = None,
                   steps: Sequence[float] = (1.0,)) -> list[Column]:
    """Aggregates n, mae, rmse, r2 and within-k %, with predictions held within 0..9.

    Sums stay integer for integer ratings. R2 of a constant actual is 1 if every prediction hits
    and 0 otherwise; of a single row it is null.
    """
    w = F.lit(1) if weight is None else weight
    guess = clip(predicted, 0.0, 9.0)
    miss = F.abs(actual - guess)
    n = F.sum(w)
    squares = F.sum(w * miss * miss)
    spread = F.sum(w * actual * actual) - F.sum(w * actual) * F.sum(w * actual) / n
    flat = F.max(actual) == F.min(actual)
    r2 = (
        F.when(n < 2, None).when(flat & (squares == 0), 1.0).when(flat, 0.0)
        .otherwise(1 - squares / spread)
    )
    names = {k: "within_" + f"{k:g}".replace(".", "_") for k in steps}
    return [
        n.alias("n"), (F.sum(w * miss) / n).alias("mae"), F.sqrt(squares / n).alias("rmse"),
        r2.alias("r2"),
        *[(F.sum(w * F.when(miss <= k, 1).otherwise(0)) * F.lit(100.0) / n).alias(name)
          for k, name in names.items()],
    ]


def by_method(df: DataFrame, methods: Mapping[str, Column]) -> DataFrame:
    """One row per predictor: columns ``method`` and ``predicted``."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("method"), value.cast("double").alias("predicted"))
        for name, value in methods.items()])
    return df.select("*", F.explode(entries).alias("_m")).select(
        *df.columns, "_m.method", "_m.predicted")


def score(df: DataFrame, by: Sequence[str], actual: str = "r1", predicted: str = "predicted",
          weight: str | None = None, steps: Sequence[float] = (1.0,)) -> DataFrame:
    rows = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    measures = error_measures(F.col(actual), F.col(predicted),
                              None if weight is None else F.col(weight), steps)
    return rows.groupBy(*by).agg(*measures)


def group_mean(value: str, weight: str, used: Column, by: Sequence[str],
               wider: Sequence[str]) -> Column:
    """Weighted mean of the used rows of a group, or of the wider group where it has none.

    Meant for frames that are already aggregated to counts.
    """
    narrow, wide = Window.partitionBy(*by), Window.partitionBy(*wider)
    total = F.when(used, F.col(value) * F.col(weight))
    count = F.when(used, F.col(weight))
    return F.coalesce(F.sum(total).over(narrow) / F.sum(count).over(narrow),
                      F.sum(total).over(wide) / F.sum(count).over(wide))


def weighted_overall(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Error measures of uneven groups, averaged by their size."""
    def mean(name):
        return (F.sum(F.col(name) * F.col("n")) / F.sum("n")).alias(name)

    return table.groupBy(*by).agg(F.sum("n").alias("n"), mean("mae"), mean("within_1"))


def best_gain(table: DataFrame, better: str, base: str) -> DataFrame:
    """The largest error reduction against the base; zero or missing bases are skipped."""
    gain = 1 - F.col(better) / F.nullif(F.col(base), F.lit(0.0))
    return table.agg(F.max(gain).alias("best_gain"))


def grouped_summary(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame | None:
    """Mean, median and count of every value per group, over the grouping columns that exist."""
    from wearline.operators.medians import medians_by

    groups = [c for c in by if c in df.columns]
    if not groups:
        return None
    rows = df.dropna(subset=groups)
    plain = rows.groupBy(*groups).agg(*[
        f for v in values for f in (F.avg(v).alias(f"{v}_mean"), F.count(v).alias(f"{v}_count"))])
    middle = medians_by(rows, groups, values).withColumnsRenamed(
        {v: f"{v}_median" for v in values})
    ordered = [f"{v}_{s}" for v in values for s in ("mean", "median", "count")]
    return plain.join(middle, groups, "left").select(*groups, *ordered)


def guarded_corr(left: str, right: str) -> Column:
    """Pearson correlation over rows with both values; null where either has no spread."""
    both = F.col(left).isNotNull() & F.col(right).isNotNull()
    a, b = F.when(both, F.col(left)), F.when(both, F.col(right))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / F.when(spread > 0, spread))
