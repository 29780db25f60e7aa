"""Exact medians that do not gather a group's values in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import settle

#: Slices are found in two steps, so a value is compared with about 2 * STEPS cuts.
STEPS = 32
SLICES = STEPS * STEPS
#: Distinct values of one group that a task may order.
BOUND = 100_000
#: Distinct values that a task of a round compares with the cuts.
VALUES_PER_TASK = 50_000
#: The cuts of one group take 8 KB; those of this many groups are sent to every task.
FEW_GROUPS = 500


def value_counts(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(group, name, value, n) over the present values of each column."""
    entries = F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value"))
                        for v in values])
    present = F.filter(entries, lambda e: e["value"].isNotNull() & ~F.isnan(e["value"]))
    long = df.select(*by, F.explode(present).alias("_v")).select(*by, "_v.name", "_v.value")
    return long.groupBy(*by, "name", "value").agg(F.count(F.lit(1)).alias("n"))


def subset_value_counts(df: DataFrame, subsets: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """(subset, name, value, n): the counts of every subset, which may share rows, from one pass."""
    marks = {name: f"_in{i}" for i, name in enumerate(subsets)}
    entries = F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value"))
                        for v in values])
    present = F.filter(entries, lambda e: e["value"].isNotNull() & ~F.isnan(e["value"]))
    rows = df.select(*[condition.alias(marks[name]) for name, condition in subsets.items()], present.alias("_present"))
    rows = rows.where(" OR ".join(marks.values()))
    long = rows.select(*marks.values(), F.explode("_present").alias("_v"))
    counts = long.groupBy("_v.name", "_v.value").agg(*[F.count_if(F.col(m)).alias(m) for m in marks.values()])
    per = F.array(*[F.struct(F.lit(name).alias("subset"), F.col(m).alias("n")) for name, m in marks.items()])
    return counts.select("name", "value", F.inline(per)).where("n > 0").select("subset", "name", "value", "n")


def _cut_to_slice(state: DataFrame, keys: Sequence[str], few: bool) -> DataFrame:
    """The slice of each group that holds its middle, with the number of rows below the slice.

    A quantile sketch of fixed size cuts the values that are left into 1,024 slices of about equally
    many distinct ones; running slice totals tell which holds the middle. If the middle falls
    between two slices, both and all between them stay. With few groups their cuts go to the values,
    which then stay where they are; else a group's values would meet in the task of its key.
    """
    def lookup(table):
        return F.broadcast(table) if few else table

    cuts = state.groupBy(*keys).agg(
        F.percentile_approx("value", [i / SLICES for i in range(1, SLICES)], 10 * SLICES).alias("_cuts"))
    cuts = cuts.withColumn("_steps", F.filter("_cuts", lambda c, i: i % STEPS == STEPS - 1))

    def below(cuts_column):
        return F.size(F.filter(cuts_column, lambda c: c < F.col("value")))

    first = F.col("_step") * STEPS
    sliced = (
        state.join(lookup(cuts), list(keys)).withColumn("_step", below("_steps"))
        .withColumn("_slice", first + below(F.slice("_cuts", first + 1, STEPS - 1)))
        .drop("_cuts", "_steps", "_step")
    )
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys).orderBy("_slice"))
    totals = sliced.groupBy(*keys, "_slice", "_low", "_high", "_before").agg(F.sum("n").alias("_n"))
    middle = (
        totals.withColumn("_upto", upto)
        .where((F.col("_upto") - F.col("_n") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
        .groupBy(*keys).agg(F.min("_slice").alias("_from"), F.max("_slice").alias("_to"),
                            F.min(F.col("_upto") - F.col("_n")).alias("_below"))
    )
    return (
        sliced.join(lookup(middle), list(keys)).where(F.col("_slice").between(F.col("_from"), F.col("_to")))
        .select(*keys, "value", "n", "_low", "_high", F.col("_below").alias("_before"))
    )


def medians_by(df: DataFrame, by: Sequence[str], values: Sequence[str],
               default: float | None = None, bound: int = BOUND) -> DataFrame:
    """The exact median of each value column, one row per group; ``default`` fills all-null ones.

    Values are reduced to counts, written once. While some group has more than ``bound`` distinct values
    left, every round keeps only the slice that holds the group's middle, about a thousandth; then a
    task orders at most ``bound`` values of a group. Small groups take no round at all. The counting
    and the rounds run when the query is built.
    """
    return _medians(value_counts(df, by, values), by, values, default, bound)


def subset_medians(df: DataFrame, subsets: Mapping[str, Column], values: Sequence[str],
                   default: float | None = None, bound: int = BOUND) -> DataFrame:
    """``medians_by`` over subsets that may share rows, one row per subset that has any value."""
    return _medians(subset_value_counts(df, subsets, values), ["subset"], values, default, bound)


def _medians(counts: DataFrame, by: Sequence[str], values: Sequence[str], default: float | None, bound: int) -> DataFrame:
    keys = [*by, "name"]
    total = F.sum("n").over(Window.partitionBy(*keys))
    state = settle(counts, "values")
    sizes = state.groupBy(*keys).agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_left"))
    found = sizes.agg(F.max("_left").alias("n"), F.sum("_left").alias("all"), F.count(F.lit(1)).alias("groups")).first()
    largest, few = found["n"] or 0, found["groups"] <= FEW_GROUPS
    if largest <= bound:
        ranked = state.withColumn("_total", total).withColumn("_before", F.lit(0).cast("long"))
    else:
        # Counts are small and lie in few files; comparing them with the cuts is what takes time.
        spread = state.repartition(-(-found["all"] // VALUES_PER_TASK))
        totals = sizes.drop("_left")
        ranked = spread.join(F.broadcast(totals) if few else totals, keys).withColumn("_before", F.lit(0).cast("long"))
    ranked = ranked.withColumns({"_low": F.floor((F.col("_total") + 1) / 2), "_high": F.floor(F.col("_total") / 2) + 1}).drop("_total")
    while largest > bound:
        ranked = settle(_cut_to_slice(ranked, keys, few), "middle")
        left = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left")).agg(F.max("_left").alias("n")).first()["n"]
        if left >= largest:
            raise ValueError("values that cannot be cut any further")
        largest = left
    reached = F.col("_before") + F.sum("n").over(Window.partitionBy(*keys).orderBy("value"))
    found = (
        ranked.withColumn("_reached", reached).groupBy(*keys).agg(
            ((F.min(F.when(F.col("_reached") >= F.col("_low"), F.col("value")))
              + F.min(F.when(F.col("_reached") >= F.col("_high"), F.col("value")))) / 2).alias("median"))
    )
    wide = [F.max(F.when(F.col("name") == v, F.col("median"))) for v in values]
    if default is not None:
        wide = [F.coalesce(c, F.lit(default)) for c in wide]
    return found.groupBy(*by).agg(*[c.alias(v) for c, v in zip(wide, values)])
