"""How well do simple rules forecast later inspections, per component and horizon band?

All measures come from one table of weighted outcomes whose size depends on the rating scale,
the bands and the grouping, and not on the number of inspections.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.config import HorizonBands, PanelConfig
from wearline.functions.dates import age_on
from wearline.functions.numbers import clip, half_even, lesser
from wearline.functions.ratings import mass_at_or_below, mean_of, quantile_of
from wearline.operators.events import by_component
from wearline.operators.markov import (
    matrix_powers, pool_unseen, transition_counts, transition_table,
)
from wearline.operators.metrics import by_method, group_mean, score
from wearline.operators.pairs import RATINGS, outcome_counts
from wearline.operators.split import is_test_asset, temporal_events


def outcome_table(events: DataFrame, cfg: PanelConfig, bands: HorizonBands,
                  by: Sequence[str] = (), ages: bool = False,
                  ratings: Sequence[float] = RATINGS) -> DataFrame:
    """(component, band, r0, r1, by, n), with ``is_test`` and, if asked, the age bin at t1.

    A band is cut at every half year for the age bin: all horizons of such a span round to the
    same number of years.
    """
    starts = events.withColumn("is_test", is_test_asset(cfg))
    if not ages:
        counts = outcome_counts(starts, cfg, bands, by=[*by, "is_test"], ratings=ratings)
        return counts.drop("span")
    starts = starts.withColumn("_age", age_on(F.col(cfg.event_date), F.col(cfg.year_built)))
    cuts = [y + 0.5 for y in range(int(bands.max_years) + 1)]
    counts = outcome_counts(starts, cfg, bands, by=[*by, "is_test", "_age"], extra_edges=cuts,
                            ratings=ratings)
    later = F.ceil(F.col("span") - 0.5)
    keys = ["component", "band", "r0", "r1", *by, "is_test", "age_bin"]
    return counts.withColumn("age_bin", half_even(F.col("_age") + later).cast("int")).groupBy(
        *keys).agg(F.sum("n").alias("n"))


def age_curve(value: str = "r1", weight: str = "n") -> Column:
    """Mean rating of the training rows in the age bin, or of all of them where the bin is new."""
    return F.when(
        F.col("age_bin").isNotNull(),
        group_mean(value, weight, ~F.col("is_test"), ["component", "age_bin"], ["component"]),
    ).otherwise(group_mean(value, weight, ~F.col("is_test"), ["component"], ["component"]))


def baselines_by_band(events: DataFrame, cfg: PanelConfig, bands: HorizonBands,
                      ratings: Sequence[float] = RATINGS) -> DataFrame:
    """Carry-forward and age curve on held-out assets: error measures by component and band."""
    table = outcome_table(events, cfg, bands, ages=True, ratings=ratings).withColumn("_age", age_curve())
    held_out = table.where("is_test")
    scored = by_method(held_out, {"carry_forward": F.col("r0"), "age_curve": F.col("_age")})
    return score(scored, ["component", "band", "method"], weight="n")


def baselines_by_split(events: DataFrame, cfg: PanelConfig, bands: HorizonBands, cutoff) -> DataFrame:
    """The same measures under the split by asset and under that by asset and time, side by side."""
    by_asset = baselines_by_band(events, cfg, bands).withColumn("split", F.lit("asset"))
    by_time = baselines_by_band(temporal_events(events, cfg, cutoff), cfg, bands)
    return by_asset.unionByName(by_time.withColumn("split", F.lit("time")))


def carry_forward_by_band(events: DataFrame, cfg: PanelConfig, bands: HorizonBands) -> DataFrame:
    """The error of assuming no change, over all assets."""
    counts = outcome_counts(events, cfg, bands)
    return score(counts, ["component", "band"], predicted="r0", weight="n")


def stratified_transitions(events: DataFrame, cfg: PanelConfig, by: Sequence[str],
                           train_only: bool = True, learn: Column | None = None) -> DataFrame:
    """Transition table by component and stratum. A stratum of the events that training never saw
    takes the transitions of its whole component. ``learn`` picks other training rows."""
    keys = ["component", *by]
    source = events.where(~is_test_asset(cfg) if learn is None else learn) if train_only else events
    counts = transition_counts(source, cfg, keys)
    strata = by_component(events, cfg).dropna(subset=list(by)).select(*keys).distinct()
    return transition_table(pool_unseen(counts, strata, keys), keys)


def markov_outlook(events: DataFrame, cfg: PanelConfig, by: Sequence[str],
                   steps: Mapping[str, int], train_only: bool = True, learn: Column | None = None) -> DataFrame:
    """(component, by, band, r0) -> distribution, mean, conservative quantile and risk.

    Transitions are stratified by ``by``; ``steps`` says how many inspection steps a band spans.
    """
    keys = ["component", *by]
    table = stratified_transitions(events, cfg, by, train_only, learn)
    powers = matrix_powers(table, keys, sorted(set(steps.values())))
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(int(k)).alias("k"))
                      for b, k in steps.items()])
    wanted = F.filter(bands, lambda e: e["k"] == F.col("k"))
    spread = powers.select(*keys, F.col("from_rating").alias("r0"), "p",
                           F.explode(wanted).alias("_b"))
    # Nine places drop the noise of summing probabilities, so that comparisons at whole ratings
    # do not depend on the order of summation.
    likely = half_even(clip(mean_of(F.col("p")), 0.0, 9.0), 9)
    valued = spread.select(
        *keys, "_b.band", "r0", "p", likely.alias("likely"),
        half_even(mass_at_or_below(F.col("p"), cfg.risk_threshold) * 100, 9).alias("risk_pct"))
    low = half_even(quantile_of(F.col("p"), cfg.quantile), 9)
    return valued.withColumn("conservative", lesser(low, F.col("likely"))).drop("p")


def benchmark(events: DataFrame, cfg: PanelConfig, bands: HorizonBands, by: Sequence[str],
              steps: Mapping[str, int]) -> DataFrame:
    """Mean absolute error of carry-forward, age curve and Markov side by side."""
    outcomes = outcome_table(events, cfg, bands, by=by, ages=True).withColumn("_age", age_curve())
    outlook = markov_outlook(events, cfg, by, steps)
    keys = ["component", *by, "band", "r0"]
    held_out = outcomes.where("is_test").join(outlook, keys)
    scored = score(by_method(held_out, {
        "carry_forward": F.col("r0"), "age_curve": F.col("_age"), "markov": F.col("likely"),
    }), ["component", "band", "method"], weight="n")
    return scored.groupBy("component", "band").pivot(
        "method", ["carry_forward", "age_curve", "markov"]).agg(F.first("mae")).withColumnsRenamed(
        {m: f"{m}_mae" for m in ("carry_forward", "age_curve", "markov")})


def accuracy_by_start(outcomes: DataFrame, predicted: Column) -> DataFrame:
    """Means and errors by starting rating."""
    rows = outcomes.withColumn("predicted", predicted.cast("double"))
    w = F.col("n")
    means = rows.where(F.col("predicted").isNotNull()).groupBy("component", "r0").agg(
        (F.sum(w * F.col("predicted")) / F.sum(w)).alias("mean_predicted"),
        (F.sum(w * F.col("r1")) / F.sum(w)).alias("mean_actual"))
    return score(rows, ["component", "r0"], weight="n").select(
        "component", "r0", "n", "mae", "within_1").join(means, ["component", "r0"])


def decline_by_group(outcomes: DataFrame, group: str, predicted: Column, top: int = 10) -> DataFrame:
    """Predicted and actual decline of the largest groups."""
    w = F.col("n")
    rows = outcomes.withColumn("_p", predicted.cast("double")).where(F.col(group).isNotNull())
    means = rows.groupBy(group).agg(
        F.sum(w).alias("n"), (F.sum(w * F.col("r0")) / F.sum(w)).alias("mean_from"),
        (F.sum(w * F.col("_p")) / F.sum(w)).alias("mean_predicted"),
        (F.sum(w * F.col("r1")) / F.sum(w)).alias("mean_actual"))
    guess = F.col("mean_from") - F.col("mean_predicted")
    actual = F.col("mean_from") - F.col("mean_actual")
    return (
        means.withColumns({"pred_decline": guess, "actual_decline": actual,
                           "gap": F.abs(guess - actual)})
        .orderBy(F.col("n").desc(), group).limit(top)
    )


def bias_by_band(outcomes: DataFrame, predicted: Column) -> DataFrame:
    """Mean signed error per band."""
    w = F.col("n")
    return outcomes.where(predicted.isNotNull()).groupBy("component", "band").agg(
        F.sum(w).alias("n"), (F.sum(w * (predicted - F.col("r1"))) / F.sum(w)).alias("bias"))


def catch_rates(outcomes: DataFrame, methods: Mapping[str, Column], drop: float = 2.0,
                flag_drop: float = 1.0) -> DataFrame:
    """Share of real decliners a forecast flags, and share of the others it flags wrongly."""
    scored = by_method(outcomes, methods).where(F.col("predicted").isNotNull())
    declined = F.col("r0") - F.col("r1") >= drop
    flagged = F.col("r0") - F.col("predicted") >= flag_drop

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return scored.groupBy("component", "method").agg(
        total(declined).alias("decliners"), total(declined & flagged).alias("caught"),
        (total(declined & flagged) * F.lit(100.0) / F.nullif(total(declined), F.lit(0))
         ).alias("catch_pct"),
        (total(~declined & flagged) * F.lit(100.0) / F.nullif(total(~declined), F.lit(0))
         ).alias("false_alarm_pct"))


def ranking_quality(outcomes: DataFrame, rank_by: str, threshold: float,
                    share: float = 0.01) -> DataFrame:
    """AUC, and precision among the top share by score, of rows that end at or below threshold.

    Works on (score, label) counts. Equal scores are taken together: half a win each in the AUC,
    and their average precision where the cut falls among them. Scores are percentages: slices of
    a tenth are totalled first, so that no task orders all scores of a component.
    """
    poor = F.when(F.col("r1") <= threshold, F.col("n")).otherwise(0)
    points = outcomes.where(F.col(rank_by).isNotNull()).groupBy(
        "component", F.col(rank_by).alias("_s")).agg(
        F.sum("n").alias("_n"), F.sum(poor).alias("_pos"))
    whole = Window.partitionBy("component")
    better = whole.orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("component", "_slice").orderBy(F.col("_s").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    sliced = points.withColumn("_slice", F.floor(F.col("_s") * 10))
    slices = sliced.groupBy("component", "_slice").agg(
        F.sum("_n").alias("_n"), F.sum("_pos").alias("_pos")).select(
        "component", "_slice", F.sum("_n").over(whole).alias("_all"),
        F.coalesce(F.sum("_n").over(better), F.lit(0)).alias("_n_better"),
        F.coalesce(F.sum("_pos").over(better), F.lit(0)).alias("_pos_better"))
    ranked = sliced.join(slices, ["component", "_slice"]).withColumns({
        "_above": F.col("_n_better") + F.coalesce(F.sum("_n").over(above), F.lit(0)),
        "_pos_above": F.col("_pos_better") + F.coalesce(F.sum("_pos").over(above), F.lit(0)),
    })
    cut = F.ceil(F.col("_all") * F.lit(share))
    taken = F.greatest(F.lit(0), F.least(F.col("_n"), cut - F.col("_above")))
    negatives = F.col("_n") - F.col("_pos")
    wins = negatives * (F.col("_pos_above") + F.col("_pos") / F.lit(2.0))
    positives, rest = F.sum("_pos"), F.sum(negatives)
    return ranked.groupBy("component").agg(
        F.sum("_n").alias("n"),
        (F.sum(wins) / F.nullif(positives * rest, F.lit(0))).alias("auc"),
        (F.sum(taken * F.col("_pos") / F.col("_n")) / F.sum(taken)).alias("precision_top"),
        (positives / F.sum("_n")).alias("base_rate"))


def backtest_sample(pairs: DataFrame, cfg: PanelConfig, predicted: Column,
                    per_mille: int = 20) -> DataFrame:
    """A repeatable sample of held-out pairs: current, years ahead, predicted, actual, error."""
    key = F.concat_ws("|", cfg.asset_id, "component", F.col("d0").cast("string"),
                      F.col("d1").cast("string"))
    draw = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 1000
    chosen = pairs.where(is_test_asset(cfg) & (draw < per_mille))
    return chosen.select(
        cfg.asset_id, "component", F.col("d0").cast("string").alias("from_date"),
        F.col("r0").alias("current"), half_even(F.col("horizon"), 1).alias("years_ahead"),
        predicted.alias("predicted"), F.col("r1").alias("actual"),
        (predicted - F.col("r1")).alias("error"))
