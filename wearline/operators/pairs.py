"""Every inspection against every later inspection of the same asset.

Two forms exist. ``forward_pairs`` emits the pairs themselves, for model training.
``outcome_counts`` counts them without emitting them: running rating counts per asset are read at
the band edges, so the work is linear in the inspections however many an asset has. All band-level
measures use the second form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from wearline.config import HorizonBands, PanelConfig
from wearline.functions.dates import age_on, whole_days, years_between
from wearline.operators.events import by_component
from wearline.session import observed, settle

RATINGS = range(10)
#: Running counts lie three to a 64-bit number. One of 21 bits is enough for an inspection on every
#: day of 5,700 years, and an asset has one inspection a day.
FIELD, PER_WORD = 21, 3


def forward_pairs(events: DataFrame, cfg: PanelConfig, features: Sequence[str] = (),
                  split_above: int | None = 1024) -> DataFrame:
    """(t0, t1) pairs of one asset within the horizon limit, long over component.

    The ratings stay wide through the join: one join serves all components. ``events`` must be
    the output of ``inspection_events``: an asset then meets at most one partner per calendar
    day. Assets with more than ``split_above`` inspections are cut into parts of about that many
    starts, each part joined in its own task against a copy of the asset's later inspections.
    The events are read several times, so a large set should be settled first. Without ``split_above``
    assets stay whole, and events that are stored by asset join where they lie.
    """
    joined, ratings, carried = _joined(events, cfg, features, split_above)
    entries = ", ".join(f"struct('{c}' AS component, _r0.`{c}` AS r0, _r1.`{c}` AS r1)"
                        for c in ratings)
    return (
        joined.selectExpr(cfg.asset_id, "d0", "d1", *[f"`{c}`" for c in carried], f"inline(array({entries}))")
        .where("r0 IS NOT NULL AND r1 IS NOT NULL")
        .select(cfg.asset_id, "component", "d0", "d1",
                years_between(F.col("d0"), F.col("d1")).alias("horizon"),
                "r0", "r1", _age_at_start(cfg, carried).alias("age_t0"), *carried)
    )


def wide_pairs(events: DataFrame, cfg: PanelConfig, features: Sequence[str] = (),
               split_above: int | None = 1024) -> DataFrame:
    """``forward_pairs`` before they are long: one row for all components, with r0__ and r1__ of each.

    What a pair carries is written once and not once per component. ``long_pairs`` reads it.
    """
    joined, ratings, carried = _joined(events, cfg, features, split_above)
    rated = " OR ".join(f"(_r0.`{c}` IS NOT NULL AND _r1.`{c}` IS NOT NULL)" for c in ratings)
    return joined.where(rated or "false").select(
        cfg.asset_id, "d0", "d1", years_between(F.col("d0"), F.col("d1")).alias("horizon"),
        _age_at_start(cfg, carried).alias("age_t0"), *carried,
        *[F.col(f"_r{i}")[c].alias(f"r{i}__{c}") for c in ratings for i in (0, 1)])


def long_pairs(wide: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The pairs of ``forward_pairs``; whoever asks for one component reads the ratings of no other."""
    first = [cfg.asset_id, "component", "d0", "d1", "horizon", "r0", "r1", "age_t0"]
    rest = [c for c in wide.columns if c not in first and not c.startswith(("r0__", "r1__"))]
    parts = [
        wide.where(F.col(f"r0__{c}").isNotNull() & F.col(f"r1__{c}").isNotNull()).withColumns(
            {"component": F.lit(c), "r0": F.col(f"r0__{c}"), "r1": F.col(f"r1__{c}")}).select(*first, *rest)
        for c in cfg.components if f"r0__{c}" in wide.columns]
    return reduce(DataFrame.unionByName, parts)


def _age_at_start(cfg: PanelConfig, carried: Sequence[str]) -> Column:
    return age_on(F.col("d0"), F.col(cfg.year_built) if cfg.year_built in carried else F.lit(None).cast("double"))


def _joined(events: DataFrame, cfg: PanelConfig, features: Sequence[str],
            split_above: int | None) -> tuple[DataFrame, list[str], list[str]]:
    """Starts with their later inspections, the ratings of both as structs, the components and what is carried."""
    a, d = cfg.asset_id, cfg.event_date
    ratings = [c for c in cfg.components if c in events.columns]
    carried = [c for c in dict.fromkeys([*features, cfg.year_built])
               if c in events.columns and c not in ratings]
    gap = F.datediff("d1", "d0")
    near = (gap > 0) & (gap <= whole_days(cfg.max_horizon_years))
    start = events.select(a, F.col(d).alias("d0"), F.struct(*ratings).alias("_r0"), *carried)
    later = events.select(F.col(a).alias("_a"), F.col(d).alias("d1"), F.struct(*ratings).alias("_r1"))
    same = F.col(a) == F.col("_a")
    joined = start.join(later, same & near) if split_above is None else _split_join(
        events, cfg, start, later, same & near, split_above)
    return joined, ratings, carried


def _split_join(events: DataFrame, cfg: PanelConfig, start: DataFrame, later: DataFrame, condition: Column,
                split_above: int) -> DataFrame:
    """The join with large assets in parts: each start in one part, each later row in all."""
    a = cfg.asset_id
    large = events.groupBy(F.col(a).alias("_large")).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > split_above).select(
        "_large", F.ceil(F.col("_n") / split_above).cast("int").alias("_parts"))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    start = start.join(large, F.col(a) == F.col("_large"), "left").withColumn(
        "_part", F.pmod(F.hash("d0"), parts)).drop("_large", "_parts")
    later = later.join(large, F.col("_a") == F.col("_large"), "left").select(
        "_a", "d1", "_r1", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_copy"))
    return start.join(later, condition & (F.col("_part") == F.col("_copy")))


#: Draws are read as 60-bit numbers; a kept share is cut into this many even slices for ranking.
DRAWS = 1 << 60
RANK_SLICES = 4096


def settle_counted(pairs: DataFrame, cfg: PanelConfig, name: str = "pairs") -> tuple[DataFrame, dict[str, int]]:
    """Pairs written once, with their number per component counted by the same job."""
    seen = Observation()
    counts = [F.count_if(F.col("component") == c).alias(c) for c in cfg.components]
    written = settle(pairs.observe(seen, *counts), name)
    found = observed(seen, list(cfg.components))
    return written, {c: found[c] or 0 for c in cfg.components}


def cap_pairs(pairs: DataFrame, cfg: PanelConfig, cap: int | None = None,
              sizes: Mapping[str, int] | None = None) -> DataFrame:
    """A repeatable sample of exactly ``cap`` pairs per component, without a global sort.

    The sample is the ``cap`` first pairs by an md5 of their key. With the number of pairs known, the
    cap-th draw lies below cap / n of all possible draws but for a margin of ten standard deviations.
    One scan writes the pairs below that; only these are ranked, in even slices. Should they ever be
    fewer than the cap, the margin is doubled and the scan repeated. Components at or below the cap are
    kept whole. Without ``sizes`` the pairs are written first and counted meanwhile.
    """
    cap = cfg.pair_cap if cap is None else cap
    if sizes is None:
        pairs, sizes = settle_counted(pairs, cfg)
    over = {c: n for c, n in sizes.items() if n > cap}
    if not over:
        return pairs
    key = F.concat_ws("|", cfg.asset_id, "component", F.col("d0").cast("string"),
                      F.col("d1").cast("string"), F.lit(str(cfg.seed)))
    number = F.conv(F.substring("_draw", 1, 15), 16, 10).cast("long")
    drawn = pairs.withColumn("_draw", F.md5(key))
    margin = 10.0
    while True:
        limits = {c: min(DRAWS, int(DRAWS * ((cap + margin * (cap + 1) ** 0.5) / n))) for c, n in over.items()}
        limit, below = F.lit(None).cast("long"), F.lit(True)
        for c, most in limits.items():
            limit = F.when(F.col("component") == c, F.lit(most)).otherwise(limit)
            # As text, hex digits of one length are in the order of their numbers; none is above "g".
            below = F.when(F.col("component") == c, F.col("_draw") < (f"{most:015x}" if most < DRAWS else "g")).otherwise(below)
        near, found = settle_counted(drawn.where(below).withColumn("_limit", limit).withColumn(
            "_number", F.when(F.col("_limit").isNotNull(), number)), cfg, "near-cap")
        if all(found[c] >= cap for c in over):
            break
        margin *= 2
    # Components that are kept whole have no draw to rank.
    whole = near.where(F.col("_limit").isNull())
    sliced = near.where(F.col("_limit").isNotNull()).withColumn(
        "_slice", (F.col("_number") / F.col("_limit") * RANK_SLICES).cast("int"))
    running = Window.partitionBy("component").orderBy("_slice")
    slices = (
        sliced.groupBy("component", "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(running) - F.col("_n")).drop("_n")
    )
    place = F.row_number().over(Window.partitionBy("component", "_slice").orderBy("_draw"))
    ranked = sliced.join(slices, ["component", "_slice"])
    cut = ranked.where(F.col("_before") < cap).withColumn("_place", place).where(F.col("_before") + F.col("_place") <= cap)
    return whole.select(*pairs.columns).unionByName(cut.select(*pairs.columns))


def occurring_ratings(events: DataFrame, cfg: PanelConfig, limit: int = 100) -> list[float]:
    """The distinct ratings of all components in order, for panels that use half points.

    ``outcome_counts`` holds one column per rating and band edge, so more than ``limit`` of them
    are an error.
    """
    narrow = events.select(cfg.asset_id, *[c for c in cfg.components if c in events.columns])
    found = [r["rating"] for r in by_component(narrow, cfg).select("rating").distinct().limit(
        limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} different ratings")
    return sorted(found)


def outcome_counts(events: DataFrame, cfg: PanelConfig, bands: HorizonBands,
                   by: Sequence[str] = (), extra_edges: Sequence[float] = (),
                   ratings: Sequence[float] = RATINGS, off_scale: bool = False,
                   stored_by_asset: bool = False) -> DataFrame:
    """How often a start rated r0 is later rated r1, per component, band and ``by``.

    One output row is (component, r0, by, band, span, r1, n). Spans are the bands, cut further at
    ``extra_edges``; ``span`` holds the span's upper edge in years. Per asset and component runs one
    state: how often each rating occurred so far, packed into a few numbers. It is read at every edge
    of a start, and a span is the difference of two readings. The spans are summed while still wide,
    so neither pairs nor starts are ever multiplied.

    Ratings that are not in ``ratings`` are counted together as a null rating; those rows come out
    only with ``off_scale``. ``occurring_ratings`` gives the scale of a panel with others. Events that
    are stored by asset are not moved.
    """
    kind = "int" if all(float(r).is_integer() for r in ratings) else "double"
    scale = [f"CAST({r} AS {kind})" for r in ratings]
    slots, words = range(len(scale) + 1), range(-(-(len(scale) + 1) // PER_WORD))
    inner = [e for e in extra_edges if bands.edges[0] < e < bands.max_years]
    edges = sorted({*bands.edges, *inner})
    spans = range(1, len(edges))
    narrow = events.select(*dict.fromkeys(
        [cfg.asset_id, cfg.event_date, *[c for c in cfg.components if c in events.columns], *by]))
    slot = " ".join(f"WHEN {v} THEN {r}" for r, v in enumerate(scale))
    rated = by_component(narrow if stored_by_asset else narrow.repartition(cfg.asset_id), cfg).selectExpr(
        cfg.asset_id, "component", *by, f"unix_date({cfg.event_date}) AS _day",
        f"CASE rating {slot} ELSE {len(scale)} END AS _slot").selectExpr(
        "*", *[f"IF(_slot DIV {PER_WORD} = {w}, shiftleft(1L, {FIELD} * (_slot % {PER_WORD})), 0L) AS _w{w}" for w in words])
    state = rated.selectExpr("component", "_slot", *by, *[
        f"sum(_w{w}) OVER (PARTITION BY {cfg.asset_id}, component ORDER BY _day "
        f"RANGE BETWEEN UNBOUNDED PRECEDING AND {whole_days(edge)} FOLLOWING) AS _c{i}_{w}"
        for i, edge in enumerate(edges) for w in words])
    # Every field of a later reading is at least that of an earlier one, so packed numbers subtract.
    readings = ", ".join(f"struct({i} AS _span, {', '.join(f'_c{i}_{w} - _c{i - 1}_{w} AS _d{w}' for w in words)})" for i in spans)
    between = state.selectExpr("component", "_slot", *by, f"inline(array({readings}))").where(" OR ".join(f"_d{w} > 0" for w in words))
    summed = between.groupBy("component", "_slot", "_span", *by).agg(*[
        F.expr(f"sum(shiftright(_d{r // PER_WORD}, {FIELD * (r % PER_WORD)}) & {(1 << FIELD) - 1}L) AS _n{r}") for r in slots])

    def label(upper):
        return next(name for top, name in zip(bands.edges[1:], bands.labels) if upper <= top)

    def rating(r):
        return scale[r] if r < len(scale) else f"CAST(NULL AS {kind})"

    start = "CASE _slot " + " ".join(f"WHEN {r} THEN {v}" for r, v in enumerate(scale)) + " END AS r0"
    names = ", ".join(f"{i}, struct('{label(edges[i])}' AS band, {float(edges[i])}D AS span)" for i in spans)
    cells = ", ".join(f"struct({rating(r)} AS r1, _n{r} AS n)" for r in slots)
    rows = summed.selectExpr("component", start, *by, f"map({names})[_span] AS _b", f"inline(array({cells}))").where("n > 0").selectExpr(
        "component", "r0", *by, "_b.band", "_b.span", "r1", "n")
    return rows if off_scale else rows.where("r0 IS NOT NULL AND r1 IS NOT NULL")
