"""The sample panel and its derived tables as SQL, for checking against another engine."""

from __future__ import annotations

from wearline.config import EXTRACT_FEATURES
from wearline.sources.order_panel import BANDS

COMPONENTS = ("deck", "superstructure", "substructure", "culvert")


def number(name: str) -> str:
    return f"TRY_CAST(trim({name}) AS DOUBLE)"


def degrees(a: str) -> str:
    return f"""CASE WHEN {a} > 0 AND {a} <= 200 THEN {a}
      WHEN {a} >= 10000 AND {a} < 1000000
        THEN floor({a}/10000) + floor(({a} % 10000)/100)/60.0 + ({a} % 100)/3600.0
      WHEN {a} >= 1000000 AND {a} < 1000000000
        THEN floor({a}/1000000) + floor(({a} % 1000000)/10000)/60.0 + (({a} % 10000)/100.0)/3600.0 END"""


def boxed(value: str, low: float, high: float) -> str:
    return f"CASE WHEN {value} BETWEEN {low} AND {high} THEN {value} END"


def factor(name: str) -> str:
    v = number(name)
    return f"CASE WHEN abs({v}) <= 10 THEN {v} ELSE {v}/100.0 END"


def share_bucket(key: str, seed: int = 42) -> str:
    return f"(CAST('0x' || substr(md5({key} || '{seed}'), 1, 8) AS BIGINT) % 1000)"


def is_test(key: str = "asset_id") -> str:
    return f"({share_bucket(key)} < 300)"


def clip(value: str, low: float = 0, high: float = 130) -> str:
    return f"(CASE WHEN {value} IS NOT NULL THEN greatest({low}, least({high}, {value})) END)"


def band(horizon: str = "horizon") -> str:
    cases = " ".join(f"WHEN {horizon} <= {top} THEN '{label}'"
                     for top, label in zip(BANDS.edges[1:], BANDS.labels))
    return f"CASE WHEN {horizon} <= 0 THEN NULL {cases} END"


RAW = """raw AS (
  SELECT CASE WHEN o_orderkey % 13 = 0 THEN ' ' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' '
              ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS asset_id,
    CAST(CAST(strftime(o_orderdate, '%m%d%Y') AS BIGINT) AS VARCHAR) AS raw_date,
    o_orderkey AS snapshot_no,
    CASE WHEN o_orderkey % 17 = 0 THEN 'N'
         ELSE CAST(CAST(least(9, floor(o_totalprice / 55000)) AS BIGINT) AS VARCHAR) END AS deck,
    CAST((o_orderkey * 7 + c_nationkey) % 10 AS VARCHAR) AS superstructure,
    CAST((o_orderkey * 3 + o_custkey) % 10 AS VARCHAR) AS substructure,
    CASE WHEN o_custkey % 7 = 0 THEN CAST(4 + o_orderkey % 5 AS VARCHAR) ELSE 'N' END AS culvert,
    CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
         ELSE CAST(c_nationkey AS VARCHAR) END AS region,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND o_orderkey % 97 <> 0
         THEN 'ON' ELSE 'OFF' END AS on_system,
    CAST(CASE WHEN o_custkey % 41 = 0 THEN 110 WHEN o_custkey % 43 = 0 THEN 9650
              ELSE 1900 + o_custkey % 95 END AS VARCHAR) AS year_built,
    CAST(CASE WHEN o_custkey % 5 = 0 THEN 1990 + o_custkey % 10 ELSE 0 END AS VARCHAR)
      AS year_reconstructed,
    CASE WHEN o_orderkey % 29 = 0 THEN 'junk'
         ELSE CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) END AS adt,
    CAST((o_custkey % 50) * 10 AS VARCHAR) AS structure_length,
    CAST(20 + c_nationkey AS VARCHAR) AS deck_width,
    CAST(o_custkey % 110 AS VARCHAR) AS skew_angle,
    CASE o_orderkey % 6
      WHEN 0 THEN CAST(26 + o_custkey % 10 AS VARCHAR) || '.' ||
                  lpad(CAST((o_custkey % 4) * 25 AS VARCHAR), 2, '0')
      WHEN 1 THEN CAST((26 + o_custkey % 10) * 1000000 + (o_custkey % 60) * 10000
                  + ((o_custkey * 7) % 60) * 100 + o_custkey % 100 AS VARCHAR)
      WHEN 2 THEN CAST((26 + o_custkey % 10) * 10000 + (o_custkey % 60) * 100
                  + (o_custkey * 7) % 60 AS VARCHAR)
      WHEN 3 THEN '0' WHEN 4 THEN '12345678' END AS latitude,
    CASE o_orderkey % 6
      WHEN 0 THEN '-' || CAST(94 + o_custkey % 12 AS VARCHAR) || '.' ||
                  lpad(CAST((o_custkey % 4) * 25 AS VARCHAR), 2, '0')
      WHEN 1 THEN CAST((94 + o_custkey % 12) * 1000000 + (o_custkey % 60) * 10000
                  + ((o_custkey * 7) % 60) * 100 + o_custkey % 100 AS VARCHAR)
      WHEN 2 THEN CAST((94 + o_custkey % 12) * 10000 + (o_custkey % 60) * 100
                  + (o_custkey * 7) % 60 AS VARCHAR)
      WHEN 3 THEN '0' WHEN 4 THEN '999' END AS longitude,
    CASE WHEN o_orderkey % 2 = 1 THEN CAST(100 + o_orderkey % 150 AS VARCHAR)
         ELSE CAST(o_orderkey % 3 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
         END AS inventory_load,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(120 + o_orderkey % 150 AS VARCHAR)
         ELSE CAST(o_orderkey % 4 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')
         END AS operating_load,
    c_mktsegment AS owner, o_orderpriority AS functional_class
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PANEL = f"""panel AS (
  SELECT trim(asset_id) AS asset_id, raw_date, snapshot_no, on_system,
    {', '.join(f'{number(c)} AS {c}' for c in COMPONENTS)},
    CAST(CAST(region AS BIGINT) AS VARCHAR) AS region,
    {', '.join(f'{number(c)} AS {c}' for c in ('year_built', 'year_reconstructed', 'adt',
                                             'structure_length', 'deck_width', 'skew_angle'))},
    {boxed('lat', 24, 38)} AS latitude, {boxed('lon', -108, -92)} AS longitude,
    {factor('inventory_load')} AS inventory_load, {factor('operating_load')} AS operating_load,
    owner, functional_class
  FROM (SELECT *, sign(lat_raw) * ({degrees('abs(lat_raw)')}) AS lat,
               -({degrees('abs(lon_raw)')}) AS lon
        FROM (SELECT *, {number('latitude')} AS lat_raw, {number('longitude')} AS lon_raw
              FROM raw))
  WHERE {' OR '.join(f'{number(c)} IS NOT NULL' for c in COMPONENTS)})"""
# The inner columns latitude/longitude are the raw text; the outer ones are decoded.
PANEL = PANEL.replace("(SELECT *, sign", "(SELECT * EXCLUDE (latitude, longitude), sign")

EVENTS = """dated AS (
  SELECT *, CAST(try_strptime(lpad(raw_date, 8, '0'), '%m%d%Y') AS DATE) AS event_date FROM panel),
events AS MATERIALIZED (
  SELECT * FROM dated WHERE event_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY asset_id, event_date ORDER BY snapshot_no) = 1),
latest AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY event_date DESC) = 1)"""


def unpivot(source: str, value: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, '{c}' AS component, {c} AS {value} FROM {source} WHERE {c} IS NOT NULL"
        for c in COMPONENTS)


COMMON = "asset_id, event_date, year_built, region, on_system, snapshot_no"
LONG = f"""long AS MATERIALIZED ({unpivot('events', 'rating', COMMON)}),
starts AS (SELECT *, {clip('(year(event_date) - year_built)')} AS age_t0
  FROM ({unpivot('latest', 'r0', COMMON)})),
pairs AS (
  SELECT a.asset_id, a.component, a.event_date AS d0, b.event_date AS d1,
    date_diff('day', a.event_date, b.event_date) / CAST(365.25 AS DOUBLE) AS horizon,
    a.rating AS r0, b.rating AS r1,
    {clip('(year(a.event_date) - a.year_built)')} AS age_t0, a.year_built
  FROM long a JOIN long b ON a.asset_id = b.asset_id AND a.component = b.component
    AND b.event_date > a.event_date
    AND date_diff('day', a.event_date, b.event_date) <= 7 * 365.25)"""

#: The pairs once more, joined before the ratings are unpivoted, for statements that need no long form.
DIRECT_PAIRS = f"""joined AS MATERIALIZED (
  SELECT a.asset_id, a.event_date AS d0, b.event_date AS d1,
    date_diff('day', a.event_date, b.event_date) / CAST(365.25 AS DOUBLE) AS horizon,
    {clip('(year(a.event_date) - a.year_built)')} AS age_t0,
    {', '.join(f'a.{c} AS {c}0, b.{c} AS {c}1' for c in COMPONENTS)}
  FROM events a JOIN events b ON a.asset_id = b.asset_id
  WHERE date_diff('day', a.event_date, b.event_date) BETWEEN 1 AND 7 * 365.25),
direct AS ({' UNION ALL '.join(
    f"SELECT asset_id, '{c}' AS component, d0, d1, horizon, {c}0 AS r0, {c}1 AS r1, age_t0 FROM joined "
    f"WHERE {c}0 IS NOT NULL AND {c}1 IS NOT NULL" for c in COMPONENTS)})"""

STATIC = """extract_rows AS (
  SELECT CASE WHEN l_partkey % 10 = 3 THEN 'Z' ELSE '' END || lpad(CAST(l_partkey AS VARCHAR), 9, '0')
      AS asset_id, l_orderkey AS row_order,
    CAST(l_linenumber AS VARCHAR) AS num_spans_main,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS num_beam_lines,
    CASE WHEN l_partkey % 9 <> 0 THEN 'M' || CAST((l_partkey * 7) % 6 AS VARCHAR) END AS structure_kind,
    l_returnflag AS wearing_surface, l_linestatus AS scour_vulnerability
  FROM lineitem),
static AS (
  SELECT asset_id, CAST(num_spans_main AS DOUBLE) AS num_spans_main,
    CAST(num_beam_lines AS DOUBLE) AS num_beam_lines, structure_kind, wearing_surface,
    scour_vulnerability
  FROM extract_rows
  QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY row_order, num_spans_main,
    num_beam_lines, wearing_surface, scour_vulnerability) = 1)"""

FEATURE_ROWS = ", ".join(f"({fid}, {i})" for i, fid in enumerate(EXTRACT_FEATURES.values()))
EAV = f"""assets AS (
  SELECT p_partkey AS as_id,
    CASE WHEN p_partkey % 31 = 0 THEN '1test' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')
         WHEN p_partkey % 37 = 0 THEN '2##' || lpad(CAST(p_partkey AS VARCHAR), 11, '0')
         WHEN p_partkey % 11 = 0 THEN '0'
         WHEN p_partkey % 5 = 0 THEN CAST(p_partkey % 4 AS VARCHAR) || lpad(CAST(p_partkey AS VARCHAR), 13, '0') || 'X'
         ELSE CAST(p_partkey % 4 AS VARCHAR) || lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS as_code,
    CASE WHEN p_partkey % 19 = 0 THEN 2 ELSE 1 END AS at_id,
    CASE WHEN p_partkey % 23 = 0 THEN 1 ELSE 0 END AS as_root,
    CASE WHEN p_partkey % 29 = 0 THEN 1 ELSE 0 END AS as_deleted,
    p_partkey % 5 AS asset_status_id
  FROM part),
feature_list(fe_id, i) AS (VALUES {FEATURE_ROWS}),
attribute_values AS (
  SELECT p_partkey AS as_id, fe_id,
    CASE WHEN (p_partkey + i) % 11 <> 0 THEN CAST((p_partkey * (i + 1)) % 97 AS VARCHAR) END AS cv_value
  FROM part CROSS JOIN feature_list)"""

SCORED = "greatest(0, least(9, predicted))"


def measures(actual: str = "r1", weight: str = "1", steps=(1.0,)) -> str:
    """The error measures of weighted rows with columns ``predicted`` and the actual rating."""
    miss = f"abs({actual} - {SCORED})"
    n = f"CAST(sum({weight}) AS DOUBLE)"
    squares = f"sum({weight} * {miss} * {miss})"
    spread = (f"(sum({weight} * {actual} * {actual}) - sum({weight} * {actual}) "
              f"* sum({weight} * {actual}) / {n})")
    within = ", ".join(
        f"round_even(sum({weight} * CASE WHEN {miss} <= {k} THEN 1 ELSE 0 END) * 100.0::DOUBLE / {n}, 6) "
        f"AS within_{f'{k:g}'.replace('.', '_')}" for k in steps)
    return f"""CAST(sum({weight}) AS BIGINT) AS n,
      round_even(sum({weight} * {miss}) / {n}, 6) AS mae,
      round_even(sqrt({squares} / {n}), 6) AS rmse,
      round_even(CASE WHEN {n} < 2 THEN NULL
           WHEN max({actual}) = min({actual}) AND {squares} = 0 THEN 1
           WHEN max({actual}) = min({actual}) THEN 0
           ELSE 1 - {squares} / {spread} END, 6) AS r2,
      {within}"""


MARKOV = """steps AS (
  SELECT asset_id, component, rating, event_date,
    lag(rating) OVER (PARTITION BY asset_id, component ORDER BY event_date) AS previous_rating
  FROM long),
train_steps AS (
  SELECT component, coalesce(structure_kind, 'unknown') AS structure_kind, CAST(previous_rating AS INT) AS f, CAST(rating AS INT) AS t,
    count(*) AS n
  FROM steps LEFT JOIN static USING (asset_id)
  WHERE previous_rating IS NOT NULL AND NOT """ + is_test() + """
  GROUP BY ALL),
seen AS (
  SELECT component, structure_kind, f, t, n / CAST(sum(n) OVER (PARTITION BY component, structure_kind, f) AS DOUBLE) AS p
  FROM train_steps),
scale(r) AS (SELECT unnest(range(10))),
strata AS (SELECT DISTINCT component, coalesce(structure_kind, 'unknown') AS structure_kind
  FROM long LEFT JOIN static USING (asset_id)),
all_steps AS (
  SELECT component, structure_kind, f, t, n FROM train_steps
  UNION ALL
  SELECT component, g.structure_kind, p.f, p.t, p.n
  FROM strata g JOIN (SELECT component, f, t, sum(n) AS n FROM train_steps GROUP BY ALL) p USING (component)
  WHERE NOT EXISTS (SELECT 1 FROM train_steps s
                    WHERE s.component = g.component AND s.structure_kind = g.structure_kind)),
covering AS (
  SELECT component, structure_kind, f, t, n / CAST(sum(n) OVER (PARTITION BY component, structure_kind, f) AS DOUBLE) AS p
  FROM all_steps),
m1 AS (
  SELECT g.component, g.structure_kind, CAST(a.r AS INT) AS f, CAST(b.r AS INT) AS t,
    CASE WHEN EXISTS (SELECT 1 FROM covering s WHERE s.component = g.component
                      AND s.structure_kind = g.structure_kind AND s.f = a.r)
         THEN coalesce(c.p, 0) ELSE CASE WHEN a.r = b.r THEN 1 ELSE 0 END END AS p
  FROM strata g CROSS JOIN scale a CROSS JOIN scale b
  LEFT JOIN covering c ON c.component = g.component AND c.structure_kind = g.structure_kind
    AND c.f = a.r AND c.t = b.r)"""


def power(k: int, left: str, right: str = "m1") -> str:
    return f"""m{k} AS (
  SELECT x.component, x.structure_kind, x.f, y.t, sum(x.p * y.p) AS p
  FROM {left} x JOIN {right} y ON x.component = y.component
    AND x.structure_kind = y.structure_kind AND x.t = y.f
  GROUP BY ALL)"""


MARKOV += ", " + ", ".join(power(k, f"m{k - 1}") for k in range(2, 9))


def outlook(steps: dict[str, int], q: float = 0.25) -> str:
    """CTE ``outlook``: component, structure_kind, band, r0, likely, conservative, risk_pct."""
    rows = " UNION ALL ".join(f"SELECT '{b}' AS band, * FROM m{k}" for b, k in steps.items())
    return f"""spread AS ({rows}),
running AS (
  SELECT *, sum(p) OVER (PARTITION BY band, component, structure_kind, f ORDER BY t
                         ROWS UNBOUNDED PRECEDING) AS upto FROM spread),
cut AS (
  SELECT band, component, structure_kind, f, least(9, greatest(0, t - 0.5 + ({q} - (upto - p)) / p)) AS q
  FROM running WHERE p > 0 AND upto >= {q} - 1e-9
  QUALIFY row_number() OVER (PARTITION BY band, component, structure_kind, f ORDER BY t) = 1),
outlook AS (
  SELECT s.component, s.structure_kind, s.band, s.f AS r0,
    round_even(greatest(0, least(9, sum(s.p * s.t))), 9) AS likely,
    least(round_even(max(cut.q), 9), round_even(greatest(0, least(9, sum(s.p * s.t))), 9)) AS conservative,
    round_even(sum(CASE WHEN s.t <= 5 THEN s.p ELSE 0 END) * 100, 9) AS risk_pct
  FROM spread s JOIN cut ON s.band = cut.band AND s.component = cut.component
    AND s.structure_kind = cut.structure_kind AND s.f = cut.f
  GROUP BY s.component, s.structure_kind, s.band, s.f)"""


PARTS = {"raw": RAW, "panel": PANEL, "events": EVENTS, "long": LONG, "static": STATIC, "eav": EAV,
         "markov": MARKOV}
NEEDS = {"raw": [], "panel": ["raw"], "events": ["raw", "panel"],
         "long": ["raw", "panel", "events"], "static": [], "eav": [],
         "markov": ["raw", "panel", "events", "long", "static"]}


def sql(body: str, *parts: str, extra: str = "") -> str:
    """A statement with the named parts, and what they rest on, in front."""
    used = {n for p in parts for n in [*NEEDS[p], p]}
    ctes = [PARTS[p] for p in PARTS if p in used] + ([extra] if extra else [])
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body
