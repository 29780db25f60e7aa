"""The sample tables read as an inspection panel.

Orders stand in for annual snapshots of an asset (the customer); the columns are built with plain
expressions so that the same panel can be stated in SQL. Lines stand in for the attribute extract,
parts for the attribute-value source.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.config import EXTRACT_FEATURES, HorizonBands, PanelConfig

BANDS = HorizonBands((0.0, 0.5, 2.0, 4.0, 7.0), ("1", "2", "3", "4"))
CFG = replace(PanelConfig(), max_horizon_years=7.0, bands=BANDS, pair_cap=5000)

RAW_COLUMNS = (
    "asset_id", "raw_date", "snapshot_no", "deck", "superstructure", "substructure", "culvert",
    "region", "on_system", "year_built", "year_reconstructed", "adt", "structure_length",
    "deck_width", "skew_angle", "latitude", "longitude", "inventory_load", "operating_load",
    "owner", "functional_class",
)


# The columns of the sample tables that the binding reads; declaring them spares a job per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column) -> Column:
    return column.cast("string")


def asset_code(key: Column) -> Column:
    return F.lpad(text(key), 9, "0")


def packed(degrees: str) -> tuple[str, str]:
    """DDMMSSss and DDMMSS for whole degrees, with minutes and seconds drawn from the key."""
    return (f"string(({degrees}) * 1000000 + (k % 60) * 10000 + ((k * 7) % 60) * 100 + k % 100)",
            f"string(({degrees}) * 10000 + (k % 60) * 100 + (k * 7) % 60)")


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to their customer, written as a raw export: every column but one is text."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS n", "o_custkey AS k", "o_totalprice AS price", "o_orderdate AS day",
        "o_orderpriority AS functional_class")
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_nationkey AS nation", "c_mktsegment AS owner")
    code = "lpad(string(k), 9, '0')"
    north, west = "26 + k % 10", "94 + k % 12"
    quarter = "'.' || lpad(string((k % 4) * 25), 2, '0')"
    (lat_long, lat_short), (lon_long, lon_short) = packed(north), packed(west)
    hundredth = "'.' || lpad(string(n % 100), 2, '0')"
    return orders.join(customer, "k").selectExpr(
        f"CASE WHEN n % 13 = 0 THEN ' ' || {code} || ' ' ELSE {code} END AS asset_id",
        "string(bigint(date_format(day, 'MMddyyyy'))) AS raw_date",
        "n AS snapshot_no",
        "CASE WHEN n % 17 = 0 THEN 'N' ELSE string(bigint(least(9, floor(price / 55000)))) END AS deck",
        "string((n * 7 + nation) % 10) AS superstructure",
        "string((n * 3 + k) % 10) AS substructure",
        "CASE WHEN k % 7 = 0 THEN string(4 + n % 5) ELSE 'N' END AS culvert",
        "CASE WHEN n % 2 = 0 THEN lpad(string(nation), 2, '0') ELSE string(nation) END AS region",
        "CASE WHEN owner IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND n % 97 <> 0 THEN 'ON' "
        "ELSE 'OFF' END AS on_system",
        "string(CASE WHEN k % 41 = 0 THEN 110 WHEN k % 43 = 0 THEN 9650 ELSE 1900 + k % 95 END) "
        "AS year_built",
        "string(CASE WHEN k % 5 = 0 THEN 1990 + k % 10 ELSE 0 END) AS year_reconstructed",
        "CASE WHEN n % 29 = 0 THEN 'junk' ELSE string(bigint(floor(price / 100))) END AS adt",
        "string((k % 50) * 10) AS structure_length",
        "string(20 + nation) AS deck_width",
        "string(k % 110) AS skew_angle",
        f"CASE n % 6 WHEN 0 THEN string({north}) || {quarter} WHEN 1 THEN {lat_long} "
        f"WHEN 2 THEN {lat_short} WHEN 3 THEN '0' WHEN 4 THEN '12345678' END AS latitude",
        f"CASE n % 6 WHEN 0 THEN '-' || string({west}) || {quarter} WHEN 1 THEN {lon_long} "
        f"WHEN 2 THEN {lon_short} WHEN 3 THEN '0' WHEN 4 THEN '999' END AS longitude",
        f"CASE WHEN n % 2 = 1 THEN string(100 + n % 150) ELSE string(n % 3) || {hundredth} END "
        "AS inventory_load",
        f"CASE WHEN n % 2 = 0 THEN string(120 + n % 150) ELSE string(n % 4) || {hundredth} END "
        "AS operating_load",
        "owner", "functional_class",
    )


def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in six ways, two of them unreadable."""
    n, d = F.col("o_orderkey"), F.col("o_orderdate")
    digits = text(F.date_format(d, "MMddyyyy").cast("bigint"))
    written = (
        F.when(n % 6 == 0, digits).when(n % 6 == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(n % 6 == 2, F.date_format(d, "MM/dd/yyyy")).when(n % 6 == 3, "junk")
        .when(n % 6 == 4, F.concat(digits, F.lit(".0"))).otherwise(F.date_format(d, "yyyy"))
    )
    return table(spark, sf_dir, "orders").select(n.alias("snapshot_no"), written.alias("raw_date"))


def extract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute rows, several per asset; some belong to codes that the panel does not know."""
    p = F.col("l_partkey")
    code = asset_code(p)
    return table(spark, sf_dir, "lineitem").select(
        F.when(p % 10 == 3, F.concat(F.lit("Z"), code)).otherwise(code).alias("as_id"), F.col("l_orderkey").alias("row_order"),
        text(F.col("l_linenumber")).alias("num_spans_main"),
        text(F.col("l_quantity").cast("bigint")).alias("num_beam_lines"),
        F.when(p % 9 != 0, F.concat(F.lit("M"), text((p * 7) % 6))).alias("structure_kind"),
        F.col("l_returnflag").alias("wearing_surface"),
        F.col("l_linestatus").alias("scour_vulnerability"),
    )


EXTRACT_ORDER = ("row_order", "num_spans_main", "num_beam_lines", "wearing_surface",
                 "scour_vulnerability")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    stem = F.concat(text(p % 4), F.lpad(text(p), 13, "0"))
    return table(spark, sf_dir, "part").select(
        p.alias("as_id"),
        F.when(p % 31 == 0, F.concat(F.lit("1test"), F.lpad(text(p), 9, "0")))
        .when(p % 37 == 0, F.concat(F.lit("2##"), F.lpad(text(p), 11, "0")))
        .when(p % 11 == 0, F.lit("0")).when(p % 5 == 0, F.concat(stem, F.lit("X")))
        .otherwise(stem).alias("as_code"),
        F.when(p % 19 == 0, 2).otherwise(1).alias("at_id"),
        F.when(p % 23 == 0, 1).otherwise(0).alias("as_root"),
        F.when(p % 29 == 0, 1).otherwise(0).alias("as_deleted"),
        (p % 5).cast("int").alias("asset_status_id"),
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("asset_status_id"))


#: Parts of one task, each of which becomes a row per feature.
PARTS_PER_TASK = 25_000


def attribute_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and feature, some without a value.

    Every part becomes many rows, so the parts are spread first: a file of them is a small one.
    """
    p = F.col("p_partkey")
    parts = table(spark, sf_dir, "part").select(p)
    tasks = -(-parts.count() // PARTS_PER_TASK)
    if tasks > 1:
        parts = parts.repartition(tasks)
    numbered = F.array(*[
        F.struct(F.lit(fid).alias("fe_id"), F.lit(i).alias("i"))
        for i, fid in enumerate(EXTRACT_FEATURES.values())])
    return (
        parts.select(p, F.inline(numbered))
        .select(p.alias("as_id"), "fe_id", F.when(
            (p + F.col("i")) % 11 != 0, text((p * (F.col("i") + 1)) % 97)).alias("cv_value"))
    )
