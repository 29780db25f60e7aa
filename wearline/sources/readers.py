"""Scans with declared schemas; nothing is inferred."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.config import EXTRACT_COLUMNS

log = logging.getLogger(__name__)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Panel files. CSV is read all-text under ``columns`` so identifiers keep leading zeros."""
    if fmt == "csv":
        if columns is None:
            raise ValueError("a CSV panel needs its column names")
        return spark.read.schema(text_schema(columns)).option("header", True).csv(path)
    return spark.read.format(fmt).load(path)


def read_source(spark: SparkSession, table: str | None = None, query: str | None = None,
                id_columns: Sequence[str] = (), jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A catalogue table or a query, with lower-case names and textual identifiers.

    With ``jdbc`` options the same table or query is read from that database.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if jdbc is not None:
        key, value = ("dbtable", table) if table else ("query", query)
        df = spark.read.format("jdbc").options(**jdbc).option(key, value).load()
    else:
        df = spark.table(table) if table else spark.sql(query)
    df = df.toDF(*[name.lower() for name in df.columns])
    return df.withColumns({c: F.col(c).cast("string") for c in id_columns if c in df.columns})


def restrict(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Row restriction that reaches the scan."""
    return df.where(F.col(column).isin(list(values)))


def read_extract(spark: SparkSession, path: str, has_header: bool = False,
                 columns: Sequence[str] = EXTRACT_COLUMNS) -> DataFrame:
    """The attribute extract: all text, positional names, ``NULL`` and empty read as null.

    Its header names carry stray blanks, so a headered file also takes names by position.
    """
    return (
        spark.read.schema(text_schema(columns))
        .option("header", has_header).option("enforceSchema", True)
        .option("nullValue", "NULL").option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True).csv(path)
        .replace("", None)
    )


def read_optional_extract(spark: SparkSession, path: str, strict: bool = False,
                          **options) -> DataFrame | None:
    """The extract if it exists. Without it the panel's own columns remain, and that is logged."""
    try:
        return read_extract(spark, path, **options)
    except AnalysisException as error:
        if strict or error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no attribute extract at %s: continuing with panel columns only", path)
        return None


def read_id_list(spark: SparkSession, path: str, id_column: str = "asset_id") -> DataFrame:
    """One identifier per line; blanks are dropped."""
    lines = spark.read.text(path).select(F.trim("value").alias(id_column))
    return lines.where(F.col(id_column) != "").distinct()


def split_id_list(spark: SparkSession, text: str, id_column: str = "asset_id") -> DataFrame:
    """A comma-separated request as a frame of identifiers."""
    ids = sorted({part.strip() for part in text.split(",")} - {""})
    return spark.createDataFrame([(i,) for i in ids], f"{id_column} string")
