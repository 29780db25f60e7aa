"""Identifier and label clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that stand for a missing value once a null has become text.
NULL_WORDS = ("", "nan", "NaN", "NaT", "None", "<NA>")


def clean_id(raw: Column) -> Column:
    """Trim an identifier; null-like spellings become null so they can never form a group."""
    text = F.trim(raw.cast("string"))
    return F.when(~text.isin(*NULL_WORDS), text)


def bare_code(raw: Column) -> Column:
    """``01`` and ``1`` are one code: drop leading zeros of all-digit codes, keep the rest."""
    text = F.trim(raw.cast("string"))
    return F.when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=[0-9])", "")).otherwise(text)


def is_on_system(flag: Column, prefix: bool = False) -> Column:
    text = F.upper(F.trim(flag))
    return text.startswith("ON") if prefix else text == "ON"


def file_safe(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9_-]", "_")


def share_bucket(key: Column, seed: int, buckets: int = 1000) -> Column:
    """A stable bucket 0..buckets-1 from md5, the same on every engine and partitioning."""
    digest = F.md5(F.concat(key, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets
