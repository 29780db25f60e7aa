"""Inspection dates in mixed encodings, and the ages and horizons derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearline.config import DAYS_PER_YEAR
from wearline.functions.numbers import clip


def inspection_date(raw: Column) -> Column:
    """Parse packed ``MMDDYYYY`` digits, ISO or US dates and timestamps; failures become null.

    All-digit text is always the packed form, so ``2024`` is null and never the year 2024. Every
    form is rewritten as ISO and cast: a failed cast is a null, not an exception per row.
    """
    shown = F.trim(raw.cast("string"))
    text = F.when(shown.endswith(".0"), F.left(shown, F.length(shown) - 2)).otherwise(shown)
    digits = F.lpad(text, 8, "0")
    iso = (
        F.when(text.rlike("^[0-9]{1,8}$"), F.concat_ws(
            "-", F.substring(digits, 5, 4), F.substring(digits, 1, 2), F.substring(digits, 3, 2)))
        .when(F.contains(text, F.lit("/")),
              F.regexp_replace(text, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", "$3-$1-$2"))
        .otherwise(text)
    )
    return iso.try_cast("date")


def day_number(date: Column) -> Column:
    """Days since 1970-01-01, the integer axis that range frames run on."""
    return F.unix_date(date)


def years_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start) / F.lit(DAYS_PER_YEAR)


def whole_days(years: float) -> int:
    """The last whole day that is still within ``years``."""
    return int(years * DAYS_PER_YEAR)


def age_on(date: Column, year_built: Column) -> Column:
    """Age in calendar years at ``date``, held within 0..130. The built year is not screened."""
    return clip(F.year(date) - year_built.cast("double"), 0.0, 130.0)


def believable_built_year(year_built: Column, reference_year: Column) -> Column:
    """Null unless 1900 <= year_built <= reference year."""
    return F.when((year_built >= 1900) & (year_built <= reference_year), year_built)
