"""Calendar keys, age bands and label defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that must appear in the results exactly like this.
NO_PROMOTION = "无"
UNKNOWN_AGE = "未知"
AGE_BANDS = ((20, "<20"), (30, "20-30"), (40, "30-40"), (50, "40-50"))
OLDEST_BAND = "50+"


def iso_weekday(day: Column) -> Column:
    """1 for Monday up to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_month_label(year: Column, month: Column) -> Column:
    """``yyyy-MM`` from two numbers."""
    return F.concat(
        F.lpad(year.cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"),
    )


def promotion_or_default(promotion: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(promotion), F.lit("")), F.lit(NO_PROMOTION))


def age_band(age: Column) -> Column:
    band = F.when(age.isNull(), F.lit(UNKNOWN_AGE))
    for upper, label in AGE_BANDS:
        band = band.when(age < upper, F.lit(label))
    return band.otherwise(F.lit(OLDEST_BAND))
