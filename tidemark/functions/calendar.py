"""Date attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Day as the integer yyyymmdd; NULL stays NULL. Plain arithmetic, no text in between."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of one calendar day. The fiscal year is the calendar year; no holidays are known."""
    weekday, month, quarter, year = F.dayofweek(day), F.month(day), F.quarter(day), F.year(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        quarter.alias("quarter"),
        year.alias("year"),
        weekday.isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        year.alias("fiscal_year"),
        quarter.alias("fiscal_quarter"),
        month.alias("fiscal_period"),
    ]
