"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer key yyyymmdd of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def hour_key(moment: Column) -> Column:
    """Integer key yyyymmddhh of a timestamp."""
    return date_key(moment).cast("bigint") * 100 + F.hour(moment)


def fiscal_date(day: Column, start_month: int) -> Column:
    """Shift a date so that its calendar year and quarter are the fiscal ones.

    The fiscal year is named after the calendar year in which it ends.
    """
    return F.add_months(day, (13 - start_month) % 12)


def calendar_columns(day: Column, fiscal_start_month: int = 7) -> dict[str, Column]:
    """The attributes of a date dimension, in table order."""
    fiscal = fiscal_date(day, fiscal_start_month)
    return {
        "DateKey": date_key(day),
        "DateAltKey": day,
        "DayOfMonth": F.dayofmonth(day),
        "DayOfWeek": F.dayofweek(day),
        "DayName": F.date_format(day, "EEEE"),
        "MonthOfYear": F.month(day),
        "MonthName": F.date_format(day, "MMMM"),
        "CalendarQuarter": F.quarter(day),
        "CalendarYear": F.year(day),
        "FiscalQuarter": F.quarter(fiscal),
        "FiscalYear": F.year(fiscal),
    }
