"""Calendar arithmetic shared by the star schema, the marts and the adjustments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_between(start: Column, end: Column) -> Column:
    """Both ends counted."""
    return F.datediff(end, start) + 1


def each_month(start: Column, end: Column) -> Column:
    """First days of the months touched by the range, as an array."""
    return F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))


def days_in_month(month: Column, start: Column, end: Column) -> Column:
    """Days of ``month`` that fall inside the range."""
    return days_between(F.greatest(start, month), F.least(end, F.last_day(month)))


def add_months_sticky(day: Column, months: Column | int) -> Column:
    """Month arithmetic that keeps a month end a month end."""
    shifted = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(shifted)).otherwise(shifted)
