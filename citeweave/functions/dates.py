"""Publication dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whole days a nanosecond count in 64 bits can hold.
FIRST_DAY = dt.date(1677, 9, 22)
LAST_DAY = dt.date(2262, 4, 11)
NANOS_PER_DAY = 86_400_000_000_000


def written_as_day(text: Column) -> Column:
    """Whether the text has the form year-month-day, month and day with one or two digits."""
    return text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")


def day_of(text: Column) -> Column:
    """The date of such a text, null if there is no such day."""
    return text.try_cast("date")


def in_range(day: Column) -> Column:
    return day.between(F.lit(FIRST_DAY), F.lit(LAST_DAY))


def year_of(day: Column) -> Column:
    return F.year(day).cast("bigint")


def epoch_nanos(day: Column) -> Column:
    """Nanoseconds from 1970-01-01 to the start of the day, free of any time zone."""
    return F.datediff(day, F.lit(dt.date(1970, 1, 1))).cast("bigint") * F.lit(NANOS_PER_DAY)
