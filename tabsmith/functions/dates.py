"""Date/time ``Column`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col


def components(c, missing: int = -1) -> dict[str, Column]:
    """Year, month, day and Monday=0 day of week; null -> ``missing``."""
    d = col(c)
    m = F.lit(missing)
    return {"Year": F.coalesce(F.year(d), m), "Month": F.coalesce(F.month(d), m),
            "Day": F.coalesce(F.dayofmonth(d), m), "DayOfWeek": F.coalesce(F.weekday(d), m)}


def elapsed_days(start, end) -> Column:
    """Whole days from start to end, floored (pandas ``Timedelta.days``).

    ``timestampdiff(DAY)`` truncates toward zero and ``unix_micros`` rejects
    timestamp_ntz, so the microsecond difference is floored instead.
    """
    us = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return F.floor(us / F.lit(86_400_000_000.0)).cast("bigint")


def weekend(c) -> Column:
    """1 on Saturday/Sunday, 0 otherwise (null included)."""
    return F.coalesce((F.weekday(col(c)) >= 5).cast("int"), F.lit(0))


def known(c) -> Column:
    """1 when the value is present."""
    return col(c).isNotNull().cast("int")


def parse_timestamp_lenient(c) -> Column:
    """Unparsable text becomes null (``try_cast``; plain cast raises under ANSI)."""
    return col(c).try_cast("timestamp_ntz")


def parse_timestamp_strict(c) -> Column:
    """Unparsable text raises (ANSI cast)."""
    return col(c).cast("timestamp_ntz")


def parse_number_lenient(c) -> Column:
    """Unparsable text becomes null."""
    return col(c).try_cast("double")
