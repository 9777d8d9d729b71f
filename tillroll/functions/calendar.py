"""Calendar scalar functions (F1–F10), all native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c) -> Column:
    """F5 truncate to day."""
    return F.to_date(_c(c))


def day_of_week(c) -> Column:
    """F3 Monday = 0 … Sunday = 6."""
    return F.weekday(_c(c))


def is_weekend(c) -> Column:
    """F3 weekend flag as 0/1 (Saturday, Sunday)."""
    return F.when(F.weekday(_c(c)).isin(5, 6), F.lit(1)).otherwise(F.lit(0))


def day_name(c) -> Column:
    """F4 English day name."""
    return F.date_format(_c(c), "EEEE")


def iso_week(c) -> Column:
    """F2 ISO-8601 week number."""
    return F.weekofyear(_c(c))


def date_parts(c) -> list[Column]:
    """F1–F4 as the enrichment columns of the line ledger."""
    d = _c(c)
    return [
        F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        iso_week(d).alias("week_of_year"), day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"), is_weekend(d).alias("is_weekend"),
    ]


def week_ending_sunday(c) -> Column:
    """A7 week key: the Sunday that closes the week (a Sunday maps to itself)."""
    return F.next_day(F.date_sub(F.to_date(_c(c)), 1), "SUN")


def week_start(week_end) -> Column:
    """F7 week start = week end − 6 days."""
    return F.date_sub(_c(week_end), 6)


def month_start(c) -> Column:
    """Monthly period key."""
    return F.trunc(F.to_date(_c(c)), "MM")


def month_end(c) -> Column:
    """A8 month-end key."""
    return F.last_day(_c(c))


def weeks_until_christmas(c, wrap: bool = True) -> Column:
    """F8 whole weeks until 25 December.  After the 25th: the next year's
    Christmas when ``wrap`` (serving form), else 0 (training form)."""
    d = F.to_date(_c(c))
    this_year = F.make_date(F.year(d), F.lit(12), F.lit(25))
    diff = F.datediff(this_year, d)
    if wrap:
        nxt = F.make_date(F.year(d) + 1, F.lit(12), F.lit(25))
        return F.when(diff < 0, F.floor(F.datediff(nxt, d) / 7)).otherwise(F.floor(diff / 7)).cast("int")
    return F.when(diff < 0, F.lit(0)).otherwise(F.floor(diff / 7)).cast("int")


def weeks_since_christmas(c) -> Column:
    """F9 whole weeks since 25 December of the previous year."""
    d = F.to_date(_c(c))
    prev = F.make_date(F.year(d) - 1, F.lit(12), F.lit(25))
    return F.floor(F.datediff(d, prev) / 7).cast("int")


def holiday_flags(week_end) -> list[Column]:
    """F10 Q4 flag, December flag (month/quarter taken from the week start)
    and proximity 1/(weeks until Christmas + 1)."""
    ws = week_start(week_end)
    return [
        F.when(F.quarter(ws) == 4, 1).otherwise(0).alias("q4_flag"),
        F.when(F.month(ws) == 12, 1).otherwise(0).alias("year_end_flag"),
        (F.lit(1.0) / (weeks_until_christmas(week_end) + 1)).alias("holiday_proximity_score"),
    ]


def day_diff(later, earlier) -> Column:
    """F6 whole days between two timestamps/dates (on calendar dates, D6)."""
    return F.datediff(F.to_date(_c(later)), F.to_date(_c(earlier)))
