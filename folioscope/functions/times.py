"""Dates and periods. "Now" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch(t: Column) -> Column:
    """Seconds or milliseconds since 1970 (over 1e12: milliseconds) as a timestamp without zone."""
    ms = F.when(t > 1e12, t.cast("double")).otherwise(t.cast("double") * 1000)
    return F.timestamp_millis(ms.cast("long")).cast("timestamp_ntz")


def parsed(text: Column) -> Column:
    """Epoch, date, date and time, or ISO text as a timestamp; null if none of them."""
    number = F.when(text.rlike(r"^\d{9,}(\.\d+)?$"), from_epoch(F.expr("0D") + text.try_cast("double")))
    forms = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd"]
    return F.coalesce(number, *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in forms])


def to_day(text: Column) -> Column:
    """A date with -, /, . or nothing between its parts; null otherwise."""
    s = F.substring(F.trim(text), 1, 10)
    return F.coalesce(*[F.try_to_date(F.when(s.rlike(p), F.regexp_extract(s, p, 0)), f) for p, f in ((r"^\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"), (r"^\d{4}\.\d{1,2}\.\d{1,2}", "yyyy.M.d"), (r"^\d{8}$", "yyyyMMdd"))])


def day_label(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd")


def month_label(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM")


def week_label(t: Column) -> Column:
    """ISO week, such as 2025-W01 (the year is the week's)."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), t).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(t).cast("string"), 2, "0"))


def sunday_week_label(t: Column) -> Column:
    """The ISO week of the next day, so weeks begin on Sunday."""
    return week_label(F.date_add(F.to_date(t), 1))


def month_day_tab(d: Column) -> Column:
    """3.7 for March 7."""
    return F.concat(F.month(d).cast("string"), F.lit("."), F.dayofmonth(d).cast("string"))


def period(t: Column, unit: str) -> Column:
    return {"day": day_label, "week": week_label, "month": month_label}[unit](t)


def crosses(start: Column, end: Column, unit: str) -> Column:
    return period(start, unit) != period(end, unit)


def whole_seconds(t: Column) -> Column:
    return F.date_trunc("second", t).cast("timestamp_ntz")


def least_year(now: Column, years: int) -> Column:
    return F.year(now) - years + 1
