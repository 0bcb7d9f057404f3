"""Dates in dirty cells. Session time zone is UTC; nothing here reads a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1899-12-30"


def civil(text: Column) -> Column:
    """``YYYY-MM-DD`` alone."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def flexible_date(text: Column) -> Column:
    """Serial number (fraction dropped), civil date, or the UTC date of an ISO time; else null, never a guess."""
    s = F.trim(text)
    serial = F.when(s.rlike(r"^\d+(\.\d+)?$"), F.date_add(F.lit(EPOCH).cast("date"), F.floor(s.try_cast("double")).cast("int")))
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.to_date(s.try_cast("timestamp")))
    return F.coalesce(serial, civil(s), iso)


def as_text(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def moment(text: Column) -> Column:
    """A time, from ISO text or M/D/YYYY H:mm:ss; else null."""
    s = F.trim(text)
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2})?.*)?$"), s.try_cast("timestamp"))
    us = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$"), F.try_to_timestamp(s, F.lit("M/d/yyyy H:mm:ss")))
    return F.coalesce(iso, us)


def newer(a: Column, b: Column) -> Column:
    return F.greatest(a, b)  # skips nulls


def touch_source(native: Column, manual: Column) -> Column:
    """Where the newer date came from; a tie is native."""
    last = newer(native, manual)
    return F.when(last.isNull(), "none").when(last.eqNullSafe(native), "native").otherwise("manual")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def run_day(now: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(now, zone))


def span_days(first: Column, last: Column) -> Column:
    return F.greatest(F.lit(0), F.datediff(last, first)) + F.when(first.isNull() | last.isNull(), F.lit(None).cast("int")).otherwise(0)
