"""Date and time expressions (DT-01 .. DT-08)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions.util import as_col


def parse_ts(c, fmt: str | None = None) -> Column:
    """DT-01: parse text to a timestamp; text that does not parse gives null."""
    c = as_col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def parse_date(c, fmt: str) -> Column:
    """DT-02: text in a fixed format to a date, invalid -> null.

    A two-digit year follows the POSIX / Python ``%y`` pivot (69-99 ->
    1969-1999, 00-68 -> 2000-2068); Spark alone would read 95 as 2095.
    """
    d = F.to_date(F.try_to_timestamp(as_col(c), F.lit(fmt)))
    if "yy" in fmt and "yyy" not in fmt:
        d = F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
    return d


def reformat_date(c, src_fmt: str, dst_fmt: str) -> Column:
    """DT-02: re-render date text (``'20240131'`` -> ``'01/31/24'``)."""
    return F.date_format(parse_date(c, src_fmt), dst_fmt)


def yyyymmdd_to_date(c) -> Column:
    """Integer or text ``yyyyMMdd`` business date to a DATE."""
    return parse_date(as_col(c).cast("string"), "yyyyMMdd")


def shift_date_text(c, days: int = 364, fmt: str = "MM/dd/yy") -> Column:
    """DT-03: add ``days`` to date text in ``fmt``; text that is not a date
    passes through unchanged."""
    c = as_col(c)
    shifted = F.date_format(F.date_add(parse_date(c, fmt), days), fmt)
    return F.coalesce(shifted, c)


def day_of(c) -> Column:
    """DT-04: truncate a timestamp to its date."""
    return F.to_date(as_col(c))


def business_date(ts, tz: str, start_hour: int = 4, source_tz: str = "UTC") -> Column:
    """DT-07: the business day of an event: local wall-clock time in ``tz``
    shifted back by the hour the business day starts (an event at 03:59
    belongs to the day before). ``ts`` is a wall-clock timestamp in
    ``source_tz``; the result does not depend on the session time zone."""
    local = F.convert_timezone(F.lit(source_tz), F.lit(tz), as_col(ts))
    return F.to_date(local - F.make_dt_interval(F.lit(0), F.lit(start_hour)))


def business_day_start(d, tz: str, start_hour: int = 4) -> Column:
    """DT-07: UTC instant at which business day ``d`` starts in ``tz``."""
    local = F.to_timestamp(as_col(d)) + F.make_dt_interval(F.lit(0), F.lit(start_hour))
    return F.to_utc_timestamp(local, tz)


def iso_with_offset(utc, tz: str) -> Column:
    """A UTC wall-clock timestamp as local time of ``tz`` with its offset
    (``2024-01-31T04:00:00.000-0500``)."""
    utc = as_col(utc)
    local = F.from_utc_timestamp(utc, tz)
    minutes = ((F.unix_timestamp(local) - F.unix_timestamp(utc)) / 60).cast("int")
    offset = F.format_string("%s%02d%02d", F.when(minutes < 0, "-").otherwise("+"), F.floor(F.abs(minutes) / 60).cast("int"),
                             F.abs(minutes) % 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"), offset)


def business_day_bounds(d, tz: str, start_hour: int = 4) -> tuple[Column, Column]:
    """DT-07: start of business day ``d`` and of the next one, as ISO text with
    offset. Days on which the clock changes have 23 or 25 hours."""
    return (iso_with_offset(business_day_start(d, tz, start_hour), tz),
            iso_with_offset(business_day_start(F.date_add(as_col(d), 1), tz, start_hour), tz))


def since(c, as_of, months: int = 0, days: int = 0) -> Column:
    """FLT-13: ``c >= as_of - months - days`` with ``as_of`` a parameter
    (never the wall clock, so results are reproducible)."""
    start = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_col(as_of)
    if months:
        start = F.add_months(start, -months)
    if days:
        start = F.date_sub(start, days)
    return F.to_date(as_col(c)) >= start
