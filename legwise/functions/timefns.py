"""Date and time expressions.

Times are stored as ``timestamp_ntz`` holding the UTC wall clock; the session
time zone must be UTC (``legwise.session.ensure_session``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Layouts that are tried, in order, after ISO text; months come before days.
TIME_FORMATS = ("M/d/yyyy h:mm[:ss][.SSSSSS][.SSS] a", "M/d/yyyy H:mm[:ss][.SSSSSS][.SSS]", "M/d/yyyy",
                "M-d-yyyy H:mm[:ss]", "yyyy/M/d H:mm[:ss][.SSSSSS][.SSS]", "yyyy/M/d", "yyyyMMdd HHmmss",
                "yyyyMMdd'T'HHmmss", "MMM d, yyyy h:mm[:ss] a", "MMM d, yyyy H:mm[:ss]", "d MMM yyyy H:mm[:ss]")
_TIME_ALONE = r"^\s*T?\d{1,2}:"


def _dated(text: Column) -> Column:
    """Null for text that names a time but no date, which Spark would put on
    the day of the run."""
    return F.when(~text.rlike(_TIME_ALONE), text)


def parse_utc(text, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Text -> UTC ``timestamp_ntz``; an offset in the text is converted to
    UTC, text without one is taken as UTC; text in none of the layouts gives null."""
    t = _c(text)
    iso = F.try_to_timestamp(_dated(t))
    word = F.btrim(F.upper(t))
    others = [F.try_to_timestamp(F.initcap(F.lower(word)) if "MMM" in f else word, F.lit(f)) for f in formats]
    # the other layouts are looked at only where a mark shows one
    return F.coalesce(iso, F.when(t.rlike(r"[/,A-Za-z]|^\s*\d{8}|^\s*\d{1,2}-"), F.coalesce(*others))).cast("timestamp_ntz")


def floor_ms(ts) -> Column:
    """D3: floor to the millisecond (``datetime2(3)``)."""
    return F.date_trunc("MILLISECOND", _c(ts)).cast("timestamp_ntz")


def file_trip_date(text) -> Column:
    """The trip date is the date of the file, parsed leniently."""
    return F.to_date(F.try_to_timestamp(_dated(_c(text))))


def leg_minutes(start, end) -> Column:
    """``DATEDIFF(SECOND, start, end) / 60.0``; counts second boundaries,
    null unless both are present and end >= start."""
    start, end = _c(start), _c(end)
    secs = F.timestamp_diff("SECOND", F.date_trunc("SECOND", start), F.date_trunc("SECOND", end))
    return F.when(start.isNotNull() & end.isNotNull() & (end >= start),
                  secs.cast("double") / F.lit(60.0))


def window_bounds(as_of: str | dt.date | None, days_back: int) -> tuple[Column, Column]:
    """Half-open window ``[as_of - days_back, as_of)``; as_of defaults to today."""
    end = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.date_sub(end, int(days_back)), end


def in_window(date_col, as_of, days_back: int) -> Column:
    start, end = window_bounds(as_of, days_back)
    d = _c(date_col)
    return (d >= start) & (d < end)


def interval_seconds(delta) -> Column:
    """A day-time interval as (fractional) seconds."""
    d = F.col(delta) if isinstance(delta, str) else delta
    return (F.extract(F.lit("DAY"), d).cast("double") * 86400.0
            + F.extract(F.lit("HOUR"), d).cast("double") * 3600.0
            + F.extract(F.lit("MINUTE"), d).cast("double") * 60.0
            + F.extract(F.lit("SECOND"), d).cast("double"))
