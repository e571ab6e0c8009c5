"""Date and time functions. Image times are local wall-clock times: ``timestamp_ntz``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdspark.defaults import DATETIME_FORMAT, DATETIME_FORMATS, DEFAULT_TIMEZONE


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a wall-clock time, independent of the session time zone."""
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return since.cast("interval second").cast("decimal(20,6)").cast("double")


def parse_datetime(text: Column, formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """The first format that parses; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def split_date_time(columns: Sequence[str]) -> tuple[Column, Column]:
    """Date and time text of an image row, from the first source the table has.

    Precedence: ``timestamp``, then ``date`` and ``time``, then ``datetime``, then
    ``datetime_file_creation``. Which source applies depends on the columns, not on the row.
    """
    if "timestamp" not in columns and {"date", "time"} <= set(columns):
        parts = F.col("date"), F.col("time")
    else:
        source = next((c for c in ("timestamp", "datetime", "datetime_file_creation") if c in columns), None)
        if source is None:
            return F.lit(""), F.lit("")
        ts = parse_datetime(F.col(source).cast("string"))
        parts = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    known = (F.coalesce(parts[0], F.lit("")) != "") & (F.coalesce(parts[1], F.lit("")) != "")
    return tuple(F.when(known, p).otherwise(F.lit("")) for p in parts)


def utc_to_zone(ts: Column, zone: str = DEFAULT_TIMEZONE) -> Column:
    """Local wall-clock time of a UTC time."""
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def file_time_local(modification_time: Column, zone: str = DEFAULT_TIMEZONE) -> Column:
    """Local file time as text; an empty zone keeps UTC."""
    utc = F.to_utc_timestamp(modification_time, F.current_timezone())
    return F.date_format(F.from_utc_timestamp(utc, zone) if zone else utc, DATETIME_FORMAT)


def seconds_between(start: Column, end: Column) -> Column:
    """Signed difference in seconds."""
    return epoch_seconds(end) - epoch_seconds(start)


def shift_seconds(ts: Column, seconds: Column) -> Column:
    """Move a wall-clock time by a signed number of seconds."""
    return ts.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
