"""Time formats. The instant is always passed in so that results can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(at: Column) -> Column:
    """``2024-01-01T00:00:07.179575Z``, whatever the session's time zone."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def from_utc_text(wall_clock: Column) -> Column:
    """The instant that a zoneless timestamp, or its text, means in UTC."""
    return F.from_utc_timestamp(wall_clock.cast("timestamp"), F.current_timezone())


def epoch_seconds(at: Column) -> Column:
    return F.unix_timestamp(at)
