"""Time conversions (all expressions; session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickweave.schemas import EPOCH_1980_OFFSET


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch1980(seconds) -> Column:
    """Feed-1 LastUpdateTime (seconds since 1980-01-01) -> timestamp_ntz (UTC)."""
    return F.timestamp_seconds(_c(seconds) + F.lit(EPOCH_1980_OFFSET)).cast("timestamp_ntz")


def to_epoch1980(ts) -> Column:
    """Inverse of :func:`from_epoch1980` (whole seconds)."""
    return F.unix_seconds(_c(ts).cast("timestamp")) - F.lit(EPOCH_1980_OFFSET)


def from_unix_seconds(seconds) -> Column:
    """Plain Unix seconds -> timestamp_ntz (UTC)."""
    return F.timestamp_seconds(_c(seconds)).cast("timestamp_ntz")


def unix_seconds(ts) -> Column:
    return F.unix_seconds(_c(ts).cast("timestamp"))


def truncate_minute(ts) -> Column:
    return F.date_trunc("minute", _c(ts)).cast("timestamp_ntz")


def clock_label(ts, fmt: str = "HH:mm", zone: str | None = None) -> Column:
    """Display label such as ``HH:mm`` or ``HH:mm:ss``; never a grouping key.

    Times are UTC; ``zone`` (e.g. the exchange's ``Asia/Kolkata``) shifts the
    label only, for display.
    """
    t = _c(ts)
    if zone:
        t = F.from_utc_timestamp(t.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.date_format(t, fmt)


def day_tag(ts) -> Column:
    """Folder tag ``yyyy_MM_dd`` taken from the row's own time."""
    return F.date_format(_c(ts), "yyyy_MM_dd")


def parse_request_time(text) -> Column:
    """Request bounds such as ``Aug 8 2024 091500`` -> timestamp_ntz."""
    return F.to_timestamp_ntz(_c(text), F.lit("MMM d yyyy HHmmss"))


def stamp_text(ts) -> Column:
    """Wall-clock stamp text ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def text_to_time(text) -> Column:
    """ISO-like text times (``2024-08-08 09:15:00``) back to timestamp_ntz; bad text -> NULL."""
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")
