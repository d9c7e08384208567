"""Time conversions.  All results are ``timestamp_ntz`` (wall-clock, UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import TIMESTAMP_FORMAT

# Fixed value: the run label format (two-digit year, month, day, hour, minute).
RUN_STAMP_FORMAT = "yyMMdd_HHmm"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_epoch(text: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Fixed-format text to epoch seconds (UTC); unparsable text gives null."""
    return F.unix_timestamp(F.try_to_timestamp(_c(text), F.lit(fmt)))


def parse_ts(text: str | Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Fixed-format text to ``timestamp_ntz``; unparsable text gives null."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def from_epoch(seconds: str | Column) -> Column:
    """Epoch seconds to ``timestamp_ntz``."""
    return F.timestamp_seconds(_c(seconds)).cast("timestamp_ntz")


def add_hours(ts: str | Column, hours: int | Column) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _c(ts) + F.make_dt_interval(F.lit(0), h)


def hour_floor(ts: str | Column) -> Column:
    """Start of the hour; ``date_trunc`` returns ``timestamp``, cast back to NTZ."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def day_floor(ts: str | Column) -> Column:
    return F.date_trunc("day", _c(ts)).cast("timestamp_ntz")


def epoch_hours(ts: str | Column) -> Column:
    """Whole hours since the epoch (an integer time axis for exact sums)."""
    return F.floor(F.unix_seconds(_c(ts).cast("timestamp")) / 3600).cast("bigint")


def run_stamp(ts: str | Column) -> Column:
    """Run label in ``RUN_STAMP_FORMAT``."""
    return F.date_format(_c(ts), RUN_STAMP_FORMAT)
