"""Casts that stay null-safe under ANSI mode (never switched off).

``try_cast`` turns overflow and bad input into null instead of failing the
job. Event times are UTC wall-clock ``TIMESTAMP_NTZ`` values computed from
epoch milliseconds by integer arithmetic against the NTZ epoch: no value
takes a floating-point detour, and neither the value nor any calendar part
or DateKey derived from it depends on the reader's session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms_to_ts(col: Column | str) -> Column:
    """Epoch milliseconds (BIGINT) -> UTC wall-clock TIMESTAMP_NTZ, ms precision kept."""
    return F.timestamp_add("MILLISECOND", F.col(col) if isinstance(col, str) else col, epoch())


def ts_to_epoch_ms(col: Column | str) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> epoch milliseconds (sub-ms part truncated)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", epoch(), c)


def event_time(col: Column | str) -> Column:
    """UTC wall clock as an instant (TIMESTAMP), for APIs that need one (watermarks)."""
    return F.timestamp_millis(ts_to_epoch_ms(col))


def now_utc() -> Column:
    """The query's start time as UTC wall clock (TIMESTAMP_NTZ)."""
    return epoch_ms_to_ts(F.unix_millis(F.current_timestamp()))


def to_double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def to_int(col: Column | str) -> Column:
    """BIGINT -> INT; out-of-range values become null instead of raising."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("int")


def flag_to_bool(col: Column | str) -> Column:
    """``flag == 1``; null stays null."""
    return (F.col(col) if isinstance(col, str) else col) == 1


def date_key(col: Column | str) -> Column:
    """Calendar day of a timestamp or date as INT yyyyMMdd (session zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
