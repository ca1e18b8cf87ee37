"""Scalar enrichment expressions for Silver and the date dimension.

All are built-in column expressions, so they compile into the same
whole-stage-codegen span as the scan and the filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (  # noqa: E402  (fixed values, stated in tremor.fixed)
    DEPTH_CLASSES,
    DEPTH_TOP_CLASS,
    HEMISPHERE_EW,
    HEMISPHERE_NS,
    MAGNITUDE_CLASSES,
    MAGNITUDE_TOP_CLASS,
    REGION_PATTERN,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def magnitude_category(mag: Column | str = "magnitude") -> Column:
    m = _c(mag)
    out = None
    for bound, label in MAGNITUDE_CLASSES:
        out = F.when(m < bound, label) if out is None else out.when(m < bound, label)
    return out.otherwise(MAGNITUDE_TOP_CLASS)


def depth_category(depth: Column | str = "depth_km") -> Column:
    d = _c(depth)
    out = None
    for bound, label in DEPTH_CLASSES:
        out = F.when(d <= bound, label) if out is None else out.when(d <= bound, label)
    return out.otherwise(DEPTH_TOP_CLASS)


def hemisphere_ns(lat: Column | str = "latitude") -> Column:
    return F.when(_c(lat) >= 0, HEMISPHERE_NS[0]).otherwise(HEMISPHERE_NS[1])


def hemisphere_ew(lon: Column | str = "longitude") -> Column:
    return F.when(_c(lon) >= 0, HEMISPHERE_EW[0]).otherwise(HEMISPHERE_EW[1])


def calendar_parts(ts: Column | str = "event_timestamp_utc") -> dict[str, Column]:
    t = _c(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "day_of_week": F.dayofweek(t),  # Sunday = 1 ... Saturday = 7
    }


def region_detail(place: Column | str = "place") -> Column:
    """Text after the first comma, trimmed; '' without a comma, null for null."""
    return F.trim(F.regexp_extract(_c(place), REGION_PATTERN, 1))


def country(detail: Column | str, place: Column | str = "place") -> Column:
    """Region detail when non-empty, else the trimmed place."""
    d = _c(detail)
    return F.when(d != "", d).otherwise(F.trim(_c(place)))


def day_attributes(day: Column | str) -> dict[str, Column]:
    """Date-dimension attributes of a DATE column (English names)."""
    d = _c(day)
    dow = F.dayofweek(d)
    return {
        "Year": F.year(d),
        "Quarter": F.quarter(d),
        "Month": F.month(d),
        "MonthName": F.date_format(d, "MMMM"),
        "DayOfMonth": F.dayofmonth(d),
        "DayOfWeek": dow,
        "DayName": F.date_format(d, "EEEE"),
        "IsWeekend": dow.isin(1, 7).cast("int"),
    }
