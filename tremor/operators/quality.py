"""Data-quality gate: range and presence rules, and per-rule reject counts.

Rules are AND-ed into one filter that runs *before* latest-revision
deduplication, so an invalid newest revision lets an older valid one
survive (this order changes results and is kept on purpose).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


def rules() -> dict[str, Column]:
    """Rule name -> predicate over Silver-named columns. Null never passes.

    NaN sorts above every number, so a NaN magnitude or depth fails too.
    """
    mag, lat, lon, depth = (F.col(c) for c in ("magnitude", "latitude", "longitude", "depth_km"))
    return {
        "magnitude_range": mag.isNotNull() & mag.between(*fixed.MAGNITUDE_RANGE),
        "latitude_range": lat.isNotNull() & lat.between(*fixed.LATITUDE_RANGE),
        "longitude_range": lon.isNotNull() & lon.between(*fixed.LONGITUDE_RANGE),
        "depth_range": depth.isNotNull() & (depth >= fixed.DEPTH_RANGE[0]) & (depth < fixed.DEPTH_RANGE[1]),
        "time_and_id_present": F.col("event_timestamp_utc").isNotNull() & F.col("event_id").isNotNull(),
    }


def is_valid(by=rules) -> Column:
    out = None
    for pred in by().values():
        out = pred if out is None else out & pred
    return out


def valid(df: DataFrame, by=rules) -> DataFrame:
    """Rows that pass all rules (``by``: other rules than the published ones)."""
    return df.filter(is_valid(by))


def reject_count_columns(by=rules) -> list[Column]:
    """One-pass aggregate: input rows, rows failing each rule, kept rows."""
    cols = [F.count(F.lit(1)).alias("input_rows")]
    for name, pred in by().items():
        cols.append(F.count_if(~F.coalesce(pred, F.lit(False))).alias(f"rejected_{name}"))
    cols.append(F.count_if(~F.coalesce(is_valid(by), F.lit(False))).alias("rejected_rows"))
    cols.append(F.count_if(F.coalesce(is_valid(by), F.lit(False))).alias("valid_rows"))
    return cols


def reject_counts(df: DataFrame) -> DataFrame:
    """Reject accounting as a global aggregate (partial per task, one final row)."""
    return df.agg(*reject_count_columns())
