"""Bronze -> Silver: type, validate, keep the latest revision, enrich.

``silver(flat)`` is a pure DataFrame -> DataFrame plan; ``run_silver`` adds
I/O, metrics and the empty-input gate. The plan has exactly one shuffle
(the dedup exchange on ``event_id``); everything else is a projection or
filter fused into codegen with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import casts, features
from ..operators import dedup, quality

BATCH_TS = "batch_ts"


def select_typed(flat: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Casts plus rename/reorder to the 20 Silver columns (``batch_ts`` kept if present, as are the columns in ``keep``)."""
    cols: dict[str, Column] = {
        "event_id": F.col("id"),
        "event_timestamp_utc": casts.epoch_ms_to_ts("time"),
        "updated_timestamp_utc": casts.epoch_ms_to_ts("updated"),
        "magnitude": casts.to_double("mag"),
        "depth_km": casts.to_double("depth"),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "place": F.col("place"),
        "event_type": F.col("type"),
        "magType": F.col("magType"),
        "tsunami_warning": casts.flag_to_bool("tsunami"),
        "significance": casts.to_int("sig"),
        "felt_reports": casts.to_int("felt"),
        "nst_stations": casts.to_int("nst"),
        "rms_travel_time": casts.to_double("rms"),
        "gap_azimuthal": casts.to_double("gap"),
        "alert": F.col("alert"),
        "status": F.col("status"),
        "url": F.col("url"),
        "title": F.col("title"),
    }
    out = [c.alias(n) for n, c in cols.items()]
    if BATCH_TS in flat.columns:
        out.append(F.col(BATCH_TS))
    return flat.select(*out, *keep)


TIEBREAK_COLUMNS = [c for c in schemas.SILVER_SELECTED_COLUMNS if c not in ("event_id", "updated_timestamp_utc")]


def revision_order(columns: list[str]) -> list[Column]:
    """Newest ``updated`` first (null last), then event time, then newest batch, then the row content.

    Rows of one (id, updated, event time) that differ were re-sent with changed content: the newest batch wins.
    Exact re-fetches therefore never change the survivor, so an append-only history need not store them.

    Ordering by the content columns themselves (rather than by a hash of
    them) is a total order that costs nothing per row: the sort compares a
    later key only when all earlier keys tie, which is rare.
    """
    order = [F.col("updated_timestamp_utc").desc_nulls_last(), F.col("event_timestamp_utc").asc_nulls_last()]
    if BATCH_TS in columns:
        order.append(F.col(BATCH_TS).desc_nulls_last())
    order.extend(F.col(c).asc_nulls_last() for c in TIEBREAK_COLUMNS if c != "event_timestamp_utc")
    return order


def latest(valid_rows: DataFrame) -> DataFrame:
    """One row per ``event_id``: the latest valid revision (with its ``batch_ts`` if the input has one)."""
    return dedup.latest_per_key(valid_rows, ["event_id"], revision_order(valid_rows.columns))


def enrich(df: DataFrame, with_clock: bool = True) -> DataFrame:
    """Magnitude/depth classes, hemispheres, calendar parts, place features."""
    cols = {
        "magnitude_category": features.magnitude_category("magnitude"),
        "depth_category": features.depth_category("depth_km"),
        "hemisphere_ns": features.hemisphere_ns("latitude"),
        "hemisphere_ew": features.hemisphere_ew("longitude"),
        **features.calendar_parts("event_timestamp_utc"),
        "extracted_region_detail": features.region_detail("place"),
    }
    out = df.withColumns(cols)
    out = out.withColumn("extracted_country", features.country("extracted_region_detail", "place"))
    if with_clock:
        out = out.withColumn("silver_processing_timestamp_utc", casts.now_utc())
    return out


def silver(flat: DataFrame, with_clock: bool = True) -> DataFrame:
    """Flattened Bronze -> Silver rows (validate first, then dedup, then enrich)."""
    return enrich(latest(quality.valid(select_typed(flat))), with_clock=with_clock)
