"""The event fact table.

Two formulations with identical results:

* ``fact_events`` (default): every foreign key is a deterministic hash of
  the row's own natural key, so the fact is a projection of Silver with no
  join at all. The inner-join row loss of the star lookup is reproduced by
  a filter: a row whose location or event-type key contains a null never
  finds its dimension row (``null = null`` is not true). DateKey always
  hits the calendar (it spans first..last event day + 30) and every
  non-null magnitude has one of seven categories, so those lookups lose
  nothing. At scale this avoids shuffling a 100 TB fact against
  dimensions that themselves grow with the data.
* ``fact_events_joined``: the literal star lookup (inner equi-joins on the
  natural keys). Kept as the parity formulation and used by tests to prove
  the two agree. Only the eight-row magnitude dimension is broadcast by
  hint; the other dimensions' join strategy is left to AQE, which measures
  the built side at run time before it converts a join to a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import casts, keys

CLOCK = "DWLoadTimestampUTC"


def _measures(silver: DataFrame) -> list[Column]:
    return [silver[source].alias(name) for source, name in fixed.FACT_MEASURES]


def _clock(silver: DataFrame, with_clock: bool) -> list[Column]:
    if not with_clock:
        return []
    return [
        silver["silver_processing_timestamp_utc"].alias("SilverProcessingTimestampUTC"),
        casts.now_utc().alias(CLOCK),
    ]


def star_lookup_matches(null_safe: bool = False) -> Column:
    """Rows an inner natural-key lookup keeps (all of them when null-safe)."""
    if null_safe:
        return F.lit(True)
    return (
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("place").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("magType").isNotNull()
        & F.col("event_timestamp_utc").isNotNull()
    )


def fact_events(
    silver: DataFrame,
    null_safe: bool = False,
    with_clock: bool = True,
    drop_duplicate_events: bool = True,
) -> DataFrame:
    """Silver -> fact with hash-derived foreign keys (no joins).

    ``drop_duplicate_events`` keeps the reference's safety net
    (``dropDuplicates(EventID)``). When Silver comes straight out of the
    dedup window in the same plan the exchange is reused (the data is
    already hash-partitioned by event id), so the net costs no shuffle.
    """
    rows = silver.filter(star_lookup_matches(null_safe))
    out = rows.select(
        F.col("event_id").alias("EventID"),
        casts.date_key("event_timestamp_utc").alias("DateKey"),
        keys.location_key().alias("LocationKey"),
        keys.magnitude_key("magnitude_category").alias("MagnitudeKey"),
        keys.event_type_key().alias("EventTypeKey"),
        *_measures(rows),
        *_clock(rows, with_clock),
    )
    return out.dropDuplicates(["EventID"]) if drop_duplicate_events else out


def fact_events_joined(silver: DataFrame, dims: dict[str, DataFrame], null_safe: bool = False, with_clock: bool = True) -> DataFrame:
    """The literal star lookup: four inner equi-joins on natural keys."""
    s = silver.withColumn("DateKey", casts.date_key("event_timestamp_utc"))
    loc = dims["dim_location"].select("latitude", "longitude", "place", "LocationKey")
    etype = dims["dim_event_type"]
    mag = F.broadcast(dims["dim_magnitude"].select("MagnitudeCategory", "MagnitudeKey"))
    date = dims["dim_date"].select("DateKey")
    if null_safe:
        loc_cond = [keys.coordinate(s[c]).eqNullSafe(loc[c]) for c in ("latitude", "longitude")] + [s["place"].eqNullSafe(loc["place"])]
        type_cond = [s[c].eqNullSafe(etype[c]) for c in ("event_type", "magType")]
    else:
        loc_cond = [keys.coordinate(s[c]) == loc[c] for c in ("latitude", "longitude")] + [s["place"] == loc["place"]]
        type_cond = [s[c] == etype[c] for c in ("event_type", "magType")]
    joined = (
        s.join(date, "DateKey", "inner")
        .join(loc, loc_cond, "inner")
        .join(mag, s["magnitude_category"] == mag["MagnitudeCategory"], "inner")
        .join(etype, type_cond, "inner")
    )
    out = joined.select(
        s["event_id"].alias("EventID"),
        F.col("DateKey"),
        F.col("LocationKey"),
        F.col("MagnitudeKey"),
        F.col("EventTypeKey"),
        *_measures(s),
        *_clock(s, with_clock),
    )
    return out.dropDuplicates(["EventID"])
