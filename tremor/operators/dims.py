"""Star-schema dimensions with deterministic surrogate keys.

* ``dim_date``: a calendar from the first event day to the last + 30 days,
  generated inside the plan (one-row span aggregate -> ``sequence`` ->
  ``explode``); nothing is looped over on the driver.
* ``dim_location`` / ``dim_event_type``: distinct natural keys (partial +
  final hash aggregate, so a hot location is combined map-side).
* ``dim_magnitude``: eight fixed reference rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..functions import casts, features, keys

MAGNITUDE_ROWS = fixed.MAGNITUDE_ROWS
CALENDAR_BUFFER_DAYS = fixed.CALENDAR_BUFFER_DAYS


def date_span(silver: DataFrame, ts: str = "event_timestamp_utc") -> DataFrame:
    """One row: first and last event day (session zone, UTC)."""
    return silver.agg(F.to_date(F.min(ts)).alias("min_date"), F.to_date(F.max(ts)).alias("max_date"))


def dim_date(silver: DataFrame, ts: str = "event_timestamp_utc") -> DataFrame:
    days = date_span(silver, ts).select(
        F.explode(F.sequence("min_date", F.date_add("max_date", CALENDAR_BUFFER_DAYS))).alias("FullDate")
    )
    attrs = features.day_attributes("FullDate")
    return days.select(
        casts.date_key("FullDate").alias("DateKey"),
        F.col("FullDate"),
        *[c.alias(n) for n, c in attrs.items()],
    )


def dim_location(silver: DataFrame) -> DataFrame:
    # distinct on the same normal form of the coordinates that the key is made of
    normal = silver.withColumns({c: keys.coordinate(c) for c in ("latitude", "longitude")})
    normal = normal.withColumns({"hemisphere_ns": features.hemisphere_ns(), "hemisphere_ew": features.hemisphere_ew()})
    places = normal.select(*schemas.LOCATION_COLUMNS)
    return places.distinct().withColumn("LocationKey", keys.location_key())


def dim_magnitude(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(MAGNITUDE_ROWS, schemas.DIM_MAGNITUDE)
    return rows.withColumn("MagnitudeKey", keys.magnitude_key("MagnitudeCategory"))


def dim_event_type(silver: DataFrame) -> DataFrame:
    return silver.select(*schemas.EVENT_TYPE_COLUMNS).distinct().withColumn("EventTypeKey", keys.event_type_key())


def all_dims(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_date": dim_date(silver),
        "dim_location": dim_location(silver),
        "dim_magnitude": dim_magnitude(silver.sparkSession),
        "dim_event_type": dim_event_type(silver),
    }
