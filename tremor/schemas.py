"""Declared schemas for every layer.

Bronze is never inferred: inference over nested directories finds nothing
without recursive lookup, and an all-empty ``features`` array infers the
elements as STRING, after which field access fails. Declaring the schema
also prunes the JSON parser to the fields we keep.
"""

from __future__ import annotations

from pyspark.sql import types as T

# GeoJSON ``properties`` fields of one feature, in the API's
# order, with the types the casts of the Silver job imply.
PROPERTY_FIELDS = [
    ("mag", T.DoubleType()),
    ("place", T.StringType()),
    ("time", T.LongType()),
    ("updated", T.LongType()),
    ("url", T.StringType()),
    ("felt", T.LongType()),
    ("cdi", T.DoubleType()),
    ("mmi", T.DoubleType()),
    ("alert", T.StringType()),
    ("status", T.StringType()),
    ("tsunami", T.LongType()),
    ("sig", T.LongType()),
    ("net", T.StringType()),
    ("code", T.StringType()),
    ("nst", T.LongType()),
    ("dmin", T.DoubleType()),
    ("rms", T.DoubleType()),
    ("gap", T.DoubleType()),
    ("magType", T.StringType()),
    ("type", T.StringType()),
    ("title", T.StringType()),
]

# Properties the Silver job does not carry; a Silver read leaves them out of
# the declared schema so the JSON parser skips them.
UNUSED_BY_SILVER = {"cdi", "mmi", "net", "code", "dmin"}

GEOMETRY = T.StructType(
    [
        T.StructField("type", T.StringType(), True),
        T.StructField("coordinates", T.ArrayType(T.DoubleType(), True), True),
    ]
)

def bronze_document(properties: list[tuple[str, T.DataType]] = PROPERTY_FIELDS) -> T.StructType:
    """Declared document schema with the given ``properties`` fields."""
    feature = T.StructType(
        [
            T.StructField("type", T.StringType(), True),
            T.StructField("id", T.StringType(), True),
            T.StructField("properties", T.StructType([T.StructField(n, t, True) for n, t in properties]), True),
            T.StructField("geometry", GEOMETRY, True),
        ]
    )
    return T.StructType(
        [
            T.StructField("type", T.StringType(), True),
            T.StructField(
                "metadata",
                T.StructType(
                    [
                        T.StructField("generated", T.LongType(), True),
                        T.StructField("status", T.LongType(), True),
                        T.StructField("count", T.LongType(), True),
                    ]
                ),
                True,
            ),
            T.StructField("features", T.ArrayType(feature, True), True),
        ]
    )


SILVER_DOCUMENT = bronze_document([(n, t) for n, t in PROPERTY_FIELDS if n not in UNUSED_BY_SILVER])

BRONZE_DOCUMENT = bronze_document(PROPERTY_FIELDS)

# Flattened Bronze: one row per feature, properties in API order, then the
# three coordinates (longitude, latitude, depth).
BRONZE_FLAT_COLUMNS = ["id"] + [n for n, _ in PROPERTY_FIELDS] + ["longitude", "latitude", "depth"]

# Silver columns in published order; ``year``/``month`` are the partitions.
SILVER_SELECTED_COLUMNS = [
    "event_id",
    "event_timestamp_utc",
    "updated_timestamp_utc",
    "magnitude",
    "depth_km",
    "latitude",
    "longitude",
    "place",
    "event_type",
    "magType",
    "tsunami_warning",
    "significance",
    "felt_reports",
    "nst_stations",
    "rms_travel_time",
    "gap_azimuthal",
    "alert",
    "status",
    "url",
    "title",
]

SILVER_FEATURE_COLUMNS = [
    "magnitude_category",
    "depth_category",
    "hemisphere_ns",
    "hemisphere_ew",
    "year",
    "month",
    "day",
    "hour",
    "day_of_week",
    "extracted_region_detail",
    "extracted_country",
]

SILVER_COLUMNS = SILVER_SELECTED_COLUMNS + SILVER_FEATURE_COLUMNS + ["silver_processing_timestamp_utc"]

DIM_DATE = T.StructType(
    [
        T.StructField("DateKey", T.IntegerType(), False),
        T.StructField("FullDate", T.DateType(), False),
        T.StructField("Year", T.IntegerType(), False),
        T.StructField("Quarter", T.IntegerType(), False),
        T.StructField("Month", T.IntegerType(), False),
        T.StructField("MonthName", T.StringType(), False),
        T.StructField("DayOfMonth", T.IntegerType(), False),
        T.StructField("DayOfWeek", T.IntegerType(), False),
        T.StructField("DayName", T.StringType(), False),
        T.StructField("IsWeekend", T.IntegerType(), False),
    ]
)

DIM_MAGNITUDE = T.StructType(
    [
        T.StructField("MagnitudeCategory", T.StringType(), False),
        T.StructField("MinMagnitude", T.DoubleType(), True),
        T.StructField("MaxMagnitude", T.DoubleType(), True),
        T.StructField("Description", T.StringType(), False),
    ]
)

LOCATION_COLUMNS = [
    "latitude",
    "longitude",
    "place",
    "extracted_country",
    "extracted_region_detail",
    "hemisphere_ns",
    "hemisphere_ew",
]

EVENT_TYPE_COLUMNS = ["event_type", "magType"]

# Columns whose value is the wall clock of the run; never compared.
CLOCK_COLUMNS = {"silver_processing_timestamp_utc", "SilverProcessingTimestampUTC", "DWLoadTimestampUTC"}
