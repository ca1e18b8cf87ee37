"""Roll-ups over the star: by region, magnitude class, month and weekday.

Each roll-up first aggregates the fact by the dimension key it needs
(partial aggregation runs map-side, so the exchange carries one row per key
per task instead of fact rows, and a hot key is combined before the
shuffle). Only that small per-key result meets the dimension, and the
final grouping re-combines the partial sums. Whether a dimension is
broadcast is left to AQE, which goes by measured bytes.

Averages do not depend on how rows are spread over tasks: each magnitude and
depth is rounded to micro-units, DECIMAL(20,6), and those are summed exactly
(a double sum changes in its last bits with the partitioning); the quotient
is rounded once, half-up, at 6 places before it is reported as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURE_DECIMAL = "decimal(20,6)"


def exact_average(sum_col: str, count_col: str):
    """sum/count with one half-up rounding at scale 6 (decimal(38,6) division), as DOUBLE."""
    return (F.sum(sum_col).cast("decimal(38,6)") / F.sum(count_col)).cast("double")


def per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("Magnitude").cast(MEASURE_DECIMAL)).alias("_sum_mag"),
        F.count("Magnitude").alias("_n_mag"),
        F.max("Magnitude").alias("_max_mag"),
        F.sum(F.col("DepthKm").cast(MEASURE_DECIMAL)).alias("_sum_depth"),
        F.count("DepthKm").alias("_n_depth"),
        F.count_if(F.col("TsunamiWarning")).alias("_n_tsunami"),
    )


def finish(parts: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return parts.groupBy(*group_cols).agg(
        F.sum("_n").alias("events"),
        F.max("_max_mag").alias("max_magnitude"),
        exact_average("_sum_mag", "_n_mag").alias("avg_magnitude"),
        exact_average("_sum_depth", "_n_depth").alias("avg_depth_km"),
        F.sum("_n_tsunami").alias("tsunami_events"),
    )


def by_region(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    dim = dim_location.select("LocationKey", "extracted_country")
    return finish(per_key(fact, "LocationKey").join(dim, "LocationKey"), ["extracted_country"])


def by_magnitude(fact: DataFrame, dim_magnitude: DataFrame) -> DataFrame:
    mag = F.broadcast(dim_magnitude.select("MagnitudeKey", "MagnitudeCategory", "MinMagnitude", "MaxMagnitude"))
    parts = per_key(fact, "MagnitudeKey").join(mag, "MagnitudeKey")
    return finish(parts, ["MagnitudeCategory", "MinMagnitude", "MaxMagnitude"])


def by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    dim = dim_date.select("DateKey", "Year", "Month")
    return finish(per_key(fact, "DateKey").join(dim, "DateKey"), ["Year", "Month"])


def by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    dim = dim_date.select("DateKey", "DayOfWeek", "IsWeekend")
    return finish(per_key(fact, "DateKey").join(dim, "DateKey"), ["DayOfWeek", "IsWeekend"])
