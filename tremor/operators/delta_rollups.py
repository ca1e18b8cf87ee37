"""Roll-ups kept current by signed deltas.

A merge changes few events, yet recomputing a roll-up reads the whole fact. Here a merge adds to a log what it changed:
minus one for every Silver row it removes or replaces, plus one for every row it writes, summed per roll-up, group and
magnitude value. Sums and counts are additive, so a roll-up is the sum of its log. The maximum is not, so the log counts
rows per magnitude value, and the maximum is the largest value whose count is above zero: a retracted maximum gives way
to the one below it without a look at the fact.

Rows enter as the fact takes them in (``fact.star_lookup_matches``). A log row is written only for groups that the merge
touches; what nets to zero is left out. Each merge writes its own folder (``merge=<id>``), replaced as a whole when a
cut-off merge is finished again, so nothing counts twice.

``compact`` folds the log into one folder of a new generation. A generation counts once it is marked ready; older ones
are deleted after that, so a crash leaves either the old log or the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import casts, features
from ..session import touch
from ..sinks import tables
from . import dims, fact, rollups

#: roll-up -> its two group columns, as texts of a Silver row (the second may be unused)
GROUPS = ("region", "magnitude", "month", "weekday")
MEASURES = {"n": "bigint", "sum_depth": "decimal(38,6)", "n_depth": "bigint", "n_tsunami": "bigint"}
LOG_SCHEMA = "rollup string, g1 string, g2 string, magnitude double, " + ", ".join(f"{c} {t}" for c, t in MEASURES.items())
KEYS = ["rollup", "g1", "g2", "magnitude"]
BASE = "base"


def log_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_rollups"


def _groups() -> Column:
    day = F.to_date("event_timestamp_utc")
    weekday = features.day_attributes(day)
    rows = {
        "region": ("extracted_country", None),
        "magnitude": ("magnitude_category", None),
        "month": (F.year(day), F.month(day)),
        "weekday": (weekday["DayOfWeek"], weekday["IsWeekend"]),
    }
    def text(c) -> Column:
        return (F.col(c) if isinstance(c, str) else F.lit(None) if c is None else c).cast("string")

    return F.array(*[F.struct(F.lit(k).alias("rollup"), text(a).alias("g1"), text(b).alias("g2")) for k, (a, b) in rows.items()])


def deltas(removed: DataFrame | None, added: DataFrame) -> DataFrame:
    """Log rows of Silver rows that go and rows that come (combined per task before the shuffle)."""
    signed = added.withColumn("_sign", F.lit(1))
    if removed is not None:
        columns = [*added.columns, "_sign"]
        signed = signed.unionByName(removed.withColumn("_sign", F.lit(-1)).select(*columns))
    rows = signed.filter(fact.star_lookup_matches()).select(
        F.explode(_groups()).alias("g"),
        F.col("magnitude"),
        F.col("_sign").cast("bigint").alias("n"),
        (F.col("depth_km").cast(rollups.MEASURE_DECIMAL) * F.col("_sign")).alias("sum_depth"),
        F.when(F.col("depth_km").isNotNull(), F.col("_sign")).otherwise(0).cast("bigint").alias("n_depth"),
        F.when(F.col("tsunami_warning"), F.col("_sign")).otherwise(0).cast("bigint").alias("n_tsunami"),
    )
    return _sum(rows.select("g.*", "magnitude", *MEASURES))


def _sum(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy(*KEYS).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in MEASURES.items()])
    return summed.filter(" or ".join(f"{c} <> 0" for c in MEASURES))


def generation(spark: SparkSession, silver_path: str) -> int | None:
    """The newest ready generation of the log, None without a log."""
    found = tables.glob_folders(spark, f"{log_path(silver_path)}/gen=*/_ready")
    return max((int(f.rsplit("/", 2)[1].partition("=")[2]) for f in found), default=None)


def _folder(silver_path: str, gen: int) -> str:
    return f"{log_path(silver_path)}/gen={gen}"


def _start(spark: SparkSession, silver_path: str, rows: DataFrame) -> int:
    """Write ``rows`` as the base of a new generation, mark it ready, then delete the older ones."""
    there = [int(f.rpartition("=")[2]) for f in tables.glob_folders(spark, f"{log_path(silver_path)}/gen=*")]
    gen = max(there, default=0) + 1
    rows.write.parquet(f"{_folder(silver_path, gen)}/merge={BASE}")
    touch(spark, f"{_folder(silver_path, gen)}/_ready")
    for old in there:
        tables.delete_folder(spark, _folder(silver_path, old))
    return gen


def rebuild(spark: SparkSession, silver_path: str) -> int:
    """Start the log anew from the written Silver."""
    return _start(spark, silver_path, deltas(None, tables.read_silver(spark, silver_path)))


def drop(spark: SparkSession, silver_path: str) -> None:
    if generation(spark, silver_path) is not None:
        tables.delete_folder(spark, log_path(silver_path))


def append(spark: SparkSession, silver_path: str, rows: DataFrame, merge_id: str) -> None:
    """Add a merge's log rows; a second call with the same id replaces them."""
    gen = generation(spark, silver_path)
    rows.write.mode("overwrite").parquet(f"{_folder(silver_path, gen)}/merge={merge_id}")


def read_log(spark: SparkSession, silver_path: str) -> DataFrame:
    """All log rows of the current generation, with the ``merge`` they come from."""
    gen = generation(spark, silver_path)
    return spark.read.schema(f"{LOG_SCHEMA}, merge string").parquet(_folder(silver_path, gen))


def compact(spark: SparkSession, silver_path: str) -> int:
    """Fold the log into one base; returns how many merges it held."""
    gen = generation(spark, silver_path)
    merges = len(tables.glob_folders(spark, f"{_folder(silver_path, gen)}/merge=*"))
    _start(spark, silver_path, _sum(read_log(spark, silver_path).drop("merge")))
    return merges


def totals(log: DataFrame, rollup: str) -> DataFrame:
    """(g1, g2) and the roll-up's measures; groups without rows left are gone."""
    values = _sum(log.filter(F.col("rollup") == rollup).select(*KEYS, *MEASURES))
    magnitude = F.col("magnitude").cast(rollups.MEASURE_DECIMAL) * F.col("n")
    parts = values.select(
        "g1", "g2",
        F.col("n").alias("_n"),
        magnitude.alias("_sum_mag"),
        F.when(F.col("magnitude").isNotNull(), F.col("n")).otherwise(0).alias("_n_mag"),
        F.when(F.col("n") > 0, F.col("magnitude")).alias("_max_mag"),
        F.col("sum_depth").alias("_sum_depth"),
        F.col("n_depth").alias("_n_depth"),
        F.col("n_tsunami").alias("_n_tsunami"),
    )
    return rollups.finish(parts, ["g1", "g2"]).filter("events > 0")


MEASURE_COLUMNS = ["events", "max_magnitude", "avg_magnitude", "avg_depth_km", "tsunami_events"]


def by_region(log: DataFrame) -> DataFrame:
    return totals(log, "region").select(F.col("g1").alias("extracted_country"), *MEASURE_COLUMNS)


def by_magnitude(log: DataFrame) -> DataFrame:
    classes = dims.dim_magnitude(log.sparkSession).select("MagnitudeCategory", "MinMagnitude", "MaxMagnitude")
    joined = totals(log, "magnitude").join(F.broadcast(classes), F.col("g1") == F.col("MagnitudeCategory"))  # eight rows
    return joined.select("MagnitudeCategory", "MinMagnitude", "MaxMagnitude", *MEASURE_COLUMNS)


def by_month(log: DataFrame) -> DataFrame:
    year, month = F.col("g1").cast("int").alias("Year"), F.col("g2").cast("int").alias("Month")
    return totals(log, "month").select(year, month, *MEASURE_COLUMNS)


def by_weekday(log: DataFrame) -> DataFrame:
    day, weekend = F.col("g1").cast("int").alias("DayOfWeek"), F.col("g2").cast("int").alias("IsWeekend")
    return totals(log, "weekday").select(day, weekend, *MEASURE_COLUMNS)
