"""Table sinks: partitioned Silver, external Gold tables, the run log.

* Silver is written partitioned by ``year``/``month``. A full rebuild
  overwrites the path; an incremental run passes ``dynamic=True`` so only
  the partitions present in the batch are replaced. There is deliberately
  no ``repartition(year, month)`` before the write: it would send a whole
  month to one task, and one month may hold a third of the data. Each task
  writes one file per month it holds (the writer sorts by the partition
  columns locally), with task sizes set by the upstream exchange.
* Gold tables are EXTERNAL parquet tables (``saveAsTable`` with a path) in
  a database whose location is given explicitly, so nothing lands in a
  process-local warehouse folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SILVER_PARTITIONS = ["year", "month"]


SILVER_SCHEMA = (
    "event_id string, event_timestamp_utc timestamp_ntz, updated_timestamp_utc timestamp_ntz, magnitude double, "
    "depth_km double, latitude double, longitude double, place string, event_type string, magType string, "
    "tsunami_warning boolean, significance int, felt_reports int, nst_stations int, rms_travel_time double, "
    "gap_azimuthal double, alert string, status string, url string, title string, batch_ts timestamp_ntz, "
    "magnitude_category string, depth_category string, hemisphere_ns string, hemisphere_ew string, day int, hour int, "
    "day_of_week int, extracted_region_detail string, extracted_country string, "
    "silver_processing_timestamp_utc timestamp_ntz, year int, month int"
)

SILVER_COLUMNS = [c.split()[0] for c in SILVER_SCHEMA.split(", ")]


def write_silver(silver: DataFrame, path: str, dynamic: bool = False, fmt: str = "parquet") -> None:
    """Write Silver with the batch time of each row, so that later merges can tell which content is newer."""
    if "batch_ts" not in silver.columns:
        silver = silver.withColumn("batch_ts", F.lit(None).cast("timestamp_ntz"))
    w = silver.write.format(fmt).partitionBy(*SILVER_PARTITIONS)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.mode("overwrite").save(path)


def read_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver scan with its declared schema (a table without rows stays readable); year/month filters prune partitions."""
    return spark.read.format(fmt).schema(SILVER_SCHEMA).load(path)


def ensure_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def write_gold_table(df: DataFrame, database: str, name: str, path: str) -> None:
    """Overwrite the files at ``path`` and (re)register ``database.name`` over them."""
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(f"`{database}`.`{name}`")


RUN_LOG_SCHEMA = (
    "run_id string, job string, status string, mode string, location string, flattened_rows bigint, "
    "valid_rows bigint, latest_rows bigint, fact_rows bigint, dim_date_rows bigint, dim_location_rows bigint, "
    "started_at timestamp, finished_at timestamp, "
    "duration_ms bigint"
)


def append_run_log(spark: SparkSession, path: str, record: dict) -> None:
    """Append one run record (a single driver-built row of metrics)."""
    row = spark.createDataFrame([record], RUN_LOG_SCHEMA)
    row.write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def backfill_done(run_log: DataFrame) -> "F.Column":
    """Load-complete marker: a successful backfill that loaded rows exists.

    Feeds the extract window (``sources.bronze.window_start``): once true,
    runs switch from the 365-day backfill to the 48-hour look-back. A
    skipped (empty) backfill does not count.
    """
    return run_log.filter(
        (F.col("mode") == "backfill") & (F.col("status") == "succeeded") & (F.col("flattened_rows") > 0)
    ).exists()


def path_has_table(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds partitions (success markers may be switched off on object stores)."""
    return bool(partition_folders(spark, path, ["year", "month"]))


def glob_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, from one listing and one call to the JVM."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    if not found:
        return []
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))[1:-1]
    parts = pattern.split("/")
    depth = len(parts) - next(k for k, part in enumerate(parts) if set(part) & set("*[?{"))
    root = found[0].getPath().toString().rsplit("/", depth)[0]
    return [root + rest for rest in f",{text}".split(f",{root}")[1:]]


def list_folders(spark: SparkSession, path: str, keys: list[str]) -> list[tuple[str, dict[str, str]]]:
    """(folder, partition values as texts) below ``path``."""
    folders = glob_folders(spark, "/".join([path.rstrip("/"), *(f"{k}=*" for k in keys)]))
    return [(f, dict(part.split("=", 1) for part in f.split("/")[-len(keys) :])) for f in folders]


def partition_folders(spark: SparkSession, path: str, keys: list[str]) -> list[tuple[str, dict[str, int]]]:
    """(folder, partition values) of a partitioned path whose values are all numbers."""
    listed = list_folders(spark, path, keys)
    return [(f, {k: int(x) for k, x in v.items()}) for f, v in listed if all(x.isdigit() for x in v.values())]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def delete_folder(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_partition(spark: SparkSession, path: str, year: int, month: int) -> None:
    """Delete one year/month partition folder of a path-based table."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/year={year}/month={month}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
