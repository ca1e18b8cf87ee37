"""Bronze sources: the landed-document scan, flatten, and extract windows.

The scan always uses the declared document schema and recursive lookup;
``batch_ts`` (the fetch hour a document was landed under) comes back from
the file path through the hidden ``_metadata`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..functions import casts

# Fixed value: hourly landing folders, with or without ``key=`` prefixes
# (``.../2024/01/05/13/file`` or ``.../yyyy=2024/MM=01/dd=05/HH=13/file``).
BATCH_PATH_PATTERN = r"(?:yyyy=)?(\d{4})/(?:MM=)?(\d{2})/(?:dd=)?(\d{2})/(?:HH=)?(\d{2})/[^/]+$"

# Folder of a packed file (``sinks.packs``): its documents hold several hours, each its own as metadata.generated.
PACK_PATH_PATTERN = r"/from=\d{10}/to=\d{10}/id=[^/]+/[^/]+$"

BACKFILL_DAYS = fixed.BACKFILL_DAYS
INCREMENTAL_HOURS = fixed.INCREMENTAL_HOURS
MIN_MAGNITUDE = fixed.MIN_MAGNITUDE


def _reader(spark: SparkSession, streaming: bool, schema, max_files_per_trigger: int | None = None,
            max_bytes_per_trigger: int | None = None):
    r = spark.readStream if streaming else spark.read
    r = r.schema(schema).option("recursiveFileLookup", "true")
    if streaming and max_bytes_per_trigger:  # Spark takes one of the two bounds
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    elif streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r


def read_documents(spark: SparkSession, path: str | list[str], streaming: bool = False, for_silver: bool = False,
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Landed documents (batch scan of a folder or of listed folders, or an incremental file stream).

    ``for_silver`` declares only the properties Silver uses: nested fields
    are not pruned through ``explode``, so the declared schema is what keeps
    the JSON parser from materialising the unused ones. ``max_files_per_trigger``
    bounds each micro-batch of a stream (``availableNow`` honours it), so a
    large backlog drains in many bounded batches instead of one huge one;
    ``max_bytes_per_trigger`` bounds it by size instead, for packed files.
    """
    schema = schemas.SILVER_DOCUMENT if for_silver else schemas.BRONZE_DOCUMENT
    return _reader(spark, streaming, schema, max_files_per_trigger, max_bytes_per_trigger).json(path)


def batch_ts_from_path(path: Column) -> Column:
    """Landing hour encoded in a file path; null when the path has none."""
    parts = [F.regexp_extract(path, BATCH_PATH_PATTERN, i) for i in range(1, 5)]
    return F.when(
        path.rlike(BATCH_PATH_PATTERN),
        F.try_make_timestamp_ntz(*[p.cast("int") for p in parts], F.lit(0), F.lit(0)),
    )


def with_batch_ts(docs: DataFrame) -> DataFrame:
    """Adds the landing hour: the path's, or the document's own in a packed file."""
    path = F.col("_metadata.file_path")
    own = F.date_trunc("HOUR", casts.epoch_ms_to_ts("metadata.generated"))
    return docs.withColumn("batch_ts", F.when(path.rlike(PACK_PATH_PATTERN), own).otherwise(batch_ts_from_path(path)))


def flatten(docs: DataFrame) -> DataFrame:
    """One row per feature (``explode``: empty/null arrays yield no row).

    Coordinates are read with ``get`` so a 2-element array gives a null depth
    (later rejected) instead of an index error under ANSI.
    """
    keep = [c for c in ("batch_ts",) if c in docs.columns]
    f = docs.select(*keep, F.explode("features").alias("f"))
    coords = F.col("f.geometry.coordinates")
    declared = set(f.schema["f"].dataType["properties"].dataType.fieldNames())
    cols = (
        [F.col("f.id").alias("id")]
        + [F.col(f"f.properties.{n}").alias(n) for n, _ in schemas.PROPERTY_FIELDS if n in declared]
        + [F.get(coords, 0).alias("longitude"), F.get(coords, 1).alias("latitude"), F.get(coords, 2).alias("depth")]
    )
    return f.select(*cols, *keep)


def extract_pages(rows: DataFrame, start: Column, end: Column, ts: str = "event_timestamp_utc",
                  page_size: int = fixed.MAX_FEATURES_PER_DOCUMENT, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """All rows of ``[start, end]`` above the magnitude floor with ``page`` and ``page_row`` (both from 0), newest first.

    A row's rank is its rank within its minute plus the rows of all newer minutes (a small table with one row per
    minute, summed per day first), so no task orders the whole window. The order is total (newest event first, then
    id, newest revision, then the remaining columns), so pages are the same on every run.
    """
    hit = rows.filter(F.col(ts).between(start, end) & (F.col("magnitude") >= min_magnitude))
    first = [ts, "event_id", "updated_timestamp_utc"]
    order = [F.col(ts).desc(), F.col("event_id").asc(), F.col("updated_timestamp_utc").desc_nulls_last()]
    order.extend(F.col(c).asc_nulls_last() for c in rows.columns if c not in first)
    hit = hit.withColumn("_day", F.to_date(ts)).withColumn("_minute", F.date_trunc("minute", ts))
    newer = Window.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    newer_in_day = Window.partitionBy("_day").orderBy(F.desc("_minute")).rowsBetween(Window.unboundedPreceding, -1)
    minutes = hit.groupBy("_day", "_minute").agg(F.count(F.lit(1)).alias("_n"))
    days = minutes.groupBy("_day").agg(F.sum("_n").alias("_n"))  # one row per calendar day
    days = days.select("_day", F.coalesce(F.sum("_n").over(newer), F.lit(0)).alias("_newer_days"))
    before = minutes.withColumn("_newer", F.coalesce(F.sum("_n").over(newer_in_day), F.lit(0))).join(days, "_day")
    before = before.select("_minute", (F.col("_newer") + F.col("_newer_days")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_minute").orderBy(*order)) - 1
    ranked = hit.withColumn("_rank", rank).join(before, "_minute").withColumn("_rank", F.col("_rank") + F.col("_before"))
    return ranked.select(
        *rows.columns,
        F.floor(F.col("_rank") / F.lit(page_size)).alias("page"),
        (F.col("_rank") % F.lit(page_size)).cast("bigint").alias("page_row"),
    )


def bounded_extract(rows: DataFrame, start: Column, end: Column, ts: str = "event_timestamp_utc",
                    limit: int = fixed.MAX_FEATURES_PER_DOCUMENT, min_magnitude: float = MIN_MAGNITUDE) -> DataFrame:
    """The source's single request: the first page. ``extract_pages`` gives the rows beyond it."""
    pages = extract_pages(rows, start, end, ts, limit, min_magnitude)
    return pages.filter(F.col("page") == 0).orderBy("page_row").select(*rows.columns)


def document_counts(docs: DataFrame) -> DataFrame:
    """One row: documents, those that did not parse, features declared by their documents, features present."""
    broken = F.col("features").isNull() & F.col("metadata").isNull()
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(broken).alias("corrupt_documents"),
        F.coalesce(F.sum("metadata.count"), F.lit(0)).alias("declared_features"),
        F.coalesce(F.sum(F.greatest(F.size("features"), F.lit(0))), F.lit(0)).cast("bigint").alias("features"),
    )


def window_start(as_of: Column, table_has_rows: Column) -> Column:
    """Backfill (365 d) while the target is empty, else the 48 h look-back."""
    return F.when(
        table_has_rows, as_of - F.make_dt_interval(F.lit(0), F.lit(INCREMENTAL_HOURS))
    ).otherwise(as_of - F.make_dt_interval(F.lit(BACKFILL_DAYS)))


def window_mode(table_has_rows: Column) -> Column:
    return F.when(table_has_rows, "incremental").otherwise("backfill")
