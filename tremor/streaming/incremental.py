"""Incremental Bronze processing with Structured Streaming.

* ``bronze_stream``: the landed-document folder as a file stream (declared
  schema, recursive lookup), flattened, with ``batch_ts`` from the path.
* ``history_stream``: typed rows, watermark on event time, duplicate
  removal on ``(event_id, updated, event time)`` so exact re-fetches of the
  look-back window vanish while true revisions stay. The watermark bounds
  the dedup state to the look-back. Valid rows are appended to a Silver
  history table.
* ``latest_from_history``: the latest revision per event, computed on read
  with the same window as the batch job. (Built-in streaming dedup keeps
  the *first* row of a key, never the latest, so latest-wins stays a read
  over the append-only history.)

Runs use ``trigger(availableNow=True)``: each run drains what has landed
and stops, resuming from its checkpoint next time (exactly-once file sink).

Two forms of the overlap removal are provided:

* ``append_history`` (default): a stateless file stream whose micro-batches
  are merged with ``foreachBatch``. Each batch is first deduplicated in
  batch mode, where a partial group limit collapses a group of copies
  map-side (a re-sent revision holding a third of the batch does not land in
  one task). The rows are then checked against the history's partitions of
  the same event dates and appended unless the newest stored row of their key
  has the same content. The watermark is the newest event time of earlier
  batches minus the look-back, kept in a small per-batch log. Rows behind it
  are counted as late and kept in their own date partitions. A replayed batch
  is a no-op: its log row exists or the anti-join removes its rows.
* ``append_history_stateful``: ``withWatermark`` + ``dropDuplicates`` with
  the state store. It is simpler, but every copy of a key is shuffled to the
  key's task, the first content of a key stays, and the state store drops
  rows behind the watermark: use it only where late rows may go.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed, schemas
from ..functions import casts
from ..operators import dedup, quality
from ..plans import silver as silver_plan
from ..session import path_exists
from ..sources import bronze

LOOKBACK_HOURS = fixed.INCREMENTAL_HOURS
LOOKBACK = f"{LOOKBACK_HOURS} hours"
WATERMARK_COL = "_event_instant"
#: landed files per micro-batch: a backlog drains in many bounded batches
MAX_FILES_PER_TRIGGER = 1000
#: bytes of packed documents per micro-batch (``sinks.packs``: files of up to 128 MB, where a count of files bounds little)
MAX_BYTES_PER_TRIGGER = 8 << 30
DEDUP_KEYS = ["event_id", "updated_timestamp_utc", WATERMARK_COL]


def bronze_stream(spark: SparkSession, landing_path: str, for_silver: bool = False,
                  max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    docs = bronze.read_documents(
        spark, landing_path, streaming=True, for_silver=for_silver, max_files_per_trigger=max_files_per_trigger,
        max_bytes_per_trigger=max_bytes_per_trigger,
    )
    return bronze.flatten(bronze.with_batch_ts(docs))


def history_rows(flat_stream: DataFrame, lookback: str = LOOKBACK) -> DataFrame:
    """Watermarks need an instant (TIMESTAMP); Silver keeps UTC wall clock (NTZ).

    The instant twin of the event time carries the watermark and stands in
    for the event time in the dedup key (one-to-one), then is dropped.
    """
    typed = silver_plan.select_typed(flat_stream).withColumn(WATERMARK_COL, casts.event_time("event_timestamp_utc"))
    deduped = typed.withWatermark(WATERMARK_COL, lookback).dropDuplicates(DEDUP_KEYS)
    return quality.valid(deduped).drop(WATERMARK_COL)


def _run(df: DataFrame, sink_path: str, checkpoint: str, name: str) -> StreamingQuery:
    q = (
        df.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return q


def capture_raw(spark: SparkSession, landing_path: str, sink_path: str, checkpoint: str,
                max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Drain newly landed documents into a flat raw-feature table."""
    docs = bronze_stream(spark, landing_path, False, max_files_per_trigger, max_bytes_per_trigger)
    return _run(docs, sink_path, checkpoint, "bronze_raw")


def append_history_stateful(spark: SparkSession, landing_path: str, sink_path: str, checkpoint: str,
                            lookback: str = LOOKBACK,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Drain newly landed documents into the history with state-store dedup.

    One micro-batch per run unless bounded: within a run the watermark would move between bounded micro-batches and
    drop rows of a backlog that is not in event-time order.
    """
    docs = bronze_stream(spark, landing_path, for_silver=True, max_files_per_trigger=max_files_per_trigger)
    return _run(history_rows(docs, lookback), sink_path, checkpoint, "silver_history")


HISTORY_PARTITION = "event_date"
STATIC_KEYS = ["event_id", "updated_timestamp_utc", "event_timestamp_utc"]
BATCH_LOG_SCHEMA = (
    "query_id string, batch_id bigint, max_event_time timestamp_ntz, input_rows bigint, late_rows bigint, appended_rows bigint"
)


def _log_path(sink_path: str) -> str:
    return f"{sink_path}_batches"


HISTORY_SCHEMA = (
    "event_id string, event_timestamp_utc timestamp_ntz, updated_timestamp_utc timestamp_ntz, magnitude double, "
    "depth_km double, latitude double, longitude double, place string, event_type string, magType string, "
    "tsunami_warning boolean, significance int, felt_reports int, nst_stations int, rms_travel_time double, "
    "gap_azimuthal double, alert string, status string, url string, title string, batch_ts timestamp_ntz, "
    "event_date date"
)


def read_history(spark: SparkSession, sink_path: str) -> DataFrame:
    """The micro-batch history with its declared schema (empty until a batch appends rows)."""
    if not path_exists(spark, sink_path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(sink_path)


def batch_log(spark: SparkSession, sink_path: str) -> DataFrame:
    path = _log_path(sink_path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], BATCH_LOG_SCHEMA)
    return spark.read.schema(BATCH_LOG_SCHEMA).parquet(path)


#: days in a micro-batch up to which the history scan is pruned to them
PRUNED_DATES = 400


def merge_micro_batch(batch: DataFrame, batch_id: int, sink_path: str, lookback_hours: int = LOOKBACK_HOURS,
                      query_id: str | None = None) -> None:
    """Append one micro-batch's new valid revisions to the history (idempotent).

    Late rows (event time behind the newest one of earlier batches by more than the look-back) are counted and kept:
    they go to their own event-date partitions. A row is left out only if the newest stored row of its (id, updated,
    event time) has the same content, so a replayed batch appends nothing and changed content is never lost.

    Batches are logged by (query id, batch id): a new checkpoint counts its batches from 0 again, under an id of its own.
    """
    spark = batch.sparkSession
    log = batch_log(spark, sink_path)
    if not log.filter((F.col("batch_id") == batch_id) & F.col("query_id").eqNullSafe(F.lit(query_id))).isEmpty():
        return
    # newest event time of earlier batches, carried as epoch ms (no local-zone literal)
    newest = log.agg(F.max(casts.ts_to_epoch_ms("max_event_time"))).first()[0]
    typed = silver_plan.select_typed(batch)
    if silver_plan.BATCH_TS not in typed.columns:
        typed = typed.withColumn(silver_plan.BATCH_TS, F.lit(None).cast("timestamp_ntz"))
    late = F.lit(False)
    if newest is not None:
        watermark = casts.epoch_ms_to_ts(F.lit(newest - lookback_hours * 3600 * 1000))
        late = F.coalesce(F.col("event_timestamp_utc") < watermark, F.lit(False))
    obs = Observation(f"history_batch_{batch_id}")
    typed = typed.observe(
        obs,
        F.count(F.lit(1)).alias("input_rows"),
        F.max("event_timestamp_utc").alias("max_event_time"),
        F.count_if(late).alias("late_rows"),
    )
    order = silver_plan.revision_order(typed.columns)
    rows = dedup.latest_per_key(quality.valid(typed), STATIC_KEYS, order)
    rows = rows.withColumn(HISTORY_PARTITION, F.to_date("event_timestamp_utc"))
    if path_exists(spark, sink_path):
        stored = read_history(spark, sink_path)
        dates = [r[0] for r in rows.select(HISTORY_PARTITION).distinct().limit(PRUNED_DATES + 1).collect()]
        if len(dates) <= PRUNED_DATES:  # static partition pruning; more dates read all partitions, same result
            stored = stored.filter(F.col(HISTORY_PARTITION).isin(dates)) if dates else stored.limit(0)
        stored = dedup.latest_per_key(stored, STATIC_KEYS, order).alias("s")
        content = [c for c in schemas.SILVER_SELECTED_COLUMNS if c not in STATIC_KEYS]
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in STATIC_KEYS + content]
        rows = rows.alias("r").join(stored, same, "left_anti")
    obs_out = Observation(f"history_out_{batch_id}")
    # one task's rows lie in few dates, and a crowded date is cut by the adaptive rebalance: else every task writes every date
    out = rows.hint("rebalance", F.col(HISTORY_PARTITION)).observe(obs_out, F.count(F.lit(1)).alias("appended_rows"))
    out.write.mode("append").partitionBy(HISTORY_PARTITION).parquet(sink_path)
    m_in = obs.get
    record = {
        "query_id": query_id,
        "batch_id": batch_id,
        "max_event_time": m_in.get("max_event_time"),
        "input_rows": m_in.get("input_rows", 0),
        "late_rows": m_in.get("late_rows", 0),
        "appended_rows": obs_out.get.get("appended_rows", 0),
    }
    spark.createDataFrame([record], BATCH_LOG_SCHEMA).write.mode("append").parquet(_log_path(sink_path))


def append_history(spark: SparkSession, landing_path: str, sink_path: str, checkpoint: str,
                   lookback_hours: int = LOOKBACK_HOURS,
                   max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                   max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Drain newly landed documents into the history, one pre-aggregated merge per micro-batch."""
    started, query_id = threading.Event(), []

    def merge(batch: DataFrame, batch_id: int) -> None:
        started.wait()  # the id is known once start() has returned
        merge_micro_batch(batch, batch_id, sink_path, lookback_hours, query_id[0])

    q = (
        bronze_stream(spark, landing_path, True, max_files_per_trigger, max_bytes_per_trigger)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .queryName("silver_history_batches")
        .trigger(availableNow=True)
        .start()
    )
    query_id.append(str(q.id))
    started.set()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream silver_history_batches failed: {q.exception()}")
    return q


def late_rows(spark: SparkSession, sink_path: str) -> int:
    """Rows that came in behind the watermark (all kept) over all merged micro-batches."""
    return batch_log(spark, sink_path).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark)
    return total


def latest_from_history(history: DataFrame, with_clock: bool = True) -> DataFrame:
    if HISTORY_PARTITION in history.columns:
        history = history.drop(HISTORY_PARTITION)
    return silver_plan.enrich(silver_plan.latest(history), with_clock=with_clock)


def compact_silver(spark: SparkSession, landing_path: str, silver_path: str, checkpoint: str,
                   max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                   max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Keep a compacted, latest-wins Silver table current from the document stream.

    Each micro-batch is merged into Silver with ``plans.jobs.merge_silver``
    (affected months only, dynamic partition overwrite). Latest-wins is
    idempotent, so a replayed micro-batch leaves Silver unchanged.
    """
    from ..plans import jobs
    from ..sinks import tables

    def merge(batch: DataFrame, batch_id: int) -> None:
        if tables.path_has_table(spark, silver_path):
            jobs.merge_silver(batch.sparkSession, batch, silver_path)
        else:
            jobs.run_silver(batch, silver_path)

    q = (
        bronze_stream(spark, landing_path, True, max_files_per_trigger, max_bytes_per_trigger)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .queryName("silver_compaction")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream silver_compaction failed: {q.exception()}")
    return q
