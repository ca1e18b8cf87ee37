"""Shared, written intermediates for the registered queries.

Queries that exercise sinks and streams need data that has really been
written: landed Bronze documents, a partitioned Silver table, external
Gold tables, stream sinks. Each is produced once per application and
input folder under the session's checkpoint dir (shared storage on a
cluster) and reused by every query that reads it; a completion marker
makes a half-written attempt invisible.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed, fixtures
from ..functions import casts
from ..operators import delta_rollups, dense_keys, dims, month_index, quarantine
from ..session import dataset_tag, path_exists, scratch_dir, table, touch
from ..sinks import geojson, packs
from ..sinks import tables as sinks
from ..sources import bronze
from ..streaming import incremental
from . import jobs, runs

DONE = "_tremor_done"
_LOCK = threading.RLock()


def _serialized(fn):
    """Build each intermediate once even when queries run from several threads."""

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        with _LOCK:
            return fn(*args, **kwargs)

    return wrapper


def _root(spark: SparkSession, sf_dir: str, what: str) -> str:
    return scratch_dir(spark, what, dataset_tag(sf_dir))


def _done(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{DONE}")


def flat_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_flat(fixtures.quakes(table(spark, sf_dir, "events")))


def fetch_hour(flat: DataFrame) -> F.Column:
    """Landing hour of a feature: the hour of its event time."""
    return F.date_trunc("HOUR", casts.epoch_ms_to_ts("time"))


@_serialized
def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue landed as hourly GeoJSON documents; returns the folder."""
    path = _root(spark, sf_dir, "bronze")
    if not _done(spark, path):
        flat = flat_quakes(spark, sf_dir)
        packs.land_packed(flat, fetch_hour(flat), path)
        touch(spark, f"{path}/{DONE}")
    return path


@_serialized
def landed_by_hour(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue landed with one folder per hour; returns the folder."""
    path = _root(spark, sf_dir, "bronze_hours")
    if not _done(spark, path):
        flat = flat_quakes(spark, sf_dir)
        geojson.land(geojson.nest(flat, fetch_hour(flat)), path)
        touch(spark, f"{path}/{DONE}")
    return path


DAMAGE = r'"nst":(\d*[05]),'


@_serialized
def damaged_bronze(spark: SparkSession, sf_dir: str) -> str:
    """The landed documents, each without its end, and features whose ``nst`` ends in 0 or 5 without that value."""
    path = _root(spark, sf_dir, "bronze_damaged")
    if not _done(spark, path):
        text = spark.read.option("recursiveFileLookup", "true").text(landed_bronze(spark, sf_dir))
        cut = F.substring("value", F.lit(1), F.length("value") - 2)
        text.select(F.regexp_replace(cut, DAMAGE, '"nst":,').alias("value")).write.mode("overwrite").text(path)
        touch(spark, f"{path}/{DONE}")
    return path


LATE_MODULUS, LATE_REMAINDER = 11, 5


def lands_late(flat: DataFrame) -> F.Column:
    """Rows of the hours that the second of two landings brings: every eleventh hour, all over the catalogue."""
    return F.floor(F.col("time") / F.lit(3_600_000)) % LATE_MODULUS == LATE_REMAINDER


@_serialized
def landed_twice(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Two landings of packed hours: the first read by a backfill run, the second (late hours) not read yet."""
    root = _root(spark, sf_dir, "landed_twice")
    out = {"landing": f"{root}/landing", "lake": f"{root}/lake", "ledger": f"{root}/lake/bronze_ledger"}
    if not _done(spark, root):
        flat = flat_quakes(spark, sf_dir)
        packs.land_packed(flat.filter(~lands_late(flat)), fetch_hour(flat), out["landing"], target_bytes=1 << 20)
        jobs.run_landed(spark, out["landing"], out["lake"], database=f"gold_twice_{dataset_tag(sf_dir)}")
        packs.land_packed(flat.filter(lands_late(flat)), fetch_hour(flat), out["landing"], target_bytes=1 << 20)
        touch(spark, f"{root}/{DONE}")
    return out


@_serialized
def caught_up(spark: SparkSession, sf_dir: str) -> str:
    """A lake of its own: a backfill run over the first landing, an incremental run over what the second brought."""
    root = _root(spark, sf_dir, "caught_up")
    if not _done(spark, root):
        flat = flat_quakes(spark, sf_dir)
        for part in (~lands_late(flat), lands_late(flat)):
            packs.land_packed(flat.filter(part), fetch_hour(flat), f"{root}/landing", target_bytes=1 << 20)
            jobs.run_landed(spark, f"{root}/landing", f"{root}/lake", database=f"gold_caught_{dataset_tag(sf_dir)}")
        touch(spark, f"{root}/{DONE}")
    return f"{root}/lake"


@_serialized
def written_silver(spark: SparkSession, sf_dir: str) -> str:
    """Silver written (partitioned) from the flat catalogue; returns the table folder."""
    root = _root(spark, sf_dir, "lake")
    path = f"{root}/silver/earthquakes_cleaned"
    if not _done(spark, path):
        jobs.run_silver(flat_quakes(spark, sf_dir), path)
        touch(spark, f"{path}/{DONE}")
    return path


@_serialized
def written_gold(spark: SparkSession, sf_dir: str, database: str) -> str:
    """Gold tables written from the written Silver; returns the Gold folder."""
    silver_path = written_silver(spark, sf_dir)
    gold_root = f"{_root(spark, sf_dir, 'lake')}/gold"
    if not _done(spark, gold_root) or not spark.catalog.tableExists(f"{database}.fact_earthquake_events"):
        jobs.run_gold(spark, silver_path, gold_root, database)
        touch(spark, f"{gold_root}/{DONE}")
    return gold_root


OVERLAP_DAYS = 300


def overlap_cut(flat: DataFrame) -> F.Column:
    """Split point of the two simulated fetches: first event day + 300 days."""
    first_day = flat.agg(F.date_trunc("DAY", F.min(casts.epoch_ms_to_ts("time")))).scalar()
    return first_day + F.make_dt_interval(F.lit(OVERLAP_DAYS))


def fetches(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two fetches overlapping by the 48 h look-back: before the cut, and from cut - 48 h."""
    ts = casts.epoch_ms_to_ts("time")
    cut = overlap_cut(flat)
    first = flat.filter(ts < cut)
    second = flat.filter(ts >= cut - F.make_dt_interval(F.lit(0), F.lit(fixed.INCREMENTAL_HOURS)))
    return first, second


@_serialized
def streamed(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Land two overlapping fetches, draining both streams after each landing."""
    root = _root(spark, sf_dir, "stream")
    out = {
        "landing": f"{root}/landing",
        "raw": f"{root}/raw",
        "history": f"{root}/history",
        "history_stateful": f"{root}/history_stateful",
        "compacted": f"{root}/silver_compacted",
    }
    if _done(spark, root):
        return out
    flat = flat_quakes(spark, sf_dir)
    # a fetch brings many hours: packed, their documents are few files, which the streams list and drain in few batches
    size = {"max_bytes_per_trigger": incremental.MAX_BYTES_PER_TRIGGER}
    for i, batch in enumerate(fetches(flat)):
        packs.land_packed(batch, fetch_hour(batch), f"{out['landing']}/fetch={i}")
        incremental.capture_raw(spark, out["landing"], out["raw"], f"{root}/_checkpoints/raw", **size)
        incremental.append_history(spark, out["landing"], out["history"], f"{root}/_checkpoints/history", **size)
        incremental.append_history_stateful(
            spark, out["landing"], out["history_stateful"], f"{root}/_checkpoints/history_stateful"
        )
        incremental.compact_silver(spark, out["landing"], out["compacted"], f"{root}/_checkpoints/compacted", **size)
    touch(spark, f"{root}/{DONE}")
    return out


@_serialized
def merged_silver(spark: SparkSession, sf_dir: str) -> str:
    """Silver built from the first fetch, then the overlapping second fetch merged in."""
    root = _root(spark, sf_dir, "merge")
    path = f"{root}/silver/earthquakes_cleaned"
    if not _done(spark, path):
        first, second = fetches(flat_quakes(spark, sf_dir))
        jobs.run_silver(first, path)
        jobs.merge_silver(spark, second, path)
        touch(spark, f"{path}/{DONE}")
    return path


@_serialized
def quarantined(spark: SparkSession, sf_dir: str) -> str:
    """Both lanes of all flattened rows, written in one pass; returns the run's folder."""
    path = _root(spark, sf_dir, "quarantine")
    if not _done(spark, path):
        quarantine.fan_out(flat_quakes(spark, sf_dir), path, "all")
        touch(spark, f"{path}/{DONE}")
    return f"{path}/run=all"


ROLLUP_MERGES = 3


@_serialized
def rolled_up(spark: SparkSession, sf_dir: str) -> str:
    """Silver of a part of all revisions with a roll-up log, then three merges of the others; returns the table folder.

    The log is compacted before the last merge.
    """
    root = _root(spark, sf_dir, "rolled_up")
    path = f"{root}/silver"
    if not _done(spark, root):
        flat = flat_quakes(spark, sf_dir)
        part = F.col("code").cast("bigint") % 8  # revisions of one event fall into different parts
        jobs.run_silver(flat.filter(part >= ROLLUP_MERGES), path, rollups=True)
        for k in range(ROLLUP_MERGES):
            if k == ROLLUP_MERGES - 1:
                delta_rollups.compact(spark, path)
            jobs.merge_silver(spark, flat.filter(part == k), path)
        touch(spark, f"{root}/{DONE}")
    return path


@_serialized
def indexed_silver(spark: SparkSession, sf_dir: str) -> str:
    """The written Silver with its key-to-month index; returns the table folder."""
    path = written_silver(spark, sf_dir)
    if month_index.shard_count(spark, path) is None:
        month_index.build(spark, path)
    return path


KEY_RUNS = 3


@_serialized
def dense_keys_of_three_runs(spark: SparkSession, sf_dir: str) -> str:
    """Key tables after three runs that see more and more of Silver, each partitioned in another way; returns the folder."""
    root = _root(spark, sf_dir, "dense_keys")
    if not _done(spark, root):
        silver = sinks.read_silver(spark, written_silver(spark, sf_dir))
        run = (F.col("year") * 12 + F.col("month")) % KEY_RUNS
        for k in range(KEY_RUNS):
            dense_keys.assign_star(spark, dims.all_dims(silver.filter(run <= k).repartition(2 * k + 3)), root)
        touch(spark, f"{root}/{DONE}")
    return root


LATE_HOURS = ("2026-02-01 00:00:00", "2026-02-01 01:00:00")


def late_fetches(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two fetches of which the second is late and corrects the first.

    The first misses some old rows and has other content for some; the second brings the missing rows (far behind the
    look-back), the right content, and the usual overlap.
    """
    ts = casts.epoch_ms_to_ts("time")
    cut = overlap_cut(flat)
    number = F.col("code").cast("bigint")
    missing, wrong = number % 11 == 5, number % 13 == 0
    first = flat.filter((ts < cut) & ~missing).withColumn("title", F.when(wrong, F.lit("draft")).otherwise(F.col("title")))
    first = first.withColumn("sig", F.when(wrong, F.col("sig") + 1).otherwise(F.col("sig")))
    second = flat.filter((ts >= cut - F.make_dt_interval(F.lit(0), F.lit(fixed.INCREMENTAL_HOURS))) | missing | wrong)
    return first, second


@_serialized
def late(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The two late fetches landed in one folder, hour by hour, and drained after each landing."""
    root = _root(spark, sf_dir, "late")
    out = {"landing": f"{root}/landing", "history": f"{root}/history", "lake": f"{root}/lake"}
    if _done(spark, root):
        return out
    for batch, hour in zip(late_fetches(flat_quakes(spark, sf_dir)), LATE_HOURS):
        geojson.land(geojson.nest(batch, F.lit(hour).cast("timestamp_ntz")), out["landing"])
        incremental.append_history(spark, out["landing"], out["history"], f"{root}/_checkpoints/history")
        # each run sees its own fetch; the mode follows from the lake's state
        docs = bronze.with_batch_ts(bronze.read_documents(spark, out["landing"], for_silver=True))
        fetch = bronze.flatten(docs).filter(F.col("batch_ts") == F.lit(hour).cast("timestamp_ntz"))
        jobs.run_all(spark, fetch, out["lake"], database=f"gold_late_{dataset_tag(sf_dir)}")
    touch(spark, f"{root}/{DONE}")
    return out


@_serialized
def expired_silver(spark: SparkSession, sf_dir: str) -> str:
    """A Silver table of its own from which expired months have been removed (as of the newest event)."""
    path = f"{_root(spark, sf_dir, 'expired')}/silver"
    if not _done(spark, path):
        jobs.run_silver(flat_quakes(spark, sf_dir), path)
        newest = sinks.read_silver(spark, path).agg(F.max("event_timestamp_utc")).first()[0]
        runs.expire(spark, path, "silver", newest, EXPIRE_DAYS, dry_run=False)
        touch(spark, f"{path}/{DONE}")
    return path


EXPIRE_DAYS = 200
