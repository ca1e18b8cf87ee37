"""Job runners: Bronze -> Silver, Silver -> Gold, and both with a run log.

Metrics ride along on the writes through ``DataFrame.observe``: the input
count and every rejected-rule count are gathered in the same pass that
writes Silver, so no job re-reads its input just to count it. An empty
input short-circuits (``isEmpty`` stops at the first row) and the run is
logged as skipped.

Gold is always built from the *written* Silver, so the four dimensions and
the fact never re-evaluate the Bronze lineage; dimensions are written
before the fact.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import dense_keys as dense
from ..operators import delta_rollups, integrity, month_index, quality, quarantine
from ..session import ensure_checkpoint_dir, path_exists, touch
from ..sinks import tables as sinks
from ..sources import bronze, ledger, salvage
from . import gold as gold_plan
from . import silver as silver_plan

DEFAULT_DATABASE = fixed.GOLD_DATABASE
#: folder of the key tables below the Gold folder
KEY_TABLES = "_keys"


def run_silver(flat: DataFrame, silver_path: str, dynamic: bool = False, rollups: bool = False) -> dict:
    """Write Silver from flattened Bronze; returns the observed counts.

    ``rollups``: start a log of signed deltas (``operators.delta_rollups``), which later merges keep current.
    """
    if flat.isEmpty():
        return {"status": "skipped", "flattened_rows": 0, "valid_rows": 0, "latest_rows": 0}
    obs_in = Observation("bronze_input")
    obs_latest = Observation("silver_latest")
    typed = silver_plan.select_typed(flat).observe(obs_in, *quality.reject_count_columns())
    latest = silver_plan.latest(quality.valid(typed)).observe(obs_latest, F.count(F.lit(1)).alias("rows"))
    month_index.drop(flat.sparkSession, silver_path)  # it knows other rows; the next merge builds it
    delta_rollups.drop(flat.sparkSession, silver_path)
    sinks.write_silver(silver_plan.enrich(latest), silver_path, dynamic=dynamic)
    if rollups:
        delta_rollups.rebuild(flat.sparkSession, silver_path)
    m_in, m_latest = obs_in.get, obs_latest.get
    return {
        "status": "succeeded" if m_latest["rows"] else "empty",
        "flattened_rows": m_in["input_rows"],
        "valid_rows": m_in["valid_rows"],
        "latest_rows": m_latest["rows"],
        "rejected": {k[len("rejected_"):]: v for k, v in m_in.items() if k.startswith("rejected_")},
    }


class StarViolation(RuntimeError):
    """The published star breaks a rule of ``operators.integrity``."""


def run_gold(spark: SparkSession, silver_path: str, gold_root: str, database: str = DEFAULT_DATABASE,
             drop_duplicate_events: bool = True, dense_keys: bool = False, check: bool = True) -> dict:
    """Write the four dimensions, then the fact, as external tables; then check the published star.

    ``dense_keys``: BIGINT keys from the append-only key tables below ``gold_root`` (``operators.dense_keys``) in place
    of the digests. A violated check raises ``StarViolation`` with the counts, so a run log never says "succeeded" over
    a star with orphans or duplicates.

    The fact's ``dropDuplicates(EventID)`` net stays on: a crash between a
    merge's write and the removal of an emptied month can leave an event in
    two months until the merge is repeated.
    """
    silver = sinks.read_silver(spark, silver_path)
    if silver.isEmpty():
        return {"status": "skipped", "fact_rows": 0, "dim_date_rows": 0, "dim_location_rows": 0}
    sinks.ensure_database(spark, database, f"{gold_root}/{database}.db")
    tables = gold_plan.gold(silver, drop_duplicate_events=drop_duplicate_events)
    if dense_keys:
        key_root = f"{gold_root}/{KEY_TABLES}"
        dense.assign_star(spark, tables, key_root)
        tables = dense.dense_star(spark, tables, key_root)
    observed = {}
    for name in gold_plan.TABLE_ORDER:  # dimensions first, fact last; each count rides on its write
        observed[name] = Observation(f"gold_{name}")
        df = tables[name].observe(observed[name], F.count(F.lit(1)).alias("rows"))
        sinks.write_gold_table(df, database, name, f"{gold_root}/{name}")
    rows = {name: obs.get["rows"] for name, obs in observed.items()}
    if check:
        check_star(spark, gold_root)
    return {
        "status": "succeeded",
        "fact_rows": rows["fact_earthquake_events"],
        "dim_date_rows": rows["dim_date"],
        "dim_location_rows": rows["dim_location"],
        "table_rows": rows,
    }


def check_star(spark: SparkSession, gold_root: str) -> None:
    """Raise ``StarViolation`` unless the written star passes every check (one pass over its key columns)."""
    star = {name: spark.read.parquet(f"{gold_root}/{name}") for name in gold_plan.TABLE_ORDER}
    report = integrity.star_integrity(star[gold_plan.TABLE_ORDER[-1]], star)
    broken = {r["check"]: r["violations"] for r in report.filter("violations > 0").collect()}
    if broken:
        raise StarViolation(f"star at {gold_root}: {broken}")


def run_mode(spark: SparkSession, root: str) -> str:
    """Incremental once Silver has partitions and the run log holds a backfill that loaded rows, else backfill."""
    log = f"{root}/run_log"
    if not sinks.path_has_table(spark, f"{root}/silver/earthquakes_cleaned") or not path_exists(spark, log):
        return "backfill"
    done = spark.range(1).select(sinks.backfill_done(sinks.read_run_log(spark, log))).first()[0]
    return "incremental" if done else "backfill"


def run_all(spark: SparkSession, flat: DataFrame, root: str, database: str = DEFAULT_DATABASE,
            mode: str | None = None, run_id: str | None = None, dense_keys: bool = False,
            rollups: bool = False, keep_rejected: bool = False) -> dict:
    """Silver then Gold under ``root``; one run-log row per run (skipped and failed runs included).

    ``keep_rejected``: rows that fail a quality rule go to ``root``/quarantine (``operators.quarantine``) in the pass
    that parses Bronze, and the Silver plan reads the others from there.

    The mode follows from the lake's state unless given: a backfill rebuilds Silver, an incremental run merges its
    rows into it.
    """
    record = {"run_id": run_id or uuid.uuid4().hex, "job": "bronze_to_gold", "location": root}
    record |= dict.fromkeys(("flattened_rows", "valid_rows", "latest_rows", "fact_rows", "dim_date_rows", "dim_location_rows"), 0)
    record["started_at"] = dt.datetime.now(dt.timezone.utc)
    t0 = time.monotonic()
    try:
        record["mode"] = mode = mode or run_mode(spark, root)
        silver_path = f"{root}/silver/earthquakes_cleaned"
        kept = None
        if keep_rejected:
            rejects = Observation("quarantine")
            flat = flat.observe(rejects, F.count(F.lit(1)).alias("rows"))
            flat, kept = quarantine.fan_out(flat, f"{root}/quarantine", record["run_id"])
        if mode == "incremental" and sinks.path_has_table(spark, silver_path):
            s = merge_silver(spark, flat, silver_path)
        else:
            s = run_silver(flat, silver_path, rollups=rollups)
        g = run_gold(spark, silver_path, f"{root}/gold", database, dense_keys=dense_keys) if s["status"] == "succeeded" else {}
        if kept:
            quarantine.settle(spark, kept)
            s["flattened_rows"] = rejects.get["rows"]
        record |= {k: v for k, v in {**s, **g}.items() if k in record}
        record["status"] = g.get("status", s["status"])
    except Exception:
        record["status"] = "failed"
        raise
    finally:
        record.setdefault("status", "failed")
        record.setdefault("mode", mode)
        record["finished_at"] = dt.datetime.now(dt.timezone.utc)
        record["duration_ms"] = int((time.monotonic() - t0) * 1000)
        sinks.append_run_log(spark, f"{root}/run_log", record)
    return record


def run_landed(spark: SparkSession, bronze_path: str, root: str, database: str = DEFAULT_DATABASE,
               mode: str | None = None, lookback_hours: int = fixed.INCREMENTAL_HOURS, dense_keys: bool = False,
               rollups: bool = False, keep_rejected: bool = False, salvaged: bool = False) -> dict:
    """``run_all`` over landed Bronze, reading no more of it than the mode asks for.

    ``salvaged``: the intact features of broken documents are loaded too (``sources.salvage``).

    A backfill reads every folder. An incremental run reads the folders that the ledger under ``root`` does not hold
    and the last 48 hours; all others are neither listed nor opened. What was read is noted after the tables are
    written, so the folders of a failed run are read again.
    """
    mode = mode or run_mode(spark, root)
    ledger_path = f"{root}/bronze_ledger"
    read_documents = salvage.read_documents if salvaged else bronze.read_documents
    if mode == "incremental":
        window = ledger.pending(spark, bronze_path, ledger_path, lookback_hours)
        flat, new = ledger.read_window(spark, window, for_silver=True, read=read_documents), window.unread
        read = window.folders()
    else:
        known = ledger.seen(spark, ledger_path)
        read = ledger.landed(spark, bronze_path)
        new = [f for f in read if f.key not in known]
        flat = bronze.flatten(bronze.with_batch_ts(read_documents(spark, bronze_path, for_silver=True)))
    result = run_all(spark, flat, root, database, mode=mode, dense_keys=dense_keys, rollups=rollups, keep_rejected=keep_rejected)
    ledger.record(spark, ledger_path, new, result["run_id"])
    return result | {"folders_read": len(read), "folders_new": len(new)}


PENDING = "_pending"
#: size of Silver from which a merge builds the key-to-month index; below it, reading all event ids is cheaper
INDEX_FROM_BYTES = 1 << 30


def _apply_pending(spark: SparkSession, silver_path: str, folder: str) -> None:
    """Write the months of a prepared merge and drop those it emptied; may be repeated any number of times."""
    rows = spark.read.schema(sinks.SILVER_SCHEMA).parquet(f"{folder}/rows")
    sinks.write_silver(rows, silver_path, dynamic=True)
    for _, v in sinks.partition_folders(spark, f"{folder}/emptied", sinks.SILVER_PARTITIONS):
        sinks.drop_partition(spark, silver_path, v["year"], v["month"])
    if path_exists(spark, f"{folder}/deltas"):
        changes = spark.read.schema(delta_rollups.LOG_SCHEMA).parquet(f"{folder}/deltas")
        delta_rollups.append(spark, silver_path, changes, folder.rpartition("/")[2])
    sinks.delete_folder(spark, folder)


def recover_merges(spark: SparkSession, silver_path: str) -> int:
    """Finish merges that were prepared but not (wholly) written; half-prepared ones are removed. Returns how many."""
    done = 0
    for folder in sinks.glob_folders(spark, f"{silver_path}/{PENDING}/*"):
        if path_exists(spark, f"{folder}/ready"):
            _apply_pending(spark, silver_path, folder)
            done += 1
        else:
            sinks.delete_folder(spark, folder)
    return done


def merge_silver(spark: SparkSession, batch_flat: DataFrame, silver_path: str, use_index: bool | None = None,
                 rules=quality.rules) -> dict:
    """Upsert one batch of flattened Bronze into a partitioned Silver table.

    The batch is typed, validated and reduced to its latest revisions once (checkpointed in the shared checkpoint
    dir). Only the affected months are rewritten: the months of those rows plus the months where their events live
    now (a revision can move an event to another month). The key-to-month index (``operators.month_index``) names the
    months in which these events may live, and only their event_id columns are read; without it all of them are.
    An index is built once the table measures ``INDEX_FROM_BYTES`` and kept from then on; ``use_index`` asks for it, or
    drops it. The affected partitions are unioned with the batch, reduced to the latest revision per event and
    written back with dynamic partition overwrite; all other partitions stay untouched. Silver keeps each row's
    ``batch_ts``, so the result does not depend on the order in which batches arrive.

    Where a log of signed deltas exists, the rows that the batch replaces and those it brings are added to it.

    The merged rows and the list of months that become empty are first prepared in a folder beside the table and
    marked ready; then the months are written, emptied ones dropped and the folder removed. A run that is lost in
    between leaves the folder, and the next merge finishes it before its own, whatever its batch holds.
    """
    from .. import schemas

    if batch_flat.isEmpty():
        return {"status": "skipped", "months": 0, "flattened_rows": 0, "valid_rows": 0, "latest_rows": 0}
    ensure_checkpoint_dir(spark)
    recover_merges(spark, silver_path)
    cols = [*schemas.SILVER_SELECTED_COLUMNS, silver_plan.BATCH_TS]
    typed = silver_plan.select_typed(batch_flat)
    if silver_plan.BATCH_TS not in typed.columns:
        typed = typed.withColumn(silver_plan.BATCH_TS, F.lit(None).cast("timestamp_ntz"))
    obs = Observation("merge_input")
    typed = typed.observe(obs, *quality.reject_count_columns(rules))
    incoming = silver_plan.latest(quality.valid(typed, rules)).select(*cols).checkpoint()
    counts = {"flattened_rows": obs.get["input_rows"], "valid_rows": obs.get["valid_rows"]}
    current = sinks.read_silver(spark, silver_path)
    month_of = [F.year("event_timestamp_utc").alias("year"), F.month("event_timestamp_utc").alias("month")]
    # at most one entry per calendar month of the table and the batch
    own = {(r.year, r.month) for r in incoming.select(*month_of).distinct().collect()}
    if not own:
        return {"status": "empty", "months": 0, "latest_rows": 0, "months_searched": 0, **counts}
    month_number = F.col("year") * 12 + F.col("month")
    there = {(v["year"], v["month"]) for _, v in sinks.partition_folders(spark, silver_path, sinks.SILVER_PARTITIONS)}
    shards = month_index.shard_count(spark, silver_path)
    if use_index is None:
        use_index = shards is not None or sinks.folder_bytes(spark, silver_path) >= INDEX_FROM_BYTES
    if not use_index:
        month_index.drop(spark, silver_path)  # it would not learn of this merge
    if use_index:
        shards = shards or month_index.build(spark, silver_path)
        searched = month_index.candidate_months(spark, silver_path, incoming.select("event_id"), shards) - own
    else:
        searched = there - own  # the batch's own months are rewritten anyway
    touched = own
    if searched:
        old = current.filter(month_number.isin(*[y * 12 + m for y, m in searched]))
        old = old.join(incoming.select("event_id"), "event_id", "left_semi").select("year", "month")
        touched = own | {(r.year, r.month) for r in old.distinct().collect()}
    affected = current.filter(month_number.isin(*[y * 12 + m for y, m in touched]))
    obs_latest = Observation("merge_latest")
    merged = silver_plan.latest(affected.select(*cols).unionByName(incoming))
    merged = silver_plan.enrich(merged).observe(
        obs_latest, F.count(F.lit(1)).alias("rows"), F.collect_set(month_number).alias("months")
    )
    folder = f"{silver_path}/{PENDING}/{uuid.uuid4().hex}"
    merged.select(*sinks.SILVER_COLUMNS).write.parquet(f"{folder}/rows")
    written = set(obs_latest.get["months"])
    for y, m in sorted(touched & there):
        if y * 12 + m not in written:
            touch(spark, f"{folder}/emptied/year={y}/month={m}/gone")
    ready = spark.read.schema(sinks.SILVER_SCHEMA).parquet(f"{folder}/rows")
    if delta_rollups.generation(spark, silver_path) is not None:
        mine = incoming.select("event_id")
        gone, come = (rows.join(mine, "event_id", "left_semi") for rows in (affected, ready))
        delta_rollups.deltas(gone, come).write.parquet(f"{folder}/deltas")
    if use_index:
        held = affected.select("event_id", "year", "month").unionByName(ready.select("event_id", "year", "month"))
        month_index.update(spark, silver_path, held, shards)
    touch(spark, f"{folder}/ready")
    _apply_pending(spark, silver_path, folder)
    if use_index and month_index.outgrown(spark, silver_path):
        month_index.drop(spark, silver_path)
    return {
        "status": "succeeded", "months": len(touched), "latest_rows": obs_latest.get["rows"],
        "months_searched": len(searched), **counts,
    }
