"""Incremental processing: overlap removal, late data, stream == batch."""

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry, schemas
from tremor.functions import casts
from tremor.operators import quality
from tremor.plans import silver as silver_plan
from tremor.plans import staging
from tremor.sinks import geojson, packs
from tremor.streaming import incremental


import pytest


@pytest.mark.parametrize("variant", ["batched", "stateful"])
def test_late_rows_are_counted_and_kept(spark, scratch, variant):
    """Rows far behind the look-back: kept by the merge form, dropped (and reported) by the state-store form."""
    flat = registry.bronze_flat(spark, SF_SMALL)
    before, _ = staging.fetches(flat)
    ts = casts.ts_to_epoch_ms(casts.epoch_ms_to_ts("time"))
    newest = before.agg(F.max(ts)).first()[0]
    old = (ts < newest - 5 * 86400 * 1000) & (F.col("code").cast("int") % 3 == 0)
    landing, hist, ckpt = f"{scratch}/landing", f"{scratch}/history", f"{scratch}/ckpt"
    run = incremental.append_history if variant == "batched" else incremental.append_history_stateful
    first = before.filter(~old)
    geojson.land(geojson.nest(first, staging.fetch_hour(first)), f"{landing}/fetch=0")
    run(spark, landing, hist, ckpt)
    n_first = spark.read.parquet(hist).count()
    recent = first.filter(ts >= newest - 3600 * 1000)  # re-sent, still on time
    late = before.filter(old)
    assert late.count() > 0 and recent.count() > 0
    again = late.unionByName(recent)
    geojson.land(geojson.nest(again, staging.fetch_hour(again)), f"{landing}/fetch=1")
    q = run(spark, landing, hist, ckpt)
    if variant == "stateful":
        assert incremental.rows_dropped_by_watermark(q) > 0
        assert spark.read.parquet(hist).count() == n_first
        return
    assert incremental.late_rows(spark, hist) == late.count()
    valid = quality.valid(silver_plan.select_typed(before))
    kept = incremental.read_history(spark, hist).select(*schemas.SILVER_SELECTED_COLUMNS)
    assert kept.exceptAll(valid).count() == 0 and valid.exceptAll(kept).count() == 0


def test_replay_after_a_lost_log_row_appends_nothing(spark, scratch):
    """A crash between the append and the log row: the batch comes again and must not double the history."""
    flat = registry.bronze_flat(spark, SF_SMALL).limit(200)
    incremental.merge_micro_batch(flat, 0, f"{scratch}/a")
    n = incremental.read_history(spark, f"{scratch}/a").count()
    incremental.read_history(spark, f"{scratch}/a").write.partitionBy("event_date").parquet(f"{scratch}/b")  # no log
    incremental.merge_micro_batch(flat, 0, f"{scratch}/b")
    assert n > 0 and incremental.read_history(spark, f"{scratch}/b").count() == n


def test_newer_content_of_a_key_wins(spark, scratch):
    """The same (id, updated, time) re-sent with other content, also back to the first content."""
    one = registry.bronze_flat(spark, SF_SMALL).filter("mag between 1 and 5 and depth between 1 and 500").limit(1)
    for k, mag in enumerate([4.0, 5.0, 5.0, 4.0]):
        batch = one.withColumn("mag", F.lit(mag)).withColumn("batch_ts", F.lit(f"2026-01-01 0{k}:00:00").cast("timestamp_ntz"))
        batch = batch.withColumn("latitude", F.lit(1.5)).withColumn("longitude", F.lit(2.5))
        incremental.merge_micro_batch(batch.unionByName(batch), k, f"{scratch}/history")
        latest = incremental.latest_from_history(incremental.read_history(spark, f"{scratch}/history"))
        assert [r.magnitude for r in latest.collect()] == [mag]
    assert incremental.read_history(spark, f"{scratch}/history").count() == 3


def test_hot_copies_collapse_in_one_batch(spark, scratch):
    """A revision re-sent many times in one batch is kept once (batch-mode dedup)."""
    flat = registry.bronze_flat(spark, SF_SMALL).limit(5)
    copies = flat
    for _ in range(6):
        copies = copies.unionByName(copies)  # 64 copies of each row
    incremental.merge_micro_batch(copies.repartition(7), 0, f"{scratch}/history")
    hist = spark.read.parquet(f"{scratch}/history")
    valid = registry.q_dq_valid(spark, SF_SMALL).join(flat.select(F.col("id").alias("event_id")).distinct(), "event_id")
    assert hist.count() == hist.select(*incremental.STATIC_KEYS).distinct().count()
    # replaying the same batch id changes nothing
    incremental.merge_micro_batch(copies, 0, f"{scratch}/history")
    assert spark.read.parquet(f"{scratch}/history").count() == hist.count()


def test_stream_latest_equals_batch(spark):
    out = staging.streamed(spark, SF_SMALL)
    hist = spark.read.parquet(out["history"])
    latest = incremental.latest_from_history(hist, with_clock=False)
    batch = registry.silver_rows(spark, SF_SMALL)
    latest = latest.drop("batch_ts")
    cols = [c for c in batch.columns]
    assert latest.select(*cols).exceptAll(batch).count() == 0
    assert batch.exceptAll(latest.select(*cols)).count() == 0
    # exact re-fetches of the overlap are gone; every valid revision is kept once
    valid = registry.q_dq_valid(spark, SF_SMALL)
    assert hist.select(*schemas.SILVER_SELECTED_COLUMNS).exceptAll(valid).count() == 0
    assert hist.count() == valid.count()
    raw = spark.read.parquet(out["raw"]).count()
    assert raw > registry.bronze_flat(spark, SF_SMALL).count()


def test_bounded_micro_batches_process_every_row_once(spark, scratch):
    """Many small micro-batches: each valid row is appended once, also those that come late."""
    flat = registry.bronze_flat(spark, SF_SMALL)
    landing, hist = f"{scratch}/landing", f"{scratch}/history"
    geojson.land(geojson.nest(flat, staging.fetch_hour(flat)), landing)
    incremental.append_history(spark, landing, hist, f"{scratch}/ckpt", max_files_per_trigger=60)
    log = incremental.batch_log(spark, hist)
    hours = flat.select(staging.fetch_hour(flat)).distinct().count()  # one landed file per hour
    assert log.count() == -(-hours // 60)
    assert log.agg(F.sum("input_rows")).first()[0] == 1000
    h = spark.read.parquet(hist)
    valid = registry.q_dq_valid(spark, SF_SMALL)
    assert h.count() == h.select(*incremental.STATIC_KEYS).distinct().count()
    kept = h.select(*schemas.SILVER_SELECTED_COLUMNS)
    assert kept.exceptAll(valid).count() == 0 and valid.exceptAll(kept).count() == 0


def test_history_of_only_invalid_rows_reads_empty(spark, scratch):
    from pyspark.sql import functions as F

    bad = registry.bronze_flat(spark, SF_SMALL).limit(5).withColumn("mag", F.lit(99.0))
    incremental.merge_micro_batch(bad, 0, f"{scratch}/history")
    h = incremental.read_history(spark, f"{scratch}/history")
    assert h.count() == 0 and "event_date" in h.columns
    assert incremental.batch_log(spark, f"{scratch}/history").first().appended_rows == 0


def test_new_checkpoint_on_an_existing_history_loses_nothing(spark, scratch):
    """The second half arrives under a new checkpoint, whose batches count from 0 again."""
    from tremor.operators import quality
    from tremor.plans import silver as silver_plan

    flat = registry.bronze_flat(spark, SF_SMALL)
    half = F.col("code").cast("bigint") % 2 == 0
    history = f"{scratch}/history"
    for k, part in enumerate((flat.filter(half), flat.filter(~half), flat.filter(half))):
        geojson.land(geojson.nest(part, F.lit(f"2026-03-0{k + 1} 00:00:00").cast("timestamp_ntz")), f"{scratch}/landing{k}")
        incremental.append_history(spark, f"{scratch}/landing{k}", history, f"{scratch}/checkpoint{k}")
    log = incremental.batch_log(spark, history)
    assert log.select("query_id").distinct().count() == 3
    valid = quality.valid(silver_plan.select_typed(flat))
    got = incremental.read_history(spark, history)
    assert got.count() == valid.count() == 638
    assert got.select(*valid.columns).exceptAll(valid).count() == 0


def test_micro_batches_bounded_by_bytes(spark, scratch):
    """Packed files are drained by their size: a bound below two files gives one file per batch, and no row is lost."""
    flat = registry.bronze_flat(spark, SF_SMALL)
    landing, hist = f"{scratch}/landing", f"{scratch}/history"
    packed = packs.land_packed(flat, staging.fetch_hour(flat), landing, target_bytes=100_000)
    assert packed["packs"] > 2
    incremental.append_history(spark, landing, hist, f"{scratch}/ckpt", max_bytes_per_trigger=110_000)
    log = incremental.batch_log(spark, hist)
    assert log.count() > 2
    assert log.agg(F.sum("input_rows")).first()[0] == flat.count()


def test_streamed_fetches_are_few_files(spark):
    """A fetch of many hours lands packed: the streams list and open a few files, not one per hour."""
    out = staging.streamed(spark, SF_SMALL)
    files = spark.read.option("recursiveFileLookup", "true").text(out["landing"]).select("_metadata.file_path").distinct()
    assert 2 <= files.count() < 20


def test_history_tasks_do_not_write_every_date(spark, scratch):
    """Rows are brought together by event date before they are written, so files grow with dates, not with dates x tasks."""
    flat = registry.bronze_flat(spark, SF_SMALL)
    wide = flat.repartition(16)
    incremental.merge_micro_batch(wide, 0, f"{scratch}/history")
    h = spark.read.parquet(f"{scratch}/history")
    files = h.select("_metadata.file_path").distinct().count()
    assert files <= 2 * h.select("event_date").distinct().count()
