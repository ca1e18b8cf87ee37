"""Size-aware landing, the ledger of read folders, and the incremental run's pruned read."""

import datetime as dt

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry, schemas
from tremor.plans import jobs, staging
from tremor.plans import silver as silver_plan
from tremor.sinks import geojson, packs, tables
from tremor.sources import bronze, ledger


def flat_small(spark):
    return registry.bronze_flat(spark, SF_SMALL)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def read_back(spark, path):
    return bronze.flatten(bronze.with_batch_ts(bronze.read_documents(spark, path)))


def with_hour(flat):
    return flat.withColumn("batch_ts", staging.fetch_hour(flat))


def files(spark, path):
    return set(spark.read.option("recursiveFileLookup", "true").text(path).inputFiles())


def test_rows_come_back_with_their_hours(spark, scratch):
    flat = flat_small(spark)
    got = packs.land_packed(flat, staging.fetch_hour(flat), scratch, target_bytes=60_000)
    assert got["packs"] > 3 and got["hours"] == flat.select(staging.fetch_hour(flat)).distinct().count()
    back = read_back(spark, scratch)
    assert back.columns == [*schemas.BRONZE_FLAT_COLUMNS, "batch_ts"]
    assert same(back, with_hour(flat))


def test_files_follow_bytes_not_hours(spark, scratch):
    flat = flat_small(spark)
    got = packs.land_packed(flat, staging.fetch_hour(flat), scratch, target_bytes=60_000)
    sizes = {}
    for folder, _, _ in packs.packs(spark, scratch).values():
        lines = spark.read.text(folder).select(F.sum(F.octet_length("value"))).first()[0]
        sizes[folder] = lines
        assert len(files(spark, folder)) == 1
    assert len(sizes) <= got["packs"] < got["hours"] / 5
    assert max(sizes.values()) < 3 * 60_000  # features, plus the heads of some dozens of small documents


def test_one_large_hour_fills_several_packs(spark, scratch):
    flat = flat_small(spark)
    hour = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    packs.land_packed(flat, hour, scratch, target_bytes=60_000, max_features=20)
    assert len(packs.packs(spark, scratch)) > 3
    docs = bronze.read_documents(spark, scratch)
    assert docs.agg(F.max(F.size("features"))).first()[0] <= 20
    assert same(bronze.flatten(docs), flat)


def test_replacing_an_hour_leaves_the_others(spark, scratch):
    flat = with_hour(flat_small(spark))
    packs.land_packed(flat.drop("batch_ts"), staging.fetch_hour(flat), scratch, target_bytes=60_000)
    before = files(spark, scratch)
    hour = flat.groupBy("batch_ts").count().orderBy(F.desc("count"), "batch_ts").first()["batch_ts"]
    mine = F.col("batch_ts") == F.lit(hour)
    changed = flat.filter(mine).withColumn("title", F.lit("corrected")).drop("batch_ts")
    got = packs.land_packed(changed, staging.fetch_hour(changed), scratch, target_bytes=60_000)
    assert got["replaced_packs"] == 1
    assert len(before - files(spark, scratch)) == 1  # one file went
    expected = flat.withColumn("title", F.when(mine, F.lit("corrected")).otherwise(F.col("title")))
    assert same(read_back(spark, scratch), expected)


def test_landing_the_same_hours_again_changes_nothing(spark, scratch):
    flat = flat_small(spark)
    for _ in range(3):
        packs.land_packed(flat, staging.fetch_hour(flat), scratch, target_bytes=60_000)
    assert same(read_back(spark, scratch), with_hour(flat))


def test_copies_of_one_feature_and_rows_without_a_time(spark, scratch):
    flat = flat_small(spark)
    copies = flat.limit(1).withColumn("id", F.lit("q")).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("_k")
    timeless = flat.limit(7).withColumn("time", F.lit(None).cast("bigint"))
    rows = flat.unionByName(copies).unionByName(timeless)
    packs.land_packed(rows, staging.fetch_hour(rows), scratch, target_bytes=60_000, max_features=40)
    docs = bronze.read_documents(spark, scratch)
    assert docs.agg(F.max(F.size("features"))).first()[0] <= 40
    assert same(read_back(spark, scratch), with_hour(rows))


def test_empty_landing(spark, scratch):
    flat = flat_small(spark)
    assert packs.land_packed(flat.limit(0), staging.fetch_hour(flat), scratch)["packs"] == 0
    assert packs.packs(spark, scratch) == {}


def test_incremental_run_reads_unseen_hours_and_the_look_back_only(spark, scratch):
    """20 months landed; a second landing brings scattered late hours and corrects nothing else."""
    flat = flat_small(spark)
    root, landing = f"{scratch}/lake", f"{scratch}/bronze"
    late = staging.lands_late(flat)
    on_time = flat.filter(~late)
    packs.land_packed(on_time, staging.fetch_hour(on_time), landing, target_bytes=30_000)
    first = jobs.run_landed(spark, landing, root, database="ledger_test")
    assert first["mode"] == "backfill" and first["folders_new"] == len(packs.packs(spark, landing))
    assert (spark.read.text(f"{landing}/*/*/*").select("value").count()) > 0

    # nothing new: only the folders that reach into the last 48 hours
    window = ledger.pending(spark, landing, f"{root}/bronze_ledger")
    assert not window.unread and 1 <= len(window.recent) <= 3
    read = ledger.read_window(spark, window)
    newest = with_hour(on_time).agg(F.max("batch_ts")).first()[0]
    assert read.agg(F.min("batch_ts")).first()[0] > newest - dt.timedelta(hours=48)
    assert len(read.inputFiles()) == len(window.recent) < len(files(spark, landing)) / 3

    late_rows = flat.filter(late)
    packs.land_packed(late_rows, staging.fetch_hour(late_rows), landing, target_bytes=30_000)
    window = ledger.pending(spark, landing, f"{root}/bronze_ledger")
    assert len(ledger.read_window(spark, window).inputFiles()) == len(window.folders()) < len(files(spark, landing)) / 3
    second = jobs.run_landed(spark, landing, root, database="ledger_test")
    assert second["mode"] == "incremental" and second["folders_new"] == len(window.unread)
    silver = tables.read_silver(spark, f"{root}/silver/earthquakes_cleaned")
    direct = silver_plan.silver(flat, with_clock=False)
    assert same(silver.select(*direct.columns), direct)


def test_failed_run_leaves_its_folders_unread(spark, scratch, monkeypatch):
    flat = flat_small(spark)
    root, landing = f"{scratch}/lake", f"{scratch}/bronze"
    packs.land_packed(flat, staging.fetch_hour(flat), landing)

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs, "run_gold", broken)
        try:
            jobs.run_landed(spark, landing, root, database="ledger_failed")
        except RuntimeError:
            pass
    assert len(ledger.pending(spark, landing, f"{root}/bronze_ledger").unread) == len(packs.packs(spark, landing))


def test_documents_moved_from_a_read_pack_count_as_read(spark, scratch):
    flat = with_hour(flat_small(spark))
    landing, noted = f"{scratch}/bronze", f"{scratch}/ledger"
    packs.land_packed(flat.drop("batch_ts"), staging.fetch_hour(flat), landing, target_bytes=60_000)
    ledger.record(spark, noted, ledger.landed(spark, landing), "r1")
    hours = [r["batch_ts"] for r in flat.select("batch_ts").distinct().orderBy("batch_ts").limit(2).collect()]
    for hour in hours:  # the same pack twice: what is moved twice is still known
        part = flat.filter(F.col("batch_ts") == F.lit(hour)).drop("batch_ts")
        packs.land_packed(part, staging.fetch_hour(part), landing, target_bytes=60_000)
    unread = ledger.pending(spark, landing, noted).unread
    assert sorted(f.first for f in unread) == hours and all(f.first == f.last for f in unread)
    assert same(read_back(spark, landing), flat)


def test_hourly_folders_of_both_layouts_are_listed(spark, scratch):
    flat = flat_small(spark)
    geojson.land(geojson.nest(flat, F.lit("2024-03-05 07:00:00").cast("timestamp_ntz")), f"{scratch}/a")
    spark.createDataFrame([('{"features":[]}',)], "value string").write.text(f"{scratch}/a/2024/03/06/08")
    found = {f.key: f.first for f in ledger.landed(spark, f"{scratch}/a")}
    assert found == {"2024/03/05/07": dt.datetime(2024, 3, 5, 7), "2024/03/06/08": dt.datetime(2024, 3, 6, 8)}
    assert ledger.landed(spark, f"{scratch}/nothing") == []
