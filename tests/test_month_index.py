"""The key-to-month index, merges through it, and merges that were cut off."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import month_index
from tremor.plans import jobs
from tremor.plans import silver as silver_plan
from tremor.sinks import tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def silver_of(spark, path, like):
    return tables.read_silver(spark, path).select(*like.columns)


def test_filters_know_their_keys():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, np.uint64)
    bits = month_index.bloom_bits(keys)
    assert month_index.bloom_hits(keys, bits).all()
    assert month_index.bloom_hits(rng.integers(0, 1 << 63, 200_000, np.uint64), bits).mean() < 1e-4
    assert not month_index.bloom_hits(keys, month_index.bloom_bits(keys[:0])).any()


@pytest.mark.parametrize("broadcast, per_filter", [(1 << 20, 1 << 16), (0, 8)])
def test_candidates_hold_every_month_of_the_keys(spark, scratch, monkeypatch, broadcast, per_filter):
    monkeypatch.setattr(month_index, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(month_index, "KEYS_PER_FILTER", per_filter)
    path = f"{scratch}/silver"
    jobs.run_silver(registry.bronze_flat(spark, SF_SMALL), path)
    shards = month_index.build(spark, path)
    assert (shards > 1) == (per_filter == 8) and month_index.shard_count(spark, path) == shards
    silver = tables.read_silver(spark, path)
    for part in range(3):
        keys = silver.filter(F.pmod(F.xxhash64("event_id"), F.lit(40)) == part).select("event_id")
        exact = {(r.year, r.month) for r in silver.join(keys, "event_id", "left_semi").select("year", "month").distinct().collect()}
        assert month_index.candidate_months(spark, path, keys, shards) == exact
    other = spark.createDataFrame([("never seen",)], "event_id string")
    assert month_index.candidate_months(spark, path, other, shards) == set()


def test_small_merges_search_few_months_and_equal_a_rebuild(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL).withColumn("_part", F.pmod(F.xxhash64("code"), F.lit(40)))
    path = f"{scratch}/silver"
    jobs.run_silver(flat.filter("_part >= 4").drop("_part"), path)
    for part in range(4):
        r = jobs.merge_silver(spark, flat.filter(F.col("_part") == part).drop("_part"), path, use_index=True)
        assert r["status"] == "succeeded" and r["months_searched"] <= r["months"] + 2
    direct = silver_plan.silver(flat.drop("_part"), with_clock=False)
    assert same(silver_of(spark, path, direct), direct)
    # the filters still hold every key of their months
    shards = month_index.shard_count(spark, path)
    silver = tables.read_silver(spark, path)
    there = {(r.year, r.month) for r in silver.select("year", "month").distinct().collect()}
    assert month_index.candidate_months(spark, path, silver.select("event_id"), shards) == there


def test_merge_without_the_index_gives_the_same_table(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    late = F.pmod(F.xxhash64("code"), F.lit(9)) == 0
    direct = silver_plan.silver(flat, with_clock=False)
    for use_index in (True, False):
        path = f"{scratch}/silver-{use_index}"
        jobs.run_silver(flat.filter(~late), path)
        jobs.merge_silver(spark, flat.filter(late), path, use_index=use_index)
        assert same(silver_of(spark, path, direct), direct)


def test_month_without_filters_is_searched(spark, scratch):
    path = f"{scratch}/silver"
    jobs.run_silver(registry.bronze_flat(spark, SF_SMALL), path)
    shards = month_index.build(spark, path)
    folder, v = tables.partition_folders(spark, month_index.index_path(path), ["year", "month"])[3]
    tables.delete_folder(spark, folder)
    none = spark.createDataFrame([], "event_id string")
    assert month_index.candidate_months(spark, path, none, shards) == {(v["year"], v["month"])}


def test_rebuild_drops_the_index_and_outgrown_filters_too(spark, scratch, monkeypatch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    path = f"{scratch}/silver"
    jobs.run_silver(flat, path)
    jobs.merge_silver(spark, flat.limit(5), path, use_index=True)
    assert month_index.shard_count(spark, path) == 1
    monkeypatch.setattr(month_index, "KEYS_PER_FILTER", 1)
    jobs.merge_silver(spark, flat.limit(5), path, use_index=True)
    assert month_index.shard_count(spark, path) is None
    jobs.merge_silver(spark, flat.limit(5), path, use_index=True)
    jobs.run_silver(flat, path)
    assert month_index.shard_count(spark, path) is None


@pytest.mark.parametrize("step", ["before_ready", "months", "drop"])
def test_next_merge_finishes_a_merge_that_was_cut_off(spark, scratch, monkeypatch, step):
    flat = registry.bronze_flat(spark, SF_SMALL)
    late = F.pmod(F.xxhash64("code"), F.lit(9)) == 0
    path = f"{scratch}/silver"
    jobs.run_silver(flat.filter(~late), path)

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    target = {"before_ready": (month_index, "update"), "months": (tables, "write_silver"), "drop": (tables, "delete_folder")}[step]
    with monkeypatch.context() as m:
        m.setattr(*target, lost)
        with pytest.raises(RuntimeError):
            jobs.merge_silver(spark, flat.filter(late), path, use_index=True)
    direct = silver_plan.silver(flat, with_clock=False)
    finished = jobs.recover_merges(spark, path)
    assert finished == (0 if step == "before_ready" else 1)
    if step == "before_ready":  # nothing was decided: the batch comes again
        jobs.merge_silver(spark, flat.filter(late), path, use_index=True)
    assert same(silver_of(spark, path, direct), direct)
    assert jobs.recover_merges(spark, path) == 0


def test_moved_event_leaves_its_old_month(spark, scratch):
    """An event whose newest revision lies in another month: the emptied month goes, also in a repeated merge."""
    flat = registry.bronze_flat(spark, SF_SMALL)
    one = flat.filter("mag is not null and mag > 1 and depth between 1 and 900 and latitude between -80 and 80 and longitude between -170 and 170").limit(1)
    path = f"{scratch}/silver"
    jobs.run_silver(one, path)
    moved = one.withColumns({"time": F.col("time") + F.lit(40 * 86_400_000), "updated": F.lit(4_000_000_000_000)})
    for _ in range(2):
        jobs.merge_silver(spark, moved, path, use_index=True)
        assert tables.read_silver(spark, path).count() == 1
        assert len(tables.partition_folders(spark, path, ["year", "month"])) == 1
