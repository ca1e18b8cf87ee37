"""Dense BIGINT keys: stable over runs and partitionings, and the star built on them."""

import pytest
from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import dense_keys, integrity
from tremor.plans import gold as gold_plan
from tremor.plans import jobs
from tremor.sinks import tables


def naturals(spark, values):
    return spark.createDataFrame([(v,) for v in values], "natural string")


def keys_of(spark, path):
    rows = dense_keys.read_keys(spark, path).collect()
    assert len({r.natural for r in rows}) == len({r.key for r in rows}) == len(rows)
    return {r.natural: r.key for r in rows}


def test_keys_are_dense_ordered_and_never_change(spark, scratch):
    seen = {}
    for k, values in enumerate((["b", "d", "b"], ["a", "b"], [], ["e", "c", "a"])):
        added = dense_keys.assign(spark, naturals(spark, values), scratch)
        now = keys_of(spark, scratch)
        assert added == len(now) - len(seen) and all(now[n] == key for n, key in seen.items())
        fresh = sorted(set(now) - set(seen))
        assert [now[n] for n in fresh] == list(range(len(seen), len(now)))
        seen = now
    assert seen == {"b": 0, "d": 1, "a": 2, "c": 3, "e": 4}


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_do_not_depend_on_the_partitioning(spark, scratch, partitions):
    values = [f"{k * 7919 % 1000:04d}" for k in range(1000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        dense_keys.assign(spark, naturals(spark, values).repartition(partitions), scratch)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert keys_of(spark, scratch) == {f"{k:04d}": k for k in range(1000)}


def test_gold_with_dense_keys_is_the_same_star(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    jobs.run_silver(flat, f"{scratch}/silver")
    jobs.run_gold(spark, f"{scratch}/silver", f"{scratch}/digest", "dense_a")
    first = None
    for _ in range(2):  # a second run keeps all keys
        jobs.run_gold(spark, f"{scratch}/silver", f"{scratch}/dense", "dense_b", dense_keys=True)
        star = {n: spark.read.parquet(f"{scratch}/dense/{n}") for n in gold_plan.TABLE_ORDER}
        keys = {r.EventID: (r.LocationKey, r.EventTypeKey, r.MagnitudeKey) for r in star["fact_earthquake_events"].collect()}
        assert first in (None, keys)
        first = keys
    fact = star["fact_earthquake_events"]
    assert {fact.schema[c].dataType.simpleString() for c in dense_keys.DENSE_DIMENSIONS.values()} == {"bigint"}
    assert integrity.star_integrity(fact, star).filter("violations > 0").count() == 0

    def flat_star(root):
        t = {n: spark.read.parquet(f"{scratch}/{root}/{n}") for n in gold_plan.TABLE_ORDER}
        out = t["fact_earthquake_events"]
        for name, key in dense_keys.DENSE_DIMENSIONS.items():
            out = out.join(t[name], key).drop(key)
        return out.drop("SilverProcessingTimestampUTC", "DWLoadTimestampUTC")

    a, b = flat_star("digest"), flat_star("dense")
    b = b.select(*a.columns)
    assert a.count() == 181 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_job_refuses_a_broken_star(spark, scratch, monkeypatch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    whole = gold_plan.gold

    def without_some_locations(silver, **more):
        out = whole(silver, **more)
        out["dim_location"] = out["dim_location"].filter(F.col("latitude") > 0)
        return out

    monkeypatch.setattr(gold_plan, "gold", without_some_locations)
    with pytest.raises(jobs.StarViolation, match="fact_LocationKey_orphans"):
        jobs.run_all(spark, flat, f"{scratch}/lake", database="broken_star")
    log = tables.read_run_log(spark, f"{scratch}/lake/run_log").collect()
    assert [r.status for r in log] == ["failed"]
