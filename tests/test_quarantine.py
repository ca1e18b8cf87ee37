"""Quarantine lanes and replay under changed rules."""

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import quality, quarantine
from tremor.plans import jobs
from tremor.plans import silver as silver_plan
from tremor.sinks import tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def wider_rules():
    """The published rules without a bound on the depth and with any magnitude that is there."""
    return quality.rules() | {"depth_range": F.col("depth_km").isNotNull(), "magnitude_range": F.col("magnitude").isNotNull()}


def test_both_lanes_together_are_the_input(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    valid, folder = quarantine.fan_out(flat, scratch, "r1")
    bad = quarantine.rejected(spark, scratch, quarantine.lane_schema(flat))
    assert valid.count() == 638 and same(valid.unionByName(bad.drop(quarantine.MASK)), flat)
    assert bad.filter(F.col(quarantine.MASK) == 0).count() == 0
    counts = quality.reject_counts(silver_plan.select_typed(flat)).first().asDict()
    for r in bad.select(F.explode(quarantine.rule_names(quarantine.MASK)).alias("n")).groupBy("n").count().collect():
        assert counts[f"rejected_{r['n']}"] == r["count"]
    quarantine.settle(spark, folder)
    assert quarantine.read_lane(spark, folder, quarantine.VALID, quarantine.lane_schema(flat)).count() == 0
    assert quarantine.rejected(spark, scratch, quarantine.lane_schema(flat)).count() == bad.count() == 362


def test_replay_equals_a_rebuild_under_the_new_rules(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    r = jobs.run_all(spark, flat, f"{scratch}/lake", database="quarantine_run", mode="backfill", keep_rejected=True)
    assert (r["flattened_rows"], r["valid_rows"], r["status"]) == (1000, 638, "succeeded")
    path, silver = f"{scratch}/lake/quarantine", f"{scratch}/lake/silver/earthquakes_cleaned"
    schema = quarantine.lane_schema(flat)
    typed = silver_plan.select_typed(flat)
    expected = silver_plan.enrich(silver_plan.latest(quality.valid(typed, wider_rules)), with_clock=False)
    still = typed.count() - quality.valid(typed, wider_rules).count()
    for _ in range(2):  # the second replay finds nothing new
        quarantine.replay(spark, path, silver, schema, wider_rules)
        got = tables.read_silver(spark, silver).select(*expected.columns)
        assert same(got, expected)
        assert quarantine.rejected(spark, path, schema).count() == still
    assert tables.glob_folders(spark, f"{path}/run=*/lane=valid") == []


def test_cut_off_replays_lose_and_double_nothing(spark, scratch, monkeypatch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    path, silver = f"{scratch}/q", f"{scratch}/silver"
    valid, folder = quarantine.fan_out(flat, path, "r1")
    jobs.run_silver(valid, silver)
    quarantine.settle(spark, folder)
    schema = quarantine.lane_schema(flat)
    still = flat.count() - quality.valid(silver_plan.select_typed(flat), wider_rules).count()

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    for target in ((jobs, "merge_silver"), (quarantine, "settle")):  # before and after the rows reach Silver
        with monkeypatch.context() as m:
            m.setattr(*target, lost)
            try:
                quarantine.replay(spark, path, silver, schema, wider_rules)
            except RuntimeError:
                pass
        quarantine.replay(spark, path, silver, schema, wider_rules)
        assert quarantine.rejected(spark, path, schema).count() == still
    expected = silver_plan.enrich(silver_plan.latest(quality.valid(silver_plan.select_typed(flat), wider_rules)), with_clock=False)
    assert same(tables.read_silver(spark, silver).select(*expected.columns), expected)


def test_nothing_rejected_and_nothing_at_all(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    good = flat.filter("mag between 0 and 10 and depth between 0 and 900 and latitude between -89 and 89 and longitude between -179 and 179")
    valid, _ = quarantine.fan_out(good, f"{scratch}/a")
    assert valid.count() == good.count() and quarantine.rejected(spark, f"{scratch}/a", quarantine.lane_schema(flat)).count() == 0
    none, _ = quarantine.fan_out(flat.limit(0), f"{scratch}/b")
    assert none.count() == 0
