"""Roll-ups from signed deltas against recomputed ones."""

import pytest
from pyspark.sql import functions as F

from test_pipeline_edges import T0, base, flat_rows
from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import delta_rollups, dims, fact, rollups
from tremor.plans import jobs
from tremor.sinks import tables


def recomputed(spark, path):
    silver = tables.read_silver(spark, path)
    rows, d = fact.fact_events(silver, with_clock=False), dims.all_dims(silver)
    return {
        "region": rollups.by_region(rows, d["dim_location"]),
        "magnitude": rollups.by_magnitude(rows, d["dim_magnitude"]),
        "month": rollups.by_month(rows, d["dim_date"]),
        "weekday": rollups.by_weekday(rows, d["dim_date"]),
    }


def assert_current(spark, path):
    log = delta_rollups.read_log(spark, path)
    for name, expected in recomputed(spark, path).items():
        got = getattr(delta_rollups, f"by_{name}")(log)
        assert got.columns == expected.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str), name


def test_merges_keep_the_rollups_current(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    part = F.col("code").cast("bigint") % 8
    jobs.run_silver(flat.filter(part >= 3), scratch, rollups=True)
    assert_current(spark, scratch)
    for k in range(3):
        jobs.merge_silver(spark, flat.filter(part == k), scratch)
    assert_current(spark, scratch)
    assert delta_rollups.compact(spark, scratch) == 4
    assert delta_rollups.read_log(spark, scratch).select("merge").distinct().count() == 1
    jobs.merge_silver(spark, flat.filter(part == 0), scratch)  # a merge that changes nothing
    assert_current(spark, scratch)
    assert delta_rollups.read_log(spark, scratch).filter("merge <> 'base'").count() == 0


def test_retracted_maximum_and_emptied_group(spark, scratch):
    rows = [base(id="a", mag=7.0, place="x, P"), base(id="b", mag=5.0, place="y, P"), base(id="c", mag=6.0, place="z, Q")]
    jobs.run_silver(flat_rows(spark, rows), scratch, rollups=True)
    fixes = [base(id="a", mag=4.0, place="x, P", updated=T0 + 1), base(id="c", mag=6.0, place="z, R", updated=T0 + 1)]
    jobs.merge_silver(spark, flat_rows(spark, fixes), scratch)
    log = delta_rollups.read_log(spark, scratch)
    got = {r.extracted_country: (r.events, r.max_magnitude) for r in delta_rollups.by_region(log).collect()}
    assert got == {"P": (2, 5.0), "R": (1, 6.0)}
    assert_current(spark, scratch)


def test_only_touched_groups_are_written(spark, scratch):
    rows = [base(id=f"e{k}", place=f"x, P{k}", mag=2.0 + k / 10) for k in range(20)]
    jobs.run_silver(flat_rows(spark, rows), scratch, rollups=True)
    jobs.merge_silver(spark, flat_rows(spark, [base(id="e3", place="x, P3", mag=8.5, updated=T0 + 1)]), scratch)
    mine = delta_rollups.read_log(spark, scratch).filter("merge <> 'base' and rollup = 'region'")
    assert sorted((r.g1, r.magnitude, r.n) for r in mine.collect()) == [("P3", 2.3, -1), ("P3", 8.5, 1)]


def test_cut_off_merge_counts_once(spark, scratch, monkeypatch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    part = F.col("code").cast("bigint") % 4
    jobs.run_silver(flat.filter(part > 0), scratch, rollups=True)

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "delete_folder", lost)  # after Silver and the log were written
        with pytest.raises(RuntimeError):
            jobs.merge_silver(spark, flat.filter(part == 0), scratch)
    assert jobs.recover_merges(spark, scratch) == 1
    assert_current(spark, scratch)


def test_cut_off_compaction_leaves_a_log(spark, scratch, monkeypatch):
    jobs.run_silver(registry.bronze_flat(spark, SF_SMALL), scratch, rollups=True)

    def lost(*_, **__):
        raise RuntimeError("driver lost")

    for target in ("touch", "_sum"):
        with monkeypatch.context() as m:
            m.setattr(delta_rollups, target, lost)
            with pytest.raises(RuntimeError):
                delta_rollups.compact(spark, scratch)
        assert_current(spark, scratch)
    delta_rollups.compact(spark, scratch)
    assert_current(spark, scratch)


def test_rebuild_without_a_log_drops_the_old_one(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    jobs.run_silver(flat, scratch, rollups=True)
    jobs.run_silver(flat.limit(100), scratch)
    assert delta_rollups.generation(spark, scratch) is None
