"""Physical-plan properties the design relies on at scale."""

import pytest

import __spark_entry__ as entry
from testdata_dirs import SF_SMALL

NAMES = sorted(entry.queries())


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedup_limits_before_the_shuffle(spark):
    text = plan_text(entry.queries()["silver_events"](spark, SF_SMALL))
    assert text.count("Exchange hashpartitioning(event_id") == 1
    below = text.split("Exchange hashpartitioning(event_id", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_fact_is_one_shuffle(spark):
    text = plan_text(entry.queries()["fact_events"](spark, SF_SMALL))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_rollups_aggregate_before_shuffling(spark):
    for name in ("gold_by_region", "gold_by_month", "gold_by_weekday", "gold_by_magnitude"):
        text = plan_text(entry.queries()[name](spark, SF_SMALL))
        first_exchange = text.index("Exchange")
        assert "partial_" in text[first_exchange:], name
        assert "FileScan parquet" in text


def test_scans_are_pruned(spark):
    text = formatted(entry.queries()["fact_events"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text
    text = formatted(entry.queries()["gold_by_region"](spark, SF_SMALL))
    assert "ReadSchema: struct<LocationKey:string,Magnitude:double,DepthKm:double,TsunamiWarning:boolean>" in text


def test_star_integrity_scans_each_table_once(spark):
    """One scan per table and two shuffles, however many checks there are."""
    text = plan_text(entry.queries()["star_integrity"](spark, SF_SMALL))
    assert text.count("Scan parquet") == 5 and text.count("Exchange") <= 2 * 2


def test_merge_runs_few_jobs(spark, scratch):
    """A one-row merge: the batch is parsed once and Silver's ids are scanned once."""
    from pyspark.sql import functions as F

    from tremor import registry
    from tremor.plans import jobs

    flat = registry.bronze_flat(spark, SF_SMALL)
    jobs.run_silver(flat, f"{scratch}/silver")
    group = "merge-jobs"
    spark.sparkContext.setJobGroup(group, group)
    jobs.merge_silver(spark, flat.filter(F.col("mag") > 2).limit(1), f"{scratch}/silver")
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert n <= 14
