"""Run-level operators: the empty-input gate and retention by layer.

The job runners (``run_silver``/``run_gold``) live in ``tremor.plans.jobs``.
"""

from __future__ import annotations

import calendar
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..session import scratch_dir

RETENTION_DAYS = fixed.RETENTION_DAYS


def gate_status(records: Column) -> Column:
    """0 rows -> skip the downstream jobs, >0 -> process, anything else is unexpected."""
    return F.when(records == 0, "skipped").when(records > 0, "processed").otherwise("unexpected")


def gate(batch: DataFrame, name: str) -> DataFrame:
    """One row ``(batch, status, records)`` computed by an aggregate over the batch."""
    counted = batch.agg(F.count(F.lit(1)).alias("records"))
    return counted.select(F.lit(name).alias("batch"), gate_status(F.col("records")).alias("status"), F.col("records"))


def as_of_latest(df: DataFrame, ts: str) -> Column:
    """Scalar subquery: the newest timestamp of ``df`` (stays inside the plan)."""
    return df.agg(F.max(ts)).scalar()


def retain(df: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Rows younger than ``days`` at ``as_of`` (pushed down as a range filter)."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(F.lit(days)))


def expire(spark: SparkSession, path: str, layer: str, as_of: dt.datetime, days: int | None = None, dry_run: bool = True) -> list[str]:
    """Folders of a layer whose whole time span is older than its retention; deleted unless ``dry_run``.

    Silver expires by month partition, Bronze by landing hour. A partition goes only when its newest possible row
    has expired, so no row younger than the retention is ever lost.
    """
    from ..sinks import tables

    cutoff = as_of - dt.timedelta(days=RETENTION_DAYS[layer] if days is None else days)
    keys = ["yyyy", "MM", "dd", "HH"] if layer == "bronze" else ["year", "month"]
    old = []
    for folder, v in tables.partition_folders(spark, path, keys):
        if layer == "bronze":
            end = dt.datetime(v["yyyy"], v["MM"], v["dd"], v["HH"]) + dt.timedelta(hours=1)
        else:
            last = calendar.monthrange(v["year"], v["month"])[1]
            end = dt.datetime(v["year"], v["month"], last) + dt.timedelta(days=1)
        if end <= cutoff:
            old.append(folder)
    if not dry_run:
        for folder in old:
            tables.delete_folder(spark, folder)
    return sorted(old)


def expire_gold(spark: SparkSession, gold_root: str, database: str, as_of: dt.datetime, days: int | None = None,
                dry_run: bool = True) -> dict:
    """Fact rows whose day has expired; removed from the published table unless ``dry_run``.

    Gold has no month folders, so the rows that stay are written to the shared scratch folder and from there over the
    table; a run lost in between leaves that copy (``kept_at``). Dimensions keep their rows, so no key loses its row.
    """
    from ..sinks import tables

    path = f"{gold_root}/{fixed.FACT_TABLE}"
    cutoff = as_of - dt.timedelta(days=RETENTION_DAYS["gold"] if days is None else days)
    first = cutoff.date()  # a day goes only when all of it has expired
    key = first.year * 10000 + first.month * 100 + first.day
    facts = spark.read.parquet(path)
    old = F.coalesce(F.col("DateKey") < key, F.lit(False))
    counted = facts.agg(F.count_if(old).alias("expired"), F.count_if(~old).alias("kept")).first()
    result = {"rows_expired": counted["expired"], "rows_kept": counted["kept"]}
    if not dry_run and counted["expired"]:
        copy = scratch_dir(spark, "expire_gold", uuid.uuid4().hex)
        facts.filter(~old).write.parquet(copy)
        result["kept_at"] = copy
        kept = spark.read.schema(facts.schema).parquet(copy)
        tables.write_gold_table(kept, database, fixed.FACT_TABLE, path)
        tables.delete_folder(spark, copy)
    return result


def retention_summary(df: DataFrame, ts: str, as_of: Column, days_by_layer: dict[str, int] | None = None) -> DataFrame:
    """Rows kept and expired under each layer's retention, in one pass."""
    days_by_layer = days_by_layer or RETENTION_DAYS
    aggs = []
    for layer, days in days_by_layer.items():
        kept = F.col(ts) >= as_of - F.make_dt_interval(F.lit(days))
        aggs.append(F.count_if(kept).alias(f"{layer}_kept"))
        aggs.append(F.count_if(~kept).alias(f"{layer}_expired"))
    counted = df.agg(*aggs)
    pieces = ", ".join(f"'{layer}', {days}, {layer}_kept, {layer}_expired" for layer, days in days_by_layer.items())
    return counted.selectExpr(
        f"stack({len(days_by_layer)}, {pieces}) as (layer, retention_days, rows_kept, rows_expired)"
    )
