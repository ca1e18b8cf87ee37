"""Extract windows and the request page cap."""

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.plans import runs
from tremor.sources import bronze


def test_window_mode_follows_table_state(spark):
    rows = registry.selected(spark, SF_SMALL)
    as_of = runs.as_of_latest(rows, "event_timestamp_utc")
    empty = rows.limit(0)
    full = registry.silver_rows(spark, SF_SMALL)
    backfill = rows.filter(F.col("event_timestamp_utc") >= bronze.window_start(as_of, empty.exists()))
    incremental = rows.filter(F.col("event_timestamp_utc") >= bronze.window_start(as_of, full.exists()))
    span = backfill.agg(F.max("event_timestamp_utc") - F.min("event_timestamp_utc")).first()[0]
    assert 300 * 86400 < span.total_seconds() <= 365 * 86400
    n_inc = incremental.count()
    assert 0 < n_inc < backfill.count() < rows.count()
    span = incremental.agg(F.max("event_timestamp_utc") - F.min("event_timestamp_utc")).first()[0]
    assert span.total_seconds() <= 48 * 3600
    assert rows.select(bronze.window_mode(empty.exists())).first()[0] == "backfill"
    assert rows.select(bronze.window_mode(full.exists())).first()[0] == "incremental"


def test_bounded_extract_is_a_stable_newest_first_page(spark):
    rows = registry.selected(spark, SF_SMALL)
    end = runs.as_of_latest(rows, "event_timestamp_utc")
    start = end - F.make_dt_interval(F.lit(365))
    a = bronze.bounded_extract(rows.repartition(5), start, end, limit=25).collect()
    b = bronze.bounded_extract(rows.repartition(2), start, end, limit=25).collect()
    assert len(a) == 25 and a == b
    ts = [r.event_timestamp_utc for r in a]
    assert ts == sorted(ts, reverse=True) and all(r.magnitude >= 2.5 for r in a)
    cutoff = ts[-1]
    newer = rows.filter((F.col("magnitude") >= 2.5) & (F.col("event_timestamp_utc") > cutoff)).count()
    assert newer <= 25


def test_pages_hold_every_row_once(spark):
    rows = registry.selected(spark, SF_SMALL)
    end = runs.as_of_latest(rows, "event_timestamp_utc")
    start = end - F.make_dt_interval(F.lit(365))
    pages = bronze.extract_pages(rows, start, end, page_size=7)
    got = pages.orderBy("page", "page_row").collect()
    assert [(r.page, r.page_row) for r in got] == [divmod(k, 7) for k in range(len(got))] and len(got) > 7
    whole = bronze.bounded_extract(rows, start, end, limit=10**6).collect()
    assert [tuple(r)[:-2] for r in got] == [tuple(r) for r in whole]


def test_expire_removes_only_whole_expired_months(spark, scratch):
    import datetime as dt

    from tremor.plans import jobs
    from tremor.sinks import tables

    path = f"{scratch}/silver"
    jobs.run_silver(registry.bronze_flat(spark, SF_SMALL), path)
    before = tables.read_silver(spark, path).count()
    as_of = dt.datetime(2025, 6, 15)
    listed = runs.expire(spark, path, "silver", as_of, 100)
    assert listed and tables.read_silver(spark, path).count() == before  # dry run
    assert runs.expire(spark, path, "silver", as_of, 100, dry_run=False) == listed
    oldest = tables.read_silver(spark, path).agg(F.min("event_timestamp_utc")).first()[0]
    assert dt.datetime(2025, 3, 1) <= oldest and not runs.expire(spark, path, "silver", as_of, 100)


def test_document_counts_notice_broken_documents(spark, scratch):
    spark.createDataFrame([('{"metadata":{"count":2},"features":[{"id":"a"},{"id":"b"}]}',), ("{broken",)], "value string").write.text(scratch)
    row = bronze.document_counts(bronze.read_documents(spark, scratch)).first()
    assert tuple(row) == (2, 1, 2, 2)


def test_retain_agrees_with_retention_summary(spark):
    from tremor.session import table

    orders = table(spark, SF_SMALL, "orders")
    as_of = runs.as_of_latest(orders, "o_orderdate")
    summary = {r.layer: (r.rows_kept, r.rows_expired) for r in runs.retention_summary(orders, "o_orderdate", as_of).collect()}
    total = orders.count()
    for layer, days in runs.RETENTION_DAYS.items():
        kept = runs.retain(orders, "o_orderdate", days, as_of).count()
        assert summary[layer] == (kept, total - kept)
    assert summary["bronze"][0] <= summary["silver"][0] <= summary["gold"][0]


def test_expire_gold_removes_whole_expired_days(spark, scratch):
    import datetime as dt

    from tremor.operators import integrity
    from tremor.plans import gold as gold_plan
    from tremor.plans import jobs

    jobs.run_silver(registry.bronze_flat(spark, SF_SMALL), f"{scratch}/silver")
    jobs.run_gold(spark, f"{scratch}/silver", f"{scratch}/gold", "expire_gold")
    facts = spark.table("expire_gold.fact_earthquake_events")
    as_of, before = dt.datetime(2025, 6, 15, 12), facts.count()
    old = facts.filter("DateKey < 20250307").count()  # 100 days before: 7 March, noon
    assert 0 < old < before
    counted = runs.expire_gold(spark, f"{scratch}/gold", "expire_gold", as_of, 100)
    assert counted == {"rows_expired": old, "rows_kept": before - old} and facts.count() == before  # dry run
    runs.expire_gold(spark, f"{scratch}/gold", "expire_gold", as_of, 100, dry_run=False)
    spark.catalog.refreshTable("expire_gold.fact_earthquake_events")
    left = spark.table("expire_gold.fact_earthquake_events")
    assert left.count() == before - old and left.filter("DateKey < 20250307").count() == 0
    star = {n: spark.read.parquet(f"{scratch}/gold/{n}") for n in gold_plan.TABLE_ORDER}
    assert integrity.star_integrity(star["fact_earthquake_events"], star).filter("violations > 0").count() == 0
    assert runs.expire_gold(spark, f"{scratch}/gold", "expire_gold", as_of, 100)["rows_expired"] == 0
