"""Star schema: deterministic keys, both fact formulations agree, integrity holds."""

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import dims, fact, integrity, rollups


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keys_do_not_depend_on_layout(spark):
    flat = registry.bronze_flat(spark, SF_SMALL)
    from tremor.plans import silver as silver_plan

    outs = []
    for n in (1, 7):
        s = silver_plan.silver(flat.repartition(n), with_clock=False)
        outs.append(sorted_rows(dims.dim_location(s)))
        outs.append(sorted_rows(fact.fact_events(s, with_clock=False).select("EventID", "LocationKey", "EventTypeKey")))
    assert outs[0] == outs[2] and outs[1] == outs[3]


def test_key_derived_fact_equals_star_join(spark):
    s = registry.silver_rows(spark, SF_SMALL)
    d = dims.all_dims(s)
    for null_safe in (False, True):
        a = fact.fact_events(s, null_safe=null_safe, with_clock=False)
        b = fact.fact_events_joined(s, d, null_safe=null_safe, with_clock=False)
        assert sorted_rows(a) == sorted_rows(b.select(*a.columns))
    assert fact.fact_events(s, with_clock=False).count() == 181
    assert fact.fact_events(s, null_safe=True, with_clock=False).count() == 241


def test_integrity_is_clean(spark):
    s = registry.silver_rows(spark, SF_SMALL)
    d = dims.all_dims(s)
    rows = integrity.star_integrity(fact.fact_events(s, with_clock=False), d).collect()
    assert len(rows) == 9 and all(r.violations == 0 for r in rows)


def test_integrity_detects_orphans_and_duplicates(spark):
    s = registry.silver_rows(spark, SF_SMALL)
    d = dims.all_dims(s)
    f = fact.fact_events(s, with_clock=False)
    broken = dict(d)
    broken["dim_location"] = d["dim_location"].limit(1)
    broken["dim_event_type"] = d["dim_event_type"].unionByName(d["dim_event_type"])
    got = {r.check: r.violations for r in integrity.star_integrity(f.unionByName(f.limit(2)), broken).collect()}
    assert got["fact_LocationKey_orphans"] > 0
    assert got["dim_event_type_duplicate_EventTypeKey"] == 5
    assert got["fact_duplicate_EventID"] == 2


def test_dim_date_calendar(spark):
    s = registry.silver_rows(spark, SF_SMALL)
    dd = dims.dim_date(s)
    span = dims.date_span(s).first()
    assert dd.count() == (span.max_date - span.min_date).days + 1 + dims.CALENDAR_BUFFER_DAYS
    row = dd.filter(F.col("DateKey") == 20240106).first()
    assert (row.DayName, row.DayOfWeek, row.IsWeekend, row.MonthName, row.Quarter) == ("Saturday", 7, 1, "January", 1)


def test_dim_magnitude_fixed_rows(spark):
    dm = dims.dim_magnitude(spark)
    rows = dm.collect()
    assert [r.MagnitudeCategory for r in rows][-1] == "Unknown" and len(rows) == 8
    assert dm.select("MagnitudeKey").distinct().count() == 8


def test_rollups_sum_to_fact(spark):
    s = registry.silver_rows(spark, SF_SMALL)
    d = dims.all_dims(s)
    f = fact.fact_events(s, with_clock=False)
    n = f.count()
    assert rollups.by_region(f, d["dim_location"]).agg(F.sum("events")).first()[0] == n
    assert rollups.by_magnitude(f, d["dim_magnitude"]).agg(F.sum("events")).first()[0] == n
    assert rollups.by_month(f, d["dim_date"]).agg(F.sum("events")).first()[0] == n
    assert rollups.by_weekday(f, d["dim_date"]).agg(F.sum("events")).first()[0] == n
