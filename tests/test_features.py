"""Hand-built edge rows with literal expectations (scalar features, casts, gate)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions import casts, features
from tremor.operators import quality


def one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", typ, True)]))


def test_place_region_and_country(spark):
    df = one_col(spark, ["5 km N of A, B, C", "Ridge", "x, ", None], T.StringType())
    out = df.select(features.region_detail("x").alias("d"), F.col("x")).select(
        "d", features.country("d", "x").alias("c")
    )
    assert [tuple(r) for r in out.collect()] == [("B, C", "B, C"), ("", "Ridge"), ("", "x,"), (None, None)]


def test_magnitude_classes_and_validity(spark):
    vals = [-2.0, 3.0, 10.0, 10.01, float("nan"), None]
    df = one_col(spark, vals, T.DoubleType())
    rule = quality.rules()["magnitude_range"]
    out = df.withColumnRenamed("x", "magnitude").select(
        features.magnitude_category("magnitude").alias("c"), F.coalesce(rule, F.lit(False)).alias("v")
    )
    rows = [tuple(r) for r in out.collect()]
    assert [r[1] for r in rows] == [True, True, True, False, False, False]
    assert [r[0] for r in rows[:3]] == ["Micro", "Minor", "Great"]


def test_magnitude_boundaries(spark):
    df = one_col(spark, [2.999, 3.0, 4.0, 5.0, 6.0, 7.0, 7.999, 8.0], T.DoubleType())
    got = [r[0] for r in df.select(features.magnitude_category("x")).collect()]
    assert got == ["Micro", "Minor", "Light", "Moderate", "Strong", "Major", "Major", "Great"]


def test_depth_classes_and_validity(spark):
    vals = [-0.1, 0.0, 70.0, 70.1, 300.0, 300.1, 999.9, 1000.0]
    df = one_col(spark, vals, T.DoubleType()).withColumnRenamed("x", "depth_km")
    rule = quality.rules()["depth_range"]
    rows = df.select(features.depth_category("depth_km"), F.coalesce(rule, F.lit(False))).collect()
    valid = [r[1] for r in rows]
    assert valid == [False, True, True, True, True, True, True, False]
    assert [r[0] for r in rows[1:7]] == ["Shallow", "Shallow", "Intermediate", "Intermediate", "Deep", "Deep"]


def test_lat_lon_bounds_inclusive(spark):
    df = spark.createDataFrame(
        [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, -180.0001)], "latitude double, longitude double"
    )
    r = quality.rules()
    got = [tuple(x) for x in df.select(r["latitude_range"], r["longitude_range"]).collect()]
    assert got == [(True, True), (True, True), (False, True), (True, False)]


def test_hemispheres(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-0.5, -0.5)], "latitude double, longitude double")
    got = [tuple(x) for x in df.select(features.hemisphere_ns(), features.hemisphere_ew()).collect()]
    assert got == [("Northern", "Eastern"), ("Southern", "Western")]


def test_int_overflow_becomes_null(spark):
    df = one_col(spark, [3_000_000_000, 5], T.LongType())
    assert [r[0] for r in df.select(casts.to_int("x")).collect()] == [None, 5]


def test_tsunami_flag(spark):
    df = one_col(spark, [1, 0, None], T.LongType())
    assert [r[0] for r in df.select(casts.flag_to_bool("x")).collect()] == [True, False, None]


def test_epoch_ms_keeps_milliseconds(spark):
    df = one_col(spark, [1700000000123], T.LongType())
    ts = df.select(casts.epoch_ms_to_ts("x")).first()[0]
    assert ts == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_date_key_is_utc_day_under_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = one_col(spark, [1704067199999], T.LongType())  # 2023-12-31 23:59:59.999 UTC
        ts = casts.epoch_ms_to_ts("x")
        row = df.select(casts.date_key(ts), ts, casts.ts_to_epoch_ms(ts)).first()
        assert tuple(row) == (20231231, dt.datetime(2023, 12, 31, 23, 59, 59, 999000), 1704067199999)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_queries_do_not_depend_on_session_zone(spark):
    from testdata_dirs import SF_SMALL
    import __spark_entry__ as entry

    names = ["silver_events", "fact_events", "dim_date", "calendar_parts", "incremental_window"]
    utc = {n: sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect())) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        for n in names:
            assert sorted(map(tuple, entry.queries()[n](spark, SF_SMALL).collect())) == utc[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_parts_sunday_is_one(spark):
    df = one_col(spark, [1704585600000], T.LongType())  # 2024-01-07 00:00 UTC, a Sunday
    parts = features.calendar_parts(casts.epoch_ms_to_ts("x"))
    row = df.select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row.year, row.month, row.day, row.hour, row.day_of_week) == (2024, 1, 7, 0, 1)


def test_reject_counts_one_pass(spark):
    rows = [
        ("a", 1.0, 10.0, 10.0, 10.0, dt.datetime(2024, 1, 1)),
        ("b", None, 10.0, 10.0, 10.0, dt.datetime(2024, 1, 1)),
        ("c", 1.0, 95.0, 10.0, -1.0, dt.datetime(2024, 1, 1)),
        (None, 1.0, 10.0, 10.0, 10.0, None),
    ]
    df = spark.createDataFrame(
        rows, "event_id string, magnitude double, latitude double, longitude double, depth_km double, event_timestamp_utc timestamp"
    )
    r = quality.reject_counts(df).first().asDict()
    assert r["input_rows"] == 4 and r["valid_rows"] == 1 and r["rejected_rows"] == 3
    assert r["rejected_magnitude_range"] == 1
    assert r["rejected_latitude_range"] == 1
    assert r["rejected_depth_range"] == 1
    assert r["rejected_time_and_id_present"] == 1


def test_public_api_is_importable():
    import tremor

    for name in tremor.__all__:
        assert callable(getattr(tremor, name)), name
