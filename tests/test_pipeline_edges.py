"""Bronze-shaped edge rows through the whole Silver plan (literal expectations)."""

from pyspark.sql import functions as F

from tremor import schemas
from tremor.plans import silver as silver_plan

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def flat_rows(spark, rows):
    """rows: dicts with any subset of flat Bronze columns; the rest are null."""
    cols = schemas.BRONZE_FLAT_COLUMNS
    types = {n: t.simpleString() for n, t in schemas.PROPERTY_FIELDS}
    types.update({"id": "string", "longitude": "double", "latitude": "double", "depth": "double"})
    ddl = ", ".join(f"`{c}` {types[c]}" for c in cols)
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, ddl)


def base(**kw):
    r = {"id": "e1", "mag": 4.0, "time": T0, "updated": T0, "longitude": 10.0, "latitude": 10.0, "depth": 10.0,
         "place": "5 km N of A, B", "type": "earthquake", "magType": "mb"}
    r.update(kw)
    return r


def test_ties_in_updated_are_deterministic_under_any_layout(spark):
    rows = [base(id="e1", mag=2.0 + i / 10, updated=T0 + 1000) for i in range(6)]
    flat = flat_rows(spark, rows)
    outs = set()
    for n in (1, 3, 7):
        got = silver_plan.silver(flat.repartition(n), with_clock=False).select("magnitude").collect()
        assert len(got) == 1
        outs.add(got[0][0])
    assert len(outs) == 1


def test_null_updated_loses_to_non_null(spark):
    flat = flat_rows(spark, [base(mag=2.0, updated=None), base(mag=3.0, updated=T0)])
    got = silver_plan.silver(flat, with_clock=False).select("magnitude").collect()
    assert [r[0] for r in got] == [3.0]


def test_newest_invalid_revision_lets_older_valid_survive(spark):
    flat = flat_rows(spark, [base(mag=11.0, updated=T0 + 5000), base(mag=3.0, updated=T0)])
    got = silver_plan.silver(flat, with_clock=False).select("magnitude").collect()
    assert [r[0] for r in got] == [3.0]


def write_docs(spark, path, docs):
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("overwrite").text(path)


def test_two_element_coordinates_rejected_without_error(spark, scratch):
    from tremor.sources import bronze

    doc = ('{"type":"FeatureCollection","features":[{"id":"e2","properties":{"mag":3.5,"time":1704067200000,'
           '"updated":1704067200000},"geometry":{"type":"Point","coordinates":[10.0,20.0]}}]}')
    write_docs(spark, f"{scratch}/2024/01/01/00", [doc])
    flat = bronze.flatten(bronze.with_batch_ts(bronze.read_documents(spark, scratch)))
    row = flat.first()
    assert row.longitude == 10.0 and row.latitude == 20.0 and row.depth is None
    assert str(row.batch_ts) == "2024-01-01 00:00:00"
    assert silver_plan.silver(flat, with_clock=False).count() == 0


def test_empty_feature_arrays_give_no_rows_and_skip_the_run(spark, scratch):
    from tremor.plans import jobs
    from tremor.sources import bronze

    write_docs(spark, f"{scratch}/landing/2024/01/01/00", ['{"type":"FeatureCollection","features":[]}'])
    write_docs(spark, f"{scratch}/landing/2024/01/01/01", ['{"type":"FeatureCollection","metadata":{"status":200}}'])
    flat = bronze.flatten(bronze.read_documents(spark, f"{scratch}/landing"))
    assert flat.count() == 0
    result = jobs.run_all(spark, flat, f"{scratch}/lake")
    assert result["status"] == "skipped" and result["flattened_rows"] == 0 and result["fact_rows"] == 0


def test_huge_sig_becomes_null_significance(spark):
    flat = flat_rows(spark, [base(sig=3_000_000_000)])
    assert silver_plan.silver(flat, with_clock=False).select("significance").first()[0] is None


def test_event_just_before_midnight_keeps_its_utc_day(spark):
    from tremor.functions import casts

    flat = flat_rows(spark, [base(time=T0 - 1, updated=T0)])
    s = silver_plan.silver(flat, with_clock=False)
    row = s.select("year", "month", "day", "hour", casts.date_key("event_timestamp_utc").alias("k")).first()
    assert (row.year, row.month, row.day, row.hour, row.k) == (2023, 12, 31, 23, 20231231)


def test_merge_moves_event_and_drops_emptied_month(spark, scratch):
    from tremor.plans import jobs
    from tremor.sinks import tables

    feb = T0 + 31 * 86400000
    path = f"{scratch}/silver"
    jobs.run_silver(flat_rows(spark, [base(id="e1", time=T0, updated=T0), base(id="e2", time=feb, updated=feb)]), path)
    assert {(r.year, r.month) for r in tables.read_silver(spark, path).select("year", "month").collect()} == {(2024, 1), (2024, 2)}
    jobs.merge_silver(spark, flat_rows(spark, [base(id="e1", mag=5.5, time=feb + 1000, updated=feb + 5000)]), path)
    got = tables.read_silver(spark, path)
    rows = sorted((r.event_id, r.month, r.magnitude) for r in got.collect())
    assert rows == [("e1", 2, 5.5), ("e2", 2, 4.0)]
    # an older revision arriving later does not win
    jobs.merge_silver(spark, flat_rows(spark, [base(id="e2", mag=9.0, time=feb, updated=feb - 1)]), path)
    rows = sorted((r.event_id, r.magnitude) for r in tables.read_silver(spark, path).collect())
    assert rows == [("e1", 5.5), ("e2", 4.0)]


def test_backfill_marker_switches_extract_mode(spark, scratch):
    from tremor.plans import jobs
    from tremor.sinks import tables
    from tremor.sources import bronze

    root = f"{scratch}/lake"
    jobs.run_all(spark, flat_rows(spark, []), root, mode="backfill")  # empty: skipped, no marker
    log = tables.read_run_log(spark, f"{root}/run_log")
    one = spark.range(1)
    assert one.select(bronze.window_mode(tables.backfill_done(log))).first()[0] == "backfill"
    jobs.run_all(spark, flat_rows(spark, [base()]), root, mode="backfill")
    log = tables.read_run_log(spark, f"{root}/run_log")
    assert one.select(bronze.window_mode(tables.backfill_done(log))).first()[0] == "incremental"
    rows = sorted((r.status, r.flattened_rows, r.fact_rows) for r in log.collect())
    assert rows == [("skipped", 0, 0), ("succeeded", 1, 1)]


def test_silver_of_renested_silver_is_silver(spark):
    from testdata_dirs import SF_SMALL
    from tremor import registry
    from tremor.functions import casts

    s = registry.silver_rows(spark, SF_SMALL)
    back = s.select(
        F.col("event_id").alias("id"), F.col("magnitude").alias("mag"), "place",
        casts.ts_to_epoch_ms("event_timestamp_utc").alias("time"),
        casts.ts_to_epoch_ms("updated_timestamp_utc").alias("updated"), "url",
        F.col("felt_reports").cast("bigint").alias("felt"),
        F.lit(None).cast("double").alias("cdi"), F.lit(None).cast("double").alias("mmi"), "alert", "status",
        F.when(F.col("tsunami_warning"), 1).when(~F.col("tsunami_warning"), 0).cast("bigint").alias("tsunami"),
        F.col("significance").cast("bigint").alias("sig"), F.lit(None).cast("string").alias("net"),
        F.lit(None).cast("string").alias("code"), F.col("nst_stations").cast("bigint").alias("nst"),
        F.lit(None).cast("double").alias("dmin"), F.col("rms_travel_time").alias("rms"),
        F.col("gap_azimuthal").alias("gap"), "magType", F.col("event_type").alias("type"), "title",
        "longitude", "latitude", F.col("depth_km").alias("depth"),
    )
    again = silver_plan.silver(back, with_clock=False)
    assert again.exceptAll(s).count() == 0 and s.exceptAll(again).count() == 0


def test_tie_survivors_match_the_sql_oracle(spark):
    """Adversarial ties in `updated`: Spark and the DuckDB oracle keep the same row."""
    import duckdb

    from tremor import oracle

    rows = []
    for i in range(40):
        rows.append(base(id=f"t{i % 5}", mag=[2.0, 3.5, None, 2.0][i % 4], place=[None, "b, c", "a"][i % 3],
                         updated=T0 + (i % 2) * 1000, time=T0 - i, depth=[10.0, 5.0][i % 2], nst=i % 3))
    flat = flat_rows(spark, rows)
    got = sorted(map(tuple, silver_plan.latest(silver_plan.quality.valid(silver_plan.select_typed(flat))).collect()))
    con = duckdb.connect()
    con.register("bronze_df", flat.toPandas())
    sql = oracle.sql("select * from latest", "latest").replace(
        oracle.BLOCKS["bronze"][1], "\nselect * from bronze_df"
    )
    want = sorted(map(tuple, con.sql(sql).fetchall()))
    assert len(got) == 5 and got == want


def test_run_of_only_rejected_rows_leaves_a_readable_lake(spark, scratch):
    from tremor.plans import jobs
    from tremor.sinks import tables

    root = f"{scratch}/lake"
    bad = flat_rows(spark, [base(mag=11.0), base(id="e2", mag=None)])
    assert jobs.run_all(spark, bad, root, database="gold_rejected")["status"] == "empty"
    assert tables.read_silver(spark, f"{root}/silver/earthquakes_cleaned").count() == 0
    assert jobs.run_gold(spark, f"{root}/silver/earthquakes_cleaned", f"{root}/gold", "gold_rejected")["status"] == "skipped"
    assert jobs.run_all(spark, flat_rows(spark, [base()]), root, database="gold_rejected")["status"] == "succeeded"


def test_incremental_run_keeps_earlier_events(spark, scratch):
    from tremor.plans import jobs
    from tremor.sinks import tables

    root = f"{scratch}/lake"
    first = jobs.run_all(spark, flat_rows(spark, [base(id="a"), base(id="b")]), root, database="gold_inc")
    second = jobs.run_all(spark, flat_rows(spark, [base(id="c")]), root, database="gold_inc")
    assert (first["mode"], second["mode"]) == ("backfill", "incremental")
    ids = {r.event_id for r in tables.read_silver(spark, f"{root}/silver/earthquakes_cleaned").collect()}
    assert ids == {"a", "b", "c"} and second["fact_rows"] == 3


def test_failed_run_is_logged(spark, scratch):
    import pytest

    from tremor.plans import jobs
    from tremor.sinks import tables

    broken = flat_rows(spark, [base()]).withColumn("mag", F.raise_error(F.lit("no data")).cast("double"))
    with pytest.raises(Exception, match="no data"):
        jobs.run_all(spark, broken, f"{scratch}/lake", database="gold_failed")
    row = tables.read_run_log(spark, f"{scratch}/lake/run_log").first()
    assert row.status == "failed" and abs((row.finished_at - row.started_at).total_seconds()) < 600


def test_merge_result_does_not_depend_on_arrival_order(spark, scratch):
    from tremor.plans import jobs
    from tremor.sinks import tables

    batches = [
        flat_rows(spark, [base(mag=m)]).withColumn("batch_ts", F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz"))
        for m, d in ((4.0, 1), (5.0, 2))
    ]
    for k, order in enumerate((batches, batches[::-1])):
        path = f"{scratch}/silver{k}"
        jobs.run_silver(order[0], path)
        jobs.merge_silver(spark, order[1], path)
        assert [r.magnitude for r in tables.read_silver(spark, path).collect()] == [5.0]


def test_landing_an_hour_keeps_the_others(spark, scratch):
    from tremor.sinks import geojson
    from tremor.sources import bronze

    flat = flat_rows(spark, [base(id=f"e{k}") for k in range(5)])
    for hour, ids in (("00", ["e0", "e1"]), ("01", ["e2"]), ("00", ["e3"])):
        part = flat.filter(F.col("id").isin(ids))
        geojson.land(geojson.nest(part, F.lit(f"2024-01-01 {hour}:00:00").cast("timestamp_ntz")), scratch)
    got = bronze.flatten(bronze.read_documents(spark, scratch))
    assert sorted(r.id for r in got.collect()) == ["e2", "e3"]


def test_documents_hold_every_feature_once_and_never_too_many(spark):
    from tremor.sinks import geojson

    flat = flat_rows(spark, [base(id=f"e{k}", time=T0 + k) for k in range(100)])
    docs = geojson.nest(flat, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), max_features=7)
    sizes = docs.select(F.get_json_object("value", "$.metadata.count").cast("int").alias("n"), "value").collect()
    assert sum(r.n for r in sizes) == 100 and max(r.n for r in sizes) <= 7
    again = geojson.nest(flat.repartition(5), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), max_features=7)
    assert {r.value for r in again.collect()} == {r.value for r in sizes}


def test_copies_of_one_feature_do_not_gather_in_one_bucket(spark):
    from tremor.sinks import geojson

    flat = flat_rows(spark, [base(id="hot", longitude=-0.0)] * 200 + [base(id=f"e{k}") for k in range(40)])
    docs = geojson.nest(flat, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), max_features=20).persist()
    features = docs.select("_bucket", F.explode(F.from_json("value", schemas.BRONZE_DOCUMENT)["features"]).alias("f"))
    got = features.groupBy("_bucket").agg(F.count("*").alias("n"), F.count_if(F.col("f.id") == "hot").alias("hot")).collect()
    assert sum(r.n for r in got) == 240 and sum(r.hot for r in got) == 200
    assert max(r.n for r in got) <= 40 and len(got) > 12
    signs = features.filter("f.id = 'hot'").select(F.col("f.geometry.coordinates")[0].cast("string").alias("x")).distinct()
    assert [r.x for r in signs.collect()] == ["-0.0"]
    docs.unpersist()


def test_keys_tell_close_places_and_separators_apart(spark):
    from tremor.functions import keys

    rows = [(10.0000001, 1.0, "a"), (10.0000002, 1.0, "a"), (0.0, 1.0, "a"), (-0.0, 1.0, "a"), (1.0, 1.0, "x|1:y"), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, place string").withColumn("k", keys.location_key())
    assert df.select("k").distinct().count() == 5
    pairs = spark.createDataFrame([("x|v:y", "z"), ("x", "y|v:z"), ("x|1:y", "z"), ("x", "y|1:z")], "event_type string, magType string")
    assert pairs.select(keys.event_type_key().alias("k")).distinct().count() == 4
