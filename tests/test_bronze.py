"""Bronze documents: nest/flatten round trip, the per-document cap, path batch times."""

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry, schemas
from tremor.plans import staging
from tremor.sinks import geojson
from tremor.sources import bronze


def test_flatten_of_nest_is_identity(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    geojson.land(geojson.nest(flat, staging.fetch_hour(flat)), scratch)
    back = bronze.flatten(bronze.read_documents(spark, scratch))
    assert back.columns == schemas.BRONZE_FLAT_COLUMNS
    assert back.exceptAll(flat).count() == 0 and flat.exceptAll(back).count() == 0


def test_documents_never_exceed_the_cap(spark):
    flat = registry.bronze_flat(spark, SF_SMALL)
    one_hour = F.lit("2024-01-01 00:00:00").cast("timestamp")  # every row in one (hot) batch hour
    docs = geojson.nest(flat.repartition(3), one_hour, max_features=7)
    parsed = docs.select(F.from_json("value", schemas.BRONZE_DOCUMENT).alias("d"))
    sizes = parsed.select(F.size("d.features").alias("n"), F.col("d.metadata.count").alias("c"))
    agg = sizes.agg(F.max("n"), F.sum("n"), F.count(F.lit(1)), F.sum(F.col("n") - F.col("c"))).first()
    assert agg[0] <= 7 and agg[1] == 1000 and agg[2] >= 1000 // 7 and agg[3] == 0


def test_batch_ts_from_both_layouts(spark):
    df = spark.createDataFrame(
        [("s3://b/bronze/2024/03/05/07/raw_earthquakes.json",), ("file:/x/yyyy=2023/MM=12/dd=31/HH=23/part-0.txt",),
         ("file:/x/no/layout.json",)],
        "p string",
    )
    got = [r[0] for r in df.select(bronze.batch_ts_from_path(F.col("p")).cast("string")).collect()]
    assert got == ["2024-03-05 07:00:00", "2023-12-31 23:00:00", None]


def test_cli_jobs_end_to_end(spark, scratch):
    """Land documents, then run the two batch jobs and the stream from the command line."""
    from tremor.__main__ import main
    from tremor.plans import silver as silver_plan

    flat = registry.bronze_flat(spark, SF_SMALL)
    landing = f"{scratch}/bronze"
    geojson.land(geojson.nest(flat, staging.fetch_hour(flat)), landing)
    r = main(["bronze-to-silver", "--bronze", landing, "--silver", f"{scratch}/silver"], spark)
    assert (r["flattened_rows"], r["valid_rows"], r["latest_rows"]) == (1000, 638, 241)
    # Silver from the landed documents equals Silver from the flat rows
    written = spark.read.parquet(f"{scratch}/silver").drop("silver_processing_timestamp_utc")
    direct = silver_plan.silver(flat, with_clock=False)
    assert written.select(*direct.columns).exceptAll(direct).count() == 0
    r = main(["bronze-to-silver", "--bronze", landing, "--silver", f"{scratch}/silver", "--merge"], spark)
    assert r["status"] == "succeeded" and spark.read.parquet(f"{scratch}/silver").count() == 241
    r = main(["silver-to-gold", "--silver", f"{scratch}/silver", "--gold", f"{scratch}/gold",
              "--database", "cli_gold"], spark)
    assert r["fact_rows"] == 181 and spark.table("cli_gold.fact_earthquake_events").count() == 181
    r = main(["stream", "--bronze", landing, "--history", f"{scratch}/hist", "--checkpoint", f"{scratch}/ck"], spark)
    assert r["late_rows"] == 0 and spark.read.parquet(f"{scratch}/hist").count() == 638
    r = main(["retention", "--silver", f"{scratch}/silver", "--as-of", "2024-02-15", "--days", "30"], spark)
    assert r["rows_kept"] + r["rows_to_expire"] == 241 and r["rows_to_expire"] > 0


def test_cli_run_and_stream_variants(spark, scratch):
    from tremor.__main__ import main
    from tremor.sinks import tables

    flat = registry.bronze_flat(spark, SF_SMALL)
    landing = f"{scratch}/bronze"
    geojson.land(geojson.nest(flat, staging.fetch_hour(flat)), landing)
    r = main(["run", "--bronze", landing, "--root", f"{scratch}/lake", "--database", "cli_run"], spark)
    assert (r["status"], r["latest_rows"], r["fact_rows"], r["location"]) == ("succeeded", 241, 181, f"{scratch}/lake")
    assert tables.read_run_log(spark, f"{scratch}/lake/run_log").count() == 1
    main(["stream", "--bronze", landing, "--history", f"{scratch}/h1", "--checkpoint", f"{scratch}/c1", "--stateful"], spark)
    assert spark.read.parquet(f"{scratch}/h1").count() == 638
    main(["stream", "--bronze", landing, "--history", f"{scratch}/h2", "--checkpoint", f"{scratch}/c2",
          "--compact-into", f"{scratch}/compact", "--max-files-per-trigger", "200"], spark)
    compact = spark.read.parquet(f"{scratch}/compact")
    assert compact.count() == 241 and compact.select("event_id").distinct().count() == 241
