"""Size-aware landing: documents of many hours packed into few files.

``geojson.land`` writes one file per landing hour, which suits a fetch that brings one hour. A backfill brings thousands of
hours of a few kilobytes each; as single files they cost a listing, an open and a commit apiece. ``land_packed`` packs
hours into files by their measured bytes:

1. One pass sums rows and JSON bytes per hour (and finds features with very many copies). The hours in order of time
   form a line of bytes; prefix sums give each hour its place on it, and a document goes to the pack in which its start
   falls. So packs hold about ``target_bytes``, a pack holds consecutive hours, and an hour larger than a pack fills
   several.
2. One exchange, by pack, brings each pack's features together; documents of at most ``max_features`` features are
   built inside it as in ``geojson.nest``, and each task writes one file per pack.

A pack's folder is ``from=<first hour>/to=<last hour>/id=<token>`` (hours as yyyyMMddHH, 0000000000 for rows without a
time). Its hours are also listed in a small table beside the packs, ``_packs``. A document carries its own hour as
``metadata.generated``, which the Bronze scan takes as the batch time of packed documents.

Landing hours again replaces them: the packs that hold some of these hours are read, their other documents move to a
pack of their own (token ``<new>~<token it comes from>``, so that a reader's ledger knows them), and the old packs go
after the write has committed. All other packs stay untouched. A crash before the old packs are gone leaves both
states; landing the same hours again mends that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed
from ..session import scratch_dir
from . import geojson, tables

PACK_KEYS = ["from", "to", "id"]
PACK_BYTES = 128 << 20
SMALLEST_PACK = 4 << 20
NO_HOUR = "0000000000"
#: hours up to which the plan of hours is broadcast to the tasks that deal features (a row takes about 50 bytes)
BROADCAST_HOURS = 200_000
MANIFEST = "_packs"
MANIFEST_SCHEMA = "id string, hour string"
GENERATED = r'^\{"type":"FeatureCollection","metadata":\{"generated":(-?\d+)'


def hour_text(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "yyyyMMddHH"), F.lit(NO_HOUR))


def _place_hours(hours: DataFrame) -> DataFrame:
    """Adds ``start`` (bytes of all earlier hours) and ``buckets``; summed per day first, so windows stay small."""
    day = F.substring("hour", 1, 8)
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("day").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    dated = hours.withColumn("day", day)
    days = dated.groupBy("day").agg(F.sum("bytes").alias("day_bytes"))
    days = days.select("day", F.coalesce(F.sum("day_bytes").over(earlier), F.lit(0)).alias("before_day"))
    placed = dated.withColumn("in_day", F.coalesce(F.sum("bytes").over(within), F.lit(0))).join(days, "day")
    return placed.withColumn("start", F.col("before_day") + F.col("in_day")).drop("day", "in_day", "before_day")


def _pack_of(start: Column, size: Column, bucket: Column, buckets: Column, pack_bytes: int) -> Column:
    """Pack in which a bucket's first byte falls when an hour's buckets follow one another."""
    return F.floor((start + F.floor(size * bucket / buckets)) / F.lit(pack_bytes)).cast("bigint")


def _documents(dealt: DataFrame, max_features: int) -> DataFrame:
    """(pack, hour, value) of documents from (pack, hour, generated, bucket, feature, n)."""
    keys = ["pack", "hour", "generated", "bucket"]
    grouped = dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("feature", "n"))).alias("runs"))
    copies = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["feature"], r["n"])))
    parts = F.sequence(F.lit(0), F.floor((F.size("all") - 1) / F.lit(max_features)).cast("int"))
    chunk = F.explode(parts).alias("chunk")
    cut = grouped.select(*keys, copies.alias("all")).select("pack", "hour", "generated", "all", chunk)
    features = F.slice("all", F.col("chunk") * max_features + 1, max_features)
    cut = cut.select("pack", "hour", "generated", features.alias("features"))
    return cut.select("pack", "hour", geojson.document("generated", "features").alias("value"))


def land_packed(flat: DataFrame, batch_ts: Column, path: str, target_bytes: int = PACK_BYTES,
                max_features: int = fixed.MAX_FEATURES_PER_DOCUMENT) -> dict:
    """Land flattened rows as packed documents; returns how many packs and hours were written and packs replaced."""
    from ..functions import casts

    spark = flat.sparkSession
    landing = uuid.uuid4().hex[:16]
    run = max(1, max_features // geojson.RUNS_PER_DOCUMENT)
    keyed = flat.select(
        hour_text(batch_ts).alias("hour"), casts.ts_to_epoch_ms(batch_ts).alias("generated"),
        F.to_json(geojson.feature_struct()).alias("feature"),
    )
    hashed = keyed.withColumn("hash", F.xxhash64("feature"))
    counted = hashed.groupBy("hour", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("feature") + 1).alias("bytes")
    )
    hours = counted.groupBy("hour").agg(
        F.sum("n").alias("rows"), F.sum("bytes").alias("bytes"),
        F.collect_list(F.when(F.col("n") > run, F.col("hash"))).alias("crowded"),
    )
    hours = hours.withColumn("buckets", F.ceil(2 * F.col("rows") / F.lit(max_features)))
    plan_path = scratch_dir(spark, "landing", landing)
    hours.write.parquet(plan_path)
    hours = spark.read.schema(hours.schema).parquet(plan_path)
    total = hours.agg(F.sum("bytes"), F.count(F.lit(1)), F.max(F.size("crowded"))).first()
    if not total[1]:
        return {"packs": 0, "hours": 0, "replaced_packs": 0}
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pack_bytes = min(target_bytes, max(SMALLEST_PACK, -(-total[0] // parallel)))
    n_packs = total[0] // pack_bytes + 1
    placed = _place_hours(hours)
    spans = _pack_spans(placed, pack_bytes)
    token = F.concat(F.lit(f"{landing}."), F.col("pack").cast("string"))
    spans.select(token.alias("id"), "hour").write.mode("append").parquet(f"{path}/{MANIFEST}")

    few = total[1] <= BROADCAST_HOURS
    by_hour = F.broadcast(placed) if few else placed
    rows = hashed.join(by_hour.drop("rows"), "hour")
    pack = lambda bucket: _pack_of(F.col("start"), F.col("bytes"), bucket, F.col("buckets"), pack_bytes)
    bucket = F.pmod(F.col("hash"), F.col("buckets"))
    hot = F.array_contains("crowded", F.col("hash"))
    dealt = rows.filter(~hot).select(
        pack(bucket).alias("pack"), "hour", "generated", bucket.alias("bucket"), "feature", F.lit(1).alias("n")
    )
    if total[2]:  # features with very many copies: counted, the copies dealt in runs
        keys = ["hour", "generated", "feature", "start", "bytes", "buckets"]
        copies = rows.filter(hot).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(run).cast("bigint"))).alias("first")
        runs = copies.select(*keys, "copies", first)
        bucket = F.pmod(F.xxhash64("feature", "first"), F.col("buckets"))
        dealt = dealt.unionByName(runs.select(
            pack(bucket).alias("pack"), "hour", "generated", bucket.alias("bucket"), "feature",
            F.least(F.col("copies") - F.col("first"), F.lit(run)).cast("int").alias("n"),
        ))
    docs = _documents(dealt.repartition(min(n_packs, max(parallel, 1) * 64), "pack"), max_features)
    ends = spans.groupBy("pack").agg(F.min("hour").alias("from"), F.max("hour").alias("to"))
    ends = F.broadcast(ends) if n_packs <= BROADCAST_HOURS else ends
    out = docs.join(ends, "pack").select("from", "to", token.alias("id"), "value")
    replaced, carried = _carried(spark, path, hours, landing)
    if carried is not None:
        out = out.unionByName(carried)
    out.write.mode("append").partitionBy(*PACK_KEYS).text(path)
    for folder in replaced:
        tables.delete_folder(spark, folder)
    tables.delete_folder(spark, plan_path)
    return {"packs": n_packs, "hours": total[1], "replaced_packs": len(replaced)}


def _pack_spans(placed: DataFrame, pack_bytes: int) -> DataFrame:
    """(pack, hour): the packs that an hour's buckets may fall into."""
    first = _pack_of(F.col("start"), F.col("bytes"), F.lit(0), F.lit(1), pack_bytes)
    last = _pack_of(F.col("start"), F.col("bytes"), F.col("buckets") - 1, F.col("buckets"), pack_bytes)
    return placed.select(F.explode(F.sequence(first, last)).alias("pack"), "hour")


def packs(spark: SparkSession, path: str) -> dict[str, tuple[str, str, str]]:
    """Token -> (folder, first hour, last hour) of the packs below ``path``."""
    return {v["id"]: (folder, v["from"], v["to"]) for folder, v in tables.list_folders(spark, path, PACK_KEYS)}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}")


def _carried(spark: SparkSession, path: str, hours: DataFrame, landing: str) -> tuple[list[str], DataFrame | None]:
    """Folders of the packs that hold some of ``hours``, and their documents of other hours as new packs."""
    there = packs(spark, path)
    if not there:
        return [], None
    touched = read_manifest(spark, path).join(hours.select("hour"), "hour", "left_semi").select("id").distinct()
    old = [r["id"] for r in touched.collect() if r["id"] in there]  # packs, not documents
    if not old:
        return [], None
    folders = [there[t][0] for t in old]
    docs = spark.read.option("recursiveFileLookup", "true").text(folders).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/id=([^/]+)/", 1).alias("old"), document_hour("value").alias("hour"), "value"
    )
    rest = docs.join(hours.select("hour"), "hour", "left_anti")
    origin = F.element_at(F.split("old", "~"), -1)
    token = F.concat(F.lit(f"{landing}-"), F.substring(F.md5("old"), 1, 12), F.lit("~"), origin)
    spans = rest.groupBy("old").agg(F.min("hour").alias("from"), F.max("hour").alias("to"))
    rest.select(token.alias("id"), "hour").distinct().write.mode("append").parquet(f"{path}/{MANIFEST}")
    moved = rest.join(F.broadcast(spans) if len(old) <= BROADCAST_HOURS else spans, "old")
    return folders, moved.select("from", "to", token.alias("id"), "value")


def document_hour(value: Column | str) -> Column:
    """Hour of a landed document's text, from its head."""
    from ..functions import casts

    ms = F.regexp_extract(value, GENERATED, 1)
    return hour_text(F.when(ms != "", casts.epoch_ms_to_ts(ms.cast("bigint"))))
