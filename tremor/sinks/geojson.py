"""Raw-document landing: flattened rows -> GeoJSON FeatureCollections.

Each document holds the features of one batch hour, and never more than
``max_features`` of them (the source API's page cap). Equal features of an
hour are counted first and their copies cut into short runs; the runs are
dealt into as many hash buckets as the hour's row count asks for (one cheap
count per hour), so neither an hour nor a group of copies gathers in one task.
A bucket's features are sorted and cut into documents of at most
``max_features``; bucket and order depend on the features and their counts
alone, so a task re-run after an executor loss builds the same documents.

Documents land under ``yyyy=/MM=/dd=/HH=`` folders (one JSON document per
line), which the Bronze scan reads back with recursive lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..functions import casts

MAX_FEATURES_PER_DOCUMENT = fixed.MAX_FEATURES_PER_DOCUMENT
#: copies of one feature are dealt in runs of a document's cap over this
RUNS_PER_DOCUMENT = 8

BATCH_PARTS = ["yyyy", "MM", "dd", "HH"]


def feature_struct() -> Column:
    props = F.struct(*[F.col(n).alias(n) for n, _ in schemas.PROPERTY_FIELDS])
    geometry = F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("longitude"), F.col("latitude"), F.col("depth")).alias("coordinates"),
    )
    return F.struct(F.lit("Feature").alias("type"), F.col("id").alias("id"), props.alias("properties"), geometry.alias("geometry"))


def document(generated: Column | str, features: Column | str) -> Column:
    """A document's JSON text from its hour (epoch ms) and an array of feature texts."""
    metadata = F.struct(
        (F.col(generated) if isinstance(generated, str) else generated).alias("generated"),
        F.lit(200).cast("bigint").alias("status"),
        F.size(features).cast("bigint").alias("count"),
    )
    return F.concat(
        F.lit('{"type":"FeatureCollection","metadata":'), F.to_json(metadata), F.lit(',"features":['), F.array_join(features, ","), F.lit("]}")
    )


def nest(flat: DataFrame, batch_ts: Column, max_features: int = MAX_FEATURES_PER_DOCUMENT) -> DataFrame:
    """One row per document: ``batch_ts``, its bucket and part, and the document's JSON text.

    Rows are range-partitioned on (hour, bucket) before grouping: that exchange already satisfies the grouping, and
    each output task holds a run of consecutive hours (one file per hour it holds when landed) while a hot hour
    spreads over several tasks. The partition count is the session's shuffle parallelism, given explicitly: AQE
    would otherwise coalesce a small-in-bytes shuffle into one task that writes every hour folder in sequence.
    """
    n = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = max(1, max_features // RUNS_PER_DOCUMENT)
    per_hour = flat.groupBy(batch_ts.alias("batch_ts")).agg(F.ceil(2 * F.count(F.lit(1)) / F.lit(max_features)).alias("_buckets"))
    # counted by its text: a grouped struct would lose the sign of a zero
    keyed = flat.select(batch_ts.alias("batch_ts"), F.to_json(feature_struct()).alias("_feature"))
    counted = keyed.groupBy("batch_ts", "_feature").agg(F.count(F.lit(1)).alias("_copies"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(run).cast("bigint")))
    runs = counted.select("batch_ts", "_feature", "_copies", first.alias("_first")).alias("f")
    dealt = runs.join(per_hour.alias("h"), F.col("f.batch_ts").eqNullSafe(F.col("h.batch_ts"))).select(
        "f.batch_ts",
        F.pmod(F.xxhash64("_feature", "_first"), F.col("_buckets")).alias("_bucket"),
        "_feature",
        F.least(F.col("_copies") - F.col("_first"), F.lit(run)).cast("int").alias("_n"),
    )
    dealt = dealt.repartitionByRange(n, "batch_ts", "_bucket")
    grouped = dealt.groupBy("batch_ts", "_bucket").agg(F.sort_array(F.collect_list(F.struct("_feature", "_n"))).alias("_runs"))
    copies = F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["_feature"], r["_n"])))
    grouped = grouped.select("batch_ts", "_bucket", copies.alias("_all"))
    parts = F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / F.lit(max_features)).cast("int"))
    parted = grouped.select("batch_ts", "_bucket", "_all", F.explode(parts).alias("_chunk")).select(
        "batch_ts", "_bucket", "_chunk", F.slice("_all", F.col("_chunk") * max_features + 1, max_features).alias("features")
    )
    value = document(casts.ts_to_epoch_ms("batch_ts"), "features")
    return parted.select("batch_ts", "_bucket", "_chunk", value.alias("value"))


def batch_folders(batch_ts: Column) -> dict[str, Column]:
    """Zero-padded yyyy/MM/dd/HH strings of the batch time."""
    return {
        "yyyy": F.date_format(batch_ts, "yyyy"),
        "MM": F.date_format(batch_ts, "MM"),
        "dd": F.date_format(batch_ts, "dd"),
        "HH": F.date_format(batch_ts, "HH"),
    }


def land(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write documents (as laid out by ``nest``) as JSON lines under hourly folders.

    ``overwrite`` replaces the hours that the documents hold; all other landed hours stay.
    """
    out = docs.select(*[c.alias(n) for n, c in batch_folders(F.col("batch_ts")).items()], F.col("value"))
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*BATCH_PARTS).text(path)
