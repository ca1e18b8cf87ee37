"""Dense BIGINT surrogate keys from an append-only key table.

A natural key's digest (``functions.keys``) is looked up in a key table (natural, key). Naturals that it does not hold
yet are numbered behind its last key, in the order of the digest, and appended; a key once given never changes. The
numbers depend on the data of each run alone, not on how it was partitioned:

1. the new naturals are range-partitioned and sorted by digest and written with their partition and place in it (they
   are distinct, so no partition can be hot);
2. rows per partition are counted and summed up to offsets, a table with one row per partition;
3. key = last key + offset of the partition + place. No task numbers all rows, and nothing is collected but offsets.

An append that a crash cut short leaves keys that stay valid; the rest is numbered behind them by the next run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import path_exists, scratch_dir
from ..sinks import tables

KEY_SCHEMA = "natural string, key bigint"
#: dimension -> its key column
DENSE_DIMENSIONS = {"dim_location": "LocationKey", "dim_event_type": "EventTypeKey", "dim_magnitude": "MagnitudeKey"}
PLACE_BITS = 33  # of monotonically_increasing_id: the lower bits are the place within the partition


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], KEY_SCHEMA)
    return spark.read.schema(KEY_SCHEMA).parquet(path)


def number(naturals: DataFrame, start: int) -> tuple[DataFrame, str]:
    """(natural, key) with keys start, start + 1, ... in the order of ``natural`` (distinct), and the folder it reads."""
    spark = naturals.sparkSession
    path = scratch_dir(spark, "dense_keys", uuid.uuid4().hex)
    ordered = naturals.repartitionByRange("natural").sortWithinPartitions("natural")
    place = F.monotonically_increasing_id()
    ordered.select("natural", place.alias("place")).write.parquet(path)
    placed = spark.read.schema("natural string, place bigint").parquet(path).withColumn("part", F.shiftright("place", PLACE_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition of the sort
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_part = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    key = (F.lit(start) + F.col("offset") + in_part).alias("key")
    return placed.join(F.broadcast(offsets), "part").select("natural", key), path


def assign(spark: SparkSession, naturals: DataFrame, path: str) -> int:
    """Give every value of the column ``natural`` a key in the table at ``path``; returns how many were new."""
    known = read_keys(spark, path)
    fresh = naturals.select("natural").distinct().join(known.select("natural"), "natural", "left_anti")
    last = known.agg(F.max("key")).first()[0]
    numbered, folder = number(fresh, 0 if last is None else last + 1)
    added = numbered.count()
    if added:
        numbered.write.mode("append").parquet(path)
    tables.delete_folder(spark, folder)
    return added


def replace(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` with the digest in ``column`` replaced by its BIGINT key (a digest without a key gives null)."""
    mine = keys.select(F.col("natural").alias(column), F.col("key").alias("_key"))
    joined = rows.join(mine, column, "left")
    return joined.select(*[F.col("_key").alias(c) if c == column else F.col(c) for c in rows.columns])


def assign_star(spark: SparkSession, star: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Keys for all dimensions of a star with digest keys, in one key table per dimension below ``root``."""
    return {
        name: assign(spark, star[name].select(F.col(column).alias("natural")), f"{root}/{name}")
        for name, column in DENSE_DIMENSIONS.items()
    }


def dense_star(spark: SparkSession, star: dict[str, DataFrame], root: str, fact: str = "fact_earthquake_events") -> dict[str, DataFrame]:
    """The star with BIGINT keys in dimensions and fact (after ``assign_star``)."""
    out = dict(star)
    for name, column in DENSE_DIMENSIONS.items():
        keys = read_keys(spark, f"{root}/{name}")
        out[name] = replace(star[name], column, keys)
        out[fact] = replace(out[fact], column, keys)
    return out
