"""Key-to-month index of a partitioned Silver table: Bloom filters per month and key shard.

A merge has to know in which months the events of its batch live now. Scanning Silver's event_id column answers that by
reading every key there is. The index holds about four bytes per key instead: keys are dealt to ``shards`` by hash, and
each (month, shard) has one Bloom filter (32 bits per key, 12 probes, one false hit in a million). A batch's key hashes
meet their shard's filters of all months in one co-grouped step; months with a hit are the *candidates*, and only their
event_id columns are read for the exact answer. A false hit costs a month's column, never a wrong row.

The index errs on one side only. Before a merge writes Silver it rewrites the filters of the months it touches from the
keys these months held and will hold, so whatever part of the write survives a crash is covered. A Silver month without
filters (a lost folder, rows written by other means) counts as a candidate.

Layout: ``<silver>_index/year=/month=`` with rows (shard, n, bits); the shard count is in ``<silver>_index/_shards``. A
filter that has outgrown its shard drops the index; the next merge builds it anew with more shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, touch
from ..sinks import tables

KEYS_PER_FILTER = 1 << 16
#: 8 MB of hashes
BROADCAST_KEYS = 1 << 20
OUTGROWN = 8
BITS_PER_KEY = 32
PROBES = 12
FILTER_SCHEMA = "year int, month int, shard int, n bigint, bits binary"
U64 = np.uint64


def index_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_index"


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bit positions of each hash, one column per probe (double hashing)."""
    with np.errstate(over="ignore"):
        step = (hashes * U64(0x9E3779B97F4A7C15)) ^ (hashes >> U64(29)) | U64(1)
        mixed = hashes[:, None] + np.arange(PROBES, dtype=U64) * step[:, None]
        mixed = (mixed ^ (mixed >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return (mixed >> U64(20)) % U64(size)


def bloom_bits(hashes: np.ndarray) -> bytes:
    size = max(64, -(-len(hashes) * BITS_PER_KEY // 64) * 64)
    bits = np.zeros(size, np.uint8)
    bits[_slots(hashes, size).ravel()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def bloom_hits(hashes: np.ndarray, bits: bytes) -> np.ndarray:
    """True for every hash that was built in, and for one in a million others."""
    words = np.frombuffer(bits, np.uint8)
    slot = _slots(hashes, len(words) * 8)
    return ((words[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & 1).all(axis=1)


def _hashed(rows: DataFrame, shards: int, *columns: str) -> DataFrame:
    h = F.xxhash64("event_id")
    return rows.select(*columns, h.alias("hash"), F.pmod(h, F.lit(shards)).cast("int").alias("shard"))


def filters(rows: DataFrame, shards: int) -> DataFrame:
    """One row per (year, month, shard) of the keys in rows (event_id, year, month)."""

    def build(t: pa.Table) -> pa.Table:
        hashes = np.unique(t["hash"].to_numpy().view(U64))
        head = t.select(["year", "month", "shard"]).slice(0, 1)
        return head.append_column("n", pa.array([len(hashes)])).append_column("bits", pa.array([bloom_bits(hashes)], pa.binary()))

    return _hashed(rows, shards, "year", "month").groupBy("year", "month", "shard").applyInArrow(build, FILTER_SCHEMA)


def read_index(spark: SparkSession, silver_path: str) -> DataFrame:
    return spark.read.schema(FILTER_SCHEMA).parquet(index_path(silver_path))


def shard_count(spark: SparkSession, silver_path: str) -> int | None:
    """Shards of the index, None without an index."""
    found = tables.glob_folders(spark, f"{index_path(silver_path)}/_shards/n=*")
    return int(found[0].rpartition("=")[2]) if found else None


def drop(spark: SparkSession, silver_path: str) -> None:
    if path_exists(spark, index_path(silver_path)):
        tables.delete_folder(spark, index_path(silver_path))


def _note_shards(spark: SparkSession, silver_path: str, shards: int) -> None:
    touch(spark, f"{index_path(silver_path)}/_shards/n={shards}/done")


def build(spark: SparkSession, silver_path: str) -> int:
    """Index the whole table (one scan of its keys); returns the shard count."""
    drop(spark, silver_path)
    rows = tables.read_silver(spark, silver_path).select("event_id", "year", "month")
    largest = rows.groupBy("year", "month").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-largest // KEYS_PER_FILTER))
    filters(rows, shards).write.partitionBy("year", "month").parquet(index_path(silver_path))
    _note_shards(spark, silver_path, shards)  # last: a half-written index is no index
    return shards


def update(spark: SparkSession, silver_path: str, rows: DataFrame, shards: int) -> None:
    """Replace the filters of the months in rows (event_id, year, month): all keys these months hold or will hold."""
    fresh = filters(rows, shards)
    writer = fresh.write.partitionBy("year", "month").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(index_path(silver_path))


def outgrown(spark: SparkSession, silver_path: str) -> bool:
    largest = read_index(spark, silver_path).agg(F.max("n")).first()[0] or 0
    return largest > OUTGROWN * KEYS_PER_FILTER


def candidates(spark: SparkSession, silver_path: str, keys: DataFrame, shards: int) -> DataFrame:
    """(year, month) whose filters know one of ``keys`` (event_id)."""

    index, asked = read_index(spark, silver_path), _hashed(keys, shards)

    def hit(hashes: np.ndarray, filters_: list[bytes]) -> pa.Array:
        return pa.array([bool(len(hashes)) and bool(bloom_hits(hashes, b).any()) for b in filters_], pa.bool_())

    def probe_group(t: pa.Table, months: pa.Table) -> pa.Table:
        found = hit(t["hash"].to_numpy().view(U64), months["bits"].to_pylist())
        return months.select(["year", "month"]).filter(found)

    if keys.count() <= BROADCAST_KEYS:
        mine = np.array([r["hash"] for r in asked.select("hash").collect()], np.int64)
        mine = mine[np.argsort(mine % shards, kind="stable")]
        sent = spark.sparkContext.broadcast(mine)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = sent.value % shards
            for b in batches:
                at = [np.searchsorted(number, b.column("shard").to_numpy(), side) for side in ("left", "right")]
                own = [sent.value[i:j].view(U64) for i, j in zip(*at)]
                found = [hit(h, [x.as_py()])[0].as_py() for h, x in zip(own, b.column("bits"))]
                yield b.select(["year", "month"]).filter(pa.array(found, pa.bool_()))

        found = index.mapInArrow(probe, "year int, month int")
    else:
        found = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe_group, "year int, month int")
    return found.distinct()


def candidate_months(spark: SparkSession, silver_path: str, keys: DataFrame, shards: int) -> set[tuple[int, int]]:
    """Months of the table in which events of ``keys`` may live, those without filters included."""
    hits = {(r["year"], r["month"]) for r in candidates(spark, silver_path, keys, shards).collect()}
    keyed = tables.partition_folders(spark, index_path(silver_path), tables.SILVER_PARTITIONS)
    indexed = {(v["year"], v["month"]) for _, v in keyed}
    there = {(v["year"], v["month"]) for _, v in tables.partition_folders(spark, silver_path, tables.SILVER_PARTITIONS)}
    return (hits & there) | (there - indexed)
