"""Distributed LSD radix sort: the position of every row of a written table.

Rows stand at distinct places (``_at``). Each pass takes one digit of the composite key, least significant first, and
is a stable counting sort: places are cut into blocks of 4,096, a block counts its digits, prefix sums over (digit,
block) give every block's offset for every digit, and a row moves to its offset plus its rank among the block's equal
digits. The one exchange of rows in a pass is by (block, digit), so a digit that all rows share is spread over the
blocks. Prefix sums run in three levels (blocks of a group of 4,096 blocks, groups of a digit, the 16,384 digits), so no
task adds up one entry per block of the table. A pass is written to the shared folder and the one before it deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import shared_path
from tremor.sinks.tables import delete_folder

DIGIT_BITS = 14
BLOCK_BITS = 12
GROUP_BITS = 12
LOWEST = -(1 << 63)


def _digit(key: str, shift: int) -> Column:
    """A digit of a signed long in unsigned order."""
    flipped = F.col(key).bitwiseXOR(F.lit(LOWEST).cast("long"))
    return F.shiftrightunsigned(flipped, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")


def _before(n: str, *, by: list[str], order: str) -> Column:
    """Sum of ``n`` over the rows that stand earlier."""
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def counting_pass(rows: DataFrame, key: str, shift: int) -> DataFrame:
    """Rows with ``_at`` moved to the place after a stable counting sort by one digit."""
    dealt = rows.withColumns({"_digit": _digit(key, shift), "_block": F.shiftright("_at", BLOCK_BITS)})
    counts = dealt.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_group", F.shiftright("_block", GROUP_BITS))
    groups = counts.groupBy("_digit", "_group").agg(F.sum("_n").alias("_n"))
    digits = groups.groupBy("_digit").agg(F.sum("_n").alias("_n"))
    digits = digits.select("_digit", _before("_n", by=[], order="_digit").alias("_d"))
    groups = groups.select("_digit", "_group", _before("_n", by=["_digit"], order="_group").alias("_g"))
    inside = counts.select("_digit", "_group", "_block", _before("_n", by=["_digit", "_group"], order="_block").alias("_b"))
    offsets = inside.join(groups.join(digits, "_digit"), ["_digit", "_group"])
    offsets = offsets.select("_block", "_digit", (F.col("_d") + F.col("_g") + F.col("_b")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("_at")) - 1
    moved = dealt.withColumn("_rank", rank).join(offsets, ["_block", "_digit"])
    return moved.select(*[c for c in rows.columns if c != "_at"], (F.col("_offset") + F.col("_rank")).alias("_at"))


def digit_passes(rows: DataFrame, keys: list[str]) -> list[tuple[str, int]]:
    """(key, shift) of the passes that the spans of the keys need, least significant first; one at least."""
    spans = rows.agg(*[f(k).alias(f"{k}_{n}") for k in keys for n, f in (("low", F.min), ("high", F.max))]).first()
    passes = []
    for k in reversed(keys):
        low, high = spans[f"{k}_low"], spans[f"{k}_high"]
        differing = 0 if low is None else ((low ^ high) & ((1 << 64) - 1)).bit_length()
        passes += [(k, shift) for shift in range(0, differing, DIGIT_BITS)]
    return passes or [(keys[-1], 0)]


def sort_positions(rows: DataFrame, keys: list[str], tag: str = "radix") -> DataFrame:
    """``rows`` with ``position`` (long, from 0) in ascending order of ``keys`` (long, not null), the first one leading.

    ``rows`` must be read from a written table and hold distinct places in a column ``_at``, whose order settles ties.
    """
    spark = rows.sparkSession
    passes = digit_passes(rows, keys)
    before = None
    for key, shift in passes:
        path = shared_path(spark, tag)
        counting_pass(rows, key, shift).write.option("compression", "zstd").parquet(path)
        rows = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return rows.withColumnRenamed("_at", "position")
