"""Helpers shared by the training-data operators.

Text kernels work on Arrow string buffers: a batch's texts are one byte
array plus row offsets, cut into slices of bounded size, so a task holds a
few megabytes however many rows the batch has (a single longer text forms a
slice of its own). Nulls become empty texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20

U64 = np.uint64
MULT = 0x9E3779B97F4A7C15 | 1


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder for ``tag`` below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and that folder."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage; survives lost executors)."""
    return stored(df, tag)[0]


def slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows holding up to ``limit`` bytes together."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    n = len(arr)
    if not n:
        return
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, for steps that hold Python objects for each row."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer for 64-bit hashes (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(31))) * U64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> U64(29))) * U64(0xA24BAED4963EE407)
        return h ^ (h >> U64(32))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int = MULT):
        self.base, self.up, self.down = base, np.ones(1, U64), np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("up", self.base), ("down", _inverse(self.base))):
                    steps = np.full(size, base, U64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps, dtype=U64))
        return self.up, self.down


POWERS = Powers()
BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


def prefix_hashes(codes: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Prefix sums of codes[i] * base**i: any run's hash is a difference times an inverse power."""
    up, _ = powers.upto(len(codes))
    out = np.zeros(len(codes) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(codes * up[: len(codes)], dtype=U64, out=out[1:])
    return out


def run_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Position-independent hash of codes[start:end] for every pair."""
    _, down = powers.upto(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than 0x20 and 0x09-0x0D: (start, end, row of the slice); words never cross rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = solid[heads]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = solid[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, byte by byte."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word (ascending, disjoint): a sum of mixed (byte, place in the word) codes.

    Prefix hashes modulo a power of two would give words made of one pattern and its complement the same hash whatever
    the base; here every byte is mixed with its place first, so sums of different words agree by chance only.
    """
    first = np.zeros(len(data), np.int64)
    first[starts] = starts
    place = (np.arange(len(data)) - np.maximum.accumulate(first)).view(U64) if len(data) else first.view(U64)
    total = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(BYTE_CODES[data] + place * U64(MULT)), dtype=U64, out=total[1:])
        return mix(total[ends] - total[starts] + (ends - starts).astype(U64))


def text_key(text: Column | str) -> Column:
    """Tells the texts of one doc_id (or of the rows without one) apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def gram_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive items (callers drop runs that cross rows)."""
    if len(items) < n:
        return np.zeros(0, U64)
    out = items[: len(items) - n + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out = out * U64(0xF1357AEA2E62A9C5) + items[k : len(items) - n + 1 + k]
    return mix(out)


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == U64 else values.astype(np.int64))


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Rows of ``counts`` consecutive values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


MEMBER_BITS = 21


def maybe_member(ids: DataFrame, bits: int = MEMBER_BITS) -> Column:
    """Condition on a column ``uid``: false only for values that are not in ``ids`` (one column ``uid``).

    A bit table of fixed size (2**bits bits, as a constant array) that the driver sees whatever the number of ids.
    It spares rows a shuffle; an exact join must follow on the rows that pass.
    """
    slot = F.pmod(F.xxhash64("uid"), F.lit(1 << bits))
    marks = ids.select(slot.alias("s")).distinct().groupBy(F.floor(F.col("s") / 32).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("bits")
    )
    words_ = [0] * (1 << (bits - 5))
    for r in marks.collect():
        words_[r["w"]] = r["bits"]
    constant = F.split(F.lit(",".join(map(str, words_))), ",").cast("array<bigint>")
    word = F.get(constant, F.floor(slot / 32).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 32).cast("int"))) != 0
