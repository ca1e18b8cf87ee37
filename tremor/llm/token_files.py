"""Token files: ids of whole documents in ascending doc_id order, range-coded in closed blocks.

A file row is a segment of whole consecutive documents: their ids and token
counts, the ids cut into blocks of ``BLOCK_IDS``, each block coded from a reset
model (:mod:`tremor.llm.coder`) with its length and crc32, and the number of
ids before the segment within its shard (one write task's share). Rows are
self-contained, so files may be split and read by any task. The folder is
Parquet, written by Spark to the shared file system.

Defined cases: a null text counts as empty (its document holds the end id
alone); null doc_ids come first; repeated doc_ids are kept, ordered by text;
an empty table gives no rows; other input columns are ignored. A block whose
checksum differs fails the read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm import coder
from tremor.llm.common import parts, shared_path
from tremor.llm.tokens import encoder, text_groups, tokenizer_path
from tremor.session import table

END_ID = 2
SEGMENT_IDS = 1 << 16
#: ids that a task codes in lockstep at a time
GROUP_IDS = 1 << 23
#: segments that a task decodes in lockstep at a time, whatever batches they come in
GROUP_SEGMENTS = 128
MAX_SHARDS = 1_000_000

FILE_SCHEMA = (
    "shard long, segment long, shard_start long, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "block_ids array<bigint>, block_crcs array<bigint>, block_bytes array<bigint>, payload binary"
)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the documents' ids below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer).encode
        names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
        segments, pending = [], 0
        docs_, sizes_, pieces, held = [], [], [], 0
        number = before = 0

        def flush() -> pa.RecordBatch:
            blocks = [[ids[k : k + coder.BLOCK_IDS] for k in range(0, len(ids), coder.BLOCK_IDS)] for *_, ids in segments]
            codes = iter(coder.encode_blocks([b for x in blocks for b in x]))
            coded = [[next(codes) for _ in x] for x in blocks]
            rows = [
                (shard, n, start, d, s, [len(b) for b in x], [coder.checksum(b) for b in x], [len(c) for c in y], b"".join(y))
                for (n, start, d, s, _), x, y in zip(segments, blocks, coded)
            ]
            types = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 5 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        def close() -> None:
            nonlocal number, before, held, docs_, sizes_, pieces
            ids = np.concatenate(pieces)
            segments.append((number, before, docs_, sizes_, ids))
            number, before, held, docs_, sizes_, pieces = number + 1, before + len(ids), 0, [], [], []

        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in text_groups(texts):
                ids, sizes = encode([t or "" for t in texts[i:j]], end_id)
                ends = np.cumsum(sizes)
                first = 0
                while first < j - i:
                    room = SEGMENT_IDS - held + (ends[first - 1] if first else 0)
                    last = min(j - i, int(np.searchsorted(ends, room, "left")) + 1)
                    a, z = int(ends[first - 1]) if first else 0, int(ends[last - 1])
                    docs_ += doc_ids[i + first : i + last]
                    sizes_ += sizes[first:last].tolist()
                    pieces.append(ids[a:z])
                    held += z - a
                    pending += z - a
                    if held >= SEGMENT_IDS:
                        close()
                    first = last
                if pending >= GROUP_IDS:
                    if held:
                        close()
                    yield flush()
                    segments, pending = [], 0
        if held:
            close()
        if segments:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids (little-endian unsigned 16-bit) decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for b in batches:
            for r in parts(iter([b]), 16):
                rows += r.to_pylist()
                if len(rows) >= GROUP_SEGMENTS:
                    yield decode(rows)
                    rows = []
        if rows:
            yield decode(rows)

    def decode(rows: list[dict]) -> pa.RecordBatch:
        codes, lengths, crcs = [], [], []
        for r in rows:
            at = 0
            for n, crc, size in zip(r["block_ids"], r["block_crcs"], r["block_bytes"]):
                codes.append(r["payload"][at : at + size])
                lengths.append(n)
                crcs.append(crc)
                at += size
        blocks = coder.decode_blocks(codes, np.array(lengths, np.int64))
        bad = [k for k, (x, crc) in enumerate(zip(blocks, crcs)) if coder.checksum(x) != crc]
        if bad:
            raise ValueError(f"token file: checksum of {len(bad)} blocks differs")
        ids = np.concatenate(blocks).astype("<u2")
        sizes = np.array([n for r in rows for n in r["doc_tokens"]], np.int64)
        ends = np.cumsum(sizes)
        base = np.concatenate([[0], np.cumsum([sum(r["doc_tokens"]) for r in rows])])[:-1]
        start = ends - sizes + np.repeat([r["shard_start"] for r in rows] - base, [len(r["doc_ids"]) for r in rows])
        crc = [coder.checksum(ids[z - n : z]) for z, n in zip(ends, sizes)]
        raw = pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], ends * 2]).astype(np.int32)), pa.py_buffer(ids)]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([r["shard"] for r in rows], [len(r["doc_ids"]) for r in rows]), pa.int64()),
                pa.array([d for r in rows for d in r["doc_ids"]], pa.int64()),
                pa.array(start, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(crc, pa.int64()),
                raw,
            ],
            names=["shard", "doc_id", "start", "n_tokens", "ids_crc32", "ids"],
        )

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    read = files.mapInArrow(run, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    # one row for each write task, a bounded number: ids of all shards before each
    per_shard = files.select("shard", (F.col("shard_start") + F.expr("aggregate(doc_tokens, 0L, (a, x) -> a + x)")).alias("n"))
    per_shard = per_shard.groupBy("shard").agg(F.max("n").alias("n"))
    base = per_shard.select(
        "shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base")
    )
    return read.join(base, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: write all documents, read the files back."""
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_token_files(spark, path).drop("ids")
