"""Removal of lines that many documents share, by a sharded minimal perfect hash of line digests.

A text is split at ``\\n``. A line's key is the line without white space (0x20, 0x09-0x0D) at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points held by at least ``min_docs`` documents lose all their lines, except in the
largest doc_id that holds them; all other lines stay, unchanged and in order.

1. Each task digests its documents' keys (md5), one row per document and distinct key; Spark counts documents and takes
   the largest doc_id per digest, combined before the shuffle, so a line in a third of all documents costs a row per task.
2. The digests that reach ``min_docs`` (no other can lose a line) are dealt to shards of about ``SHARD_KEYS`` by hash; a
   shard becomes a perfect hash with three arrays: fingerprint (64 further bits), count and largest doc_id.
3. Documents probe the arrays, lines are never joined. While the arrays measure at most ``BROADCAST_BYTES``, every
   task gets them and the texts do not move. Beyond that, (document, digest) pairs travel to their shard, where the
   arrays stand before them, and only the digests to drop come back to the documents; a shard that a hot line makes
   large is split by salt. Both ways give the same rows.

A line outside the index would have to agree in all 128 bits of an md5 with one inside to be dropped.

Defined cases: a null text is one empty line; rows are documents of their own in the count, also with equal or no
doc_id; a null doc_id counts as the smallest, and all rows of the largest doc_id keep the line; a line repeated in a
document counts once and is dropped or kept as a whole; an empty table gives no rows; other columns are ignored or, in
:func:`deduplicate`, kept whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tremor.llm.common import lowered, materialize, slices
from tremor.llm.perfect_hash import PerfectHash
from tremor.session import table

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 18
#: arrays up to this size go to every task
BROADCAST_BYTES = 32 << 20
#: probes that meet in one task beyond the broadcast
TASK_PROBES = 1 << 21
LOWEST = -(1 << 63)
BLOBS = ["sizes", "words", "fingerprints", "counts", "last"]
INDEX_SCHEMA = "shard long, " + ", ".join(f"{c} binary" for c in BLOBS)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every line of a slice of texts; a text has one line more than it has ``\\n``."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    per_row = 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1])
    return starts, ends, np.repeat(np.arange(len(per_row)), per_row)


def key_digests(data: np.ndarray, offsets: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines per row, line number, row, 16-byte digest) of the lines whose key is long enough; numbers run over the slice."""
    starts, ends, row = line_spans(data, offsets)
    solid = np.flatnonzero(~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D))))
    first, after = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    line = np.flatnonzero(after > first)
    a, z = solid[first[line]], solid[after[line] - 1] + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    enough = points[z] - points[a] >= min_chars
    line, a, z = line[enough], a[enough], z[enough]
    view = memoryview(lowered(data)).cast("B") if len(data) else memoryview(b"")
    digests = b"".join(hashlib.md5(view[i:j], usedforsecurity=False).digest() for i, j in zip(a.tolist(), z.tolist()))
    return np.bincount(row, minlength=len(offsets) - 1), line, row[line], np.frombuffer(digests, np.uint8).reshape(-1, 16)


def halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.ascontiguousarray(digests).view("<u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def _binary(digests: np.ndarray) -> pa.Array:
    raw = pa.py_buffer(np.ascontiguousarray(digests).tobytes())
    return pa.Array.from_buffers(pa.binary(16), len(digests), [None, raw]).cast(pa.binary())


def _distinct(row: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Places of the first line of each (row, digest)."""
    a, b = halves(digests)
    return np.sort(np.unique(np.stack([row.astype(np.uint64), a, b]), axis=1, return_index=True)[1]) if len(row) else row


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, key) per document and distinct key; equal hashes under one doc_id do no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, data, offsets in slices(b.column(2)):
                _, _, row, digests = key_digests(data, offsets, min_chars)
                once = _distinct(row, digests)
                at = pa.array(first + row[once])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), _binary(digests[once])], names=["doc_id", "text_hash", "key"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return narrow.mapInArrow(run, "doc_id long, text_hash long, key binary")


def shared_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """(key, n_docs, last) of the keys that at least ``min_docs`` documents hold."""
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
    return counted.filter(F.col("n_docs") >= min_docs)


def _shard(n_shards: int):
    """Column: the shard of ``key``, from its first seven bytes."""
    return F.pmod(F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long"), F.lit(n_shards))


def _shards(digests: np.ndarray, n_shards: int) -> np.ndarray:
    number = np.zeros(len(digests), np.int64)
    for k in range(7):
        number = (number << 8) | digests[:, k]
    return number % n_shards


def build_index(shared: DataFrame, n_shards: int) -> DataFrame:
    """One row per shard: the perfect hash and its arrays, in the order of its indexes."""

    def build(t: pa.Table) -> pa.Table:
        high, low = halves(np.frombuffer(b"".join(t["key"].to_pylist()), np.uint8).reshape(-1, 16))
        hashed = PerfectHash.build(high, low)
        place = np.argsort(hashed.lookup(high, low))
        counts = np.minimum(t["n_docs"].to_numpy(), np.iinfo(np.uint32).max).astype("<u4")[place]
        last = pc.fill_null(t["last"], LOWEST).to_numpy().astype("<i8")[place]
        blobs = [hashed.sizes.astype("<i8"), hashed.words.astype("<u8"), low.astype("<u8")[place], counts, last]
        return pa.table([t["shard"].slice(0, 1), *([x.tobytes()] for x in blobs)], names=["shard", *BLOBS])

    dealt = shared.select(_shard(n_shards).alias("shard"), "key", "n_docs", "last")
    return dealt.groupBy("shard").applyInArrow(build, INDEX_SCHEMA)


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, sizes: bytes, words: bytes, fingerprints: bytes, counts: bytes, last: bytes):
        self.hashed = PerfectHash(np.frombuffer(sizes, "<i8"), np.frombuffer(words, "<u8"))
        self.fingerprints, self.counts, self.last = (np.frombuffer(x, t) for x, t in ((fingerprints, "<u8"), (counts, "<u4"), (last, "<i8")))

    def drops(self, digests: np.ndarray, ids: np.ndarray, min_docs: int) -> np.ndarray:
        """True where the line of that digest goes from the document of that id."""
        high, low = halves(digests)
        at = self.hashed.lookup(high, low)
        out = at >= 0
        out[out] = self.fingerprints[at[out]] == low[out]
        out[out] = (self.counts[at[out]] >= min_docs) & (self.last[at[out]] != ids[out])
        return out


def _edit(b: pa.RecordBatch, min_chars: int, decide) -> pa.RecordBatch:
    """(row, n_lines, n_dropped, kept) of a batch (row, text, ...); ``decide``: which (row of the batch, digest) go."""
    n_lines, n_dropped = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
    changed, texts = np.zeros(b.num_rows, bool), []
    for first, _, data, offsets in slices(b.column(1)):
        per_row, line, row, digests = key_digests(data, offsets, min_chars)
        n_lines[first : first + len(per_row)] = per_row
        go = decide(first + row, digests)
        line, row = line[go], row[go]
        before = np.cumsum(per_row) - per_row
        for r, at, n in zip(*(x.tolist() for x in np.unique(row, return_index=True, return_counts=True))):
            lines = data[offsets[r] : offsets[r + 1]].tobytes().split(b"\n")
            for k in (line[at : at + n] - before[r]).tolist():
                lines[k] = None
            texts.append(b"\n".join(x for x in lines if x is not None).decode())
            n_dropped[first + r], changed[first + r] = n, True
    kept = pc.fill_null(b.column(1).cast(pa.large_string()), "")
    kept = pc.replace_with_mask(kept, pa.array(changed), pa.array(texts, pa.large_string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(n_lines), pa.array(n_dropped), kept], names=["row", "n_lines", "n_dropped", "kept"])


def _ids(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, LOWEST).to_numpy(zero_copy_only=False)


def _drops_at_shards(docs: DataFrame, index: DataFrame, shared: DataFrame, n_shards: int, probes: int, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, keys to drop): pairs of document and digest meet the arrays of their shard."""
    members = shared.groupBy(_shard(n_shards)).agg(F.sum("n_docs").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = max(1, -(-(probes // n_shards + members) // TASK_PROBES))
    keyed = line_keys(docs, min_chars)
    salt = F.pmod(F.xxhash64("doc_id", "text_hash", "key"), F.lit(salts))
    nothing = {c: F.lit(None).cast("binary").alias(c) for c in BLOBS}
    asks = keyed.select(_shard(n_shards).alias("shard"), salt.alias("salt"), F.lit(1).alias("ask"), "doc_id", "text_hash", "key", *nothing.values())
    arrays = index.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), F.lit(0).alias("ask"),
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("text_hash"), F.lit(None).cast("binary").alias("key"), *BLOBS,
    )
    met = arrays.unionByName(asks).repartition(n_shards * salts, "shard", "salt").sortWithinPartitions("shard", "salt", "ask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        for b in batches:
            numbers, ask = b.column("shard").to_numpy(), b.column("ask").to_numpy()
            cuts = np.flatnonzero((ask[1:] != ask[:-1]) | (numbers[1:] != numbers[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ask)]):
                if not ask[i]:
                    shard, number = Shard(*(b.column(c)[j - 1].as_py() for c in BLOBS)), numbers[i]
                elif number == numbers[i]:  # a shard without arrays drops nothing
                    part = b.slice(i, j - i)
                    digests = np.frombuffer(b"".join(part.column("key").to_pylist()), np.uint8).reshape(-1, 16)
                    go = pa.array(shard.drops(digests, _ids(part.column("doc_id")), min_docs))
                    yield part.select(["doc_id", "text_hash", "key"]).filter(go)

    found = met.mapInArrow(run, "doc_id long, text_hash long, key binary")
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set("key").alias("keys"))


def edited(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: row struct<all columns of docs>, n_lines, n_dropped, kept (its text without dropped lines)."""
    spark = docs.sparkSession
    seen = Observation("line_keys")
    shared = materialize(shared_keys(line_keys(docs, min_chars).observe(seen, F.count(F.lit(1)).alias("n")), min_docs), "line-keys")
    n_shared = shared.count()
    n_shards = max(1, -(-n_shared // SHARD_KEYS))
    index = materialize(build_index(shared, n_shards), "line-index")
    size = index.agg(F.sum(sum((F.length(c) for c in BLOBS), F.lit(0)))).first()[0] or 0
    packed = docs.select(F.struct("*").alias("row"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    out = StructType([packed.schema["row"], *(StructField(c, LongType()) for c in ("n_lines", "n_dropped")), StructField("kept", StringType())])
    if size <= broadcast_bytes:
        sent = spark.sparkContext.broadcast({r["shard"]: tuple(bytes(r[c]) for c in BLOBS) for r in index.collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shards = {k: Shard(*v) for k, v in sent.value.items()}
            for b in batches:
                ids = _ids(b.column(2))

                def decide(row: np.ndarray, digests: np.ndarray) -> np.ndarray:
                    go, number = np.zeros(len(row), bool), _shards(digests, n_shards)
                    for k, shard in shards.items():
                        mine = np.flatnonzero(number == k)
                        go[mine] = shard.drops(digests[mine], ids[row[mine]], min_docs)
                    return go

                yield _edit(b, min_chars, decide)

        return packed.mapInArrow(probe, out)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone: dict[int, set] = {}

            def decide(row: np.ndarray, digests: np.ndarray) -> np.ndarray:
                for r in np.unique(row).tolist():
                    gone[r] = set(b.column(2)[r].as_py() or ())
                return np.array([d.tobytes() in gone[r] for r, d in zip(row.tolist(), digests)], bool)

            yield _edit(b, min_chars, decide)

    probes = seen.get["n"] if n_shared else 0  # an empty plan observes nothing
    drops = _drops_at_shards(docs, index, shared, n_shards, probes, min_chars, min_docs)
    mine = packed.withColumn("text_hash", F.xxhash64("text")).alias("p")
    joined = mine.join(drops.alias("d"), F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("p.text_hash") == F.col("d.text_hash")), "left")
    return joined.select("p.row", "p.text", "d.keys").mapInArrow(apply, out)


def deduplicate(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with repeated lines cut out of ``text`` (a null text stays null); all rows and columns stay."""
    out = edited(docs, min_chars, min_docs, broadcast_bytes)
    kept = F.when(F.col("row").getField("text").isNotNull(), F.col("kept"))
    return out.select(*[kept.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: lines of ``documents`` with keys of 40 code points or more that 5 documents hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return edited(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, i, line, s.key IS NOT NULL AND k.doc_id <> s.last AS gone FROM k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
