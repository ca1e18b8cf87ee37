"""Importance resampling of documents towards a target text distribution.

A text is a bag of hashed word n-grams (1 to 3 consecutive words, joined by one space): A-Z are lower-cased, words are
runs of letters, digits and characters beyond ASCII, a feature's bucket is the crc32 of its UTF-8 bytes modulo
``buckets``. All documents and all target texts are counted per bucket; a bucket's gain is 1000 times the logarithm of
the ratio of its smoothed shares, floor taken. A document's weight is the sum of gains over its features, its score the
weight plus Gumbel noise that depends on the seed and doc_id only, so the highest scores are a weighted draw without
replacement. Ranks come from a distributed LSD radix sort of (score descending, doc_id) of the rows whose class of scores
can be drawn.

Memory is bounded: a task holds the bucket counts and a slice of texts; the driver sees ``buckets`` counts. Checksums of
n-grams are carried on byte by byte over all words at once (:func:`extend`), so no Python object is made per feature.

Defined cases: a null text has no words; a null doc_id has the noise of an empty one and ranks before all others among
equal scores; rows equal in score and doc_id rank in the order of the scored table, each with a rank of its own; words
of any length count whole; an empty table gives no rows, an empty target has no counts; other columns are ignored or,
in :func:`resample`, kept whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tremor.llm.common import lowered, materialize, slices
from tremor.llm.radix_sort import DIGIT_BITS, LOWEST, sort_positions
from tremor.session import table

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
#: bytes up to which words go through the vectorised checksum; longer ones one at a time
VECTOR_BYTES = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC_TABLE = _crc_table()
ONES = np.uint32(0xFFFFFFFF)


def extend(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 registers carried on over data[start:end], for all rows at once."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    out, at, sizes = state[order], starts[order], sizes[order]
    long = int(np.searchsorted(-sizes, -VECTOR_BYTES, "left"))
    for i in range(long):
        out[i] = ~np.uint32(zlib.crc32(data[at[i] : at[i] + sizes[i]], int(~out[i] & ONES)))
    rest, at, sizes = out[long:], at[long:], sizes[long:]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        m = int(np.searchsorted(-sizes, -k, "left"))
        s = rest[:m]
        rest[:m] = CRC_TABLE[(s ^ data[at[:m] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    back = np.empty_like(out)
    back[order] = out
    return back


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of runs of 0-9, a-z and bytes from 0x80 in lower-cased data; words never cross rows."""
    solid = np.zeros(len(data) + 1, bool)
    solid[:-1] = (data >= 0x80) | ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x30) & (data <= 0x39))
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[offsets[:-1]] = solid[offsets[:-1]]
    opens[-1] = False
    starts = np.flatnonzero(opens)
    gaps = np.flatnonzero(~solid)
    ends = gaps[np.searchsorted(gaps, starts)]
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, np.minimum(ends, offsets[row + 1]), row


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of all features of a slice of texts, for one n-gram length after another."""
    data = lowered(data)
    starts, ends, row = word_spans(data, offsets)
    state = extend(np.full(len(starts), ONES), data, starts, ends)
    yield (state ^ ONES) % np.uint32(buckets), row
    for n in range(1, LONGEST):
        state = state[:-1]
        k = np.flatnonzero(row[: len(state)] == row[n:])
        longer = CRC_TABLE[(state[k] ^ np.uint32(0x20)) & np.uint32(255)] ^ (state[k] >> np.uint32(8))
        longer = extend(longer, data, starts[k + n], ends[k + n])
        yield (longer ^ ONES) % np.uint32(buckets), row[k]
        state[k] = longer


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: counted per task, added up by Spark; the driver sees ``buckets`` sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, offsets in slices(b.column(0)):
                for bucket, _ in feature_buckets(data, offsets, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)) per bucket, shares smoothed by one."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = (target + 1.0) * (s_all + size) / ((corpus + 1.0) * (t_all + size))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths from the seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def score(docs: DataFrame, target: DataFrame, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: row struct<all columns of docs>, doc_id, n_words, n_features, weight, score."""
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    weights = gains.astype(np.float64)  # whole numbers: a slice's sums stay exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            figures = np.zeros((3, b.num_rows), np.int64)
            for first, end, data, offsets in slices(b.column(1)):
                for n, (bucket, row) in enumerate(feature_buckets(data, offsets, buckets)):
                    k = np.bincount(row, minlength=end - first)
                    figures[0, first:end] += k if n == 0 else 0
                    figures[1, first:end] += k
                    figures[2, first:end] += np.bincount(row, weights[bucket], end - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, figures)], names=["row", "n_words", "n_features", "weight"])

    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    longs = [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]
    scored = packed.mapInArrow(run, StructType([packed.schema["row"], *longs]))
    scored = scored.withColumn("doc_id", F.col("row.doc_id"))
    return scored.withColumn("score", F.col("weight") + noise(seed))


def rank(scored: DataFrame, percent: int = 5, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: 1, 2, 3 ... for the drawn share of the eligible rows, else null."""
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    scored = scored.select(*columns, F.monotonically_increasing_id().alias("_at"))
    scored = materialize(scored, "scored")
    enough = F.col("n_words") >= min_words
    eligible = scored.filter(enough).withColumns(
        {"_by_score": -F.col("score"), "_by_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST).cast("long"))}
    )
    rows, low, high = eligible.agg(F.count(F.lit(1)), F.min("_by_score"), F.max("_by_score")).first()
    drawn = rows * percent // 100
    ahead = enough & _reaches(eligible, drawn, low, high)
    place = sort_positions(eligible.filter(ahead), ["_by_score", "_by_id"])
    ranks = place.select(*columns, F.when(F.col("position") < drawn, F.col("position") + 1).alias("rank"))
    others = scored.filter(~ahead).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranks.unionByName(others)


def _reaches(eligible: DataFrame, drawn: int, low: int | None, high: int | None) -> Column:
    """Condition on ``score``: true for the ``drawn`` highest scores and those of the last one's class, so only these are sorted.

    Scores fall into at most 2**DIGIT_BITS + 1 classes of equal width, whose counts the driver sees.
    """
    if not drawn:
        return F.lit(False)
    width = max(0, (high - low).bit_length() - DIGIT_BITS)
    kind = F.shiftright(-F.col("score") - F.lit(low), width)
    counts = sorted((r["kind"], r["n"]) for r in eligible.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).collect())
    reached = 0
    for last, n in counts:
        reached += n
        if reached >= drawn:
            break
    return kind <= last


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = MIN_WORDS, seed: int = 42) -> DataFrame:
    """The drawn documents with all their columns: those at or above the score and doc_id of the last rank."""
    scored = score(docs, target, seed)
    ranked = materialize(rank(scored, percent, min_words), "ranked")
    last = ranked.filter("rank is not null").orderBy(F.desc("rank")).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    enough = (F.col("n_words") >= min_words) & (F.col("score") >= last["score"])
    tied = (F.col("score") > last["score"]) | F.col("doc_id").isNull()
    if last["doc_id"] is not None:
        tied = tied | (F.col("doc_id") <= last["doc_id"])
    return scored.filter(enough & tied).select("row.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document of ``documents`` scored towards ``benchmark``, 5 % drawn and ranked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranked = rank(score(docs, table(spark, sf_dir, "benchmark")))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS entries
  FROM range(256) r(i)
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), runs AS (
  SELECT side, id, w, unnest([1, 2, 3]) AS n FROM words
), grams AS (
  SELECT side, id, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM runs
), codes AS (
  SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM grams)
), hashed AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda a, b: xor(a >> 8, entries[xor(a & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM codes, crc_table
), f AS (
  SELECT side, id, bucket, count(*) AS n FROM grams JOIN hashed USING (g) GROUP BY side, id, bucket
), sides AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t FROM f GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM sides, (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sides)
), weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents JOIN words ON side = 'd' AND id = doc_id LEFT JOIN weights ON weights.id = doc_id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""
