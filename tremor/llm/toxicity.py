"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased; characters that are not letters become spaces. A
feature is the presence of an n-gram (n of ``SIZES``). Naive Bayes log-count
ratios are taken over the labelled training rows; the n-grams that tell the
labels apart best (likelihood ratio of at least ``LEAST_G2``, at most
``FEATURES``) are kept, each scaled by its ratio, and a logistic regression is
fitted on the scaled features.

Bounds (parameters): at most ``SAMPLE`` labelled rows, those with the least
hash of doc_id, are used for training, and at most ``FEATURES`` features reach
the driver, where the regression is fitted on the sample's sparse features.
Scoring covers every text as a whole.

Defined cases: a null text counts as empty and gets the score of a text without
features; null labels are ignored; several labels of a doc_id count as toxic
if one does; a null doc_id is never training data and not held out; without
labels of both kinds every score is the rounded share of toxic labels (0
without labels); repeated rows get equal scores; an empty table gives no
rows; other columns are kept by ``reject`` and ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import list_array, long_array, materialize, mix, prefix_hashes, run_hashes, slices
from tremor.session import table

SIZES = (4, 5, 6)
SAMPLE = 20_000
FEATURES = 4096
LEAST_G2 = 12.0
FOLDS = 5
MASK_BITS = 20


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Code of each character of the basic plane: lower case for letters, space for all others; and its hash."""
    code = np.full(1 << 16, 32, np.int64)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            code[c] = ord(low) if len(low) == 1 else c
    return code, mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(0x3C6EF372FE94F82B))


def gram_rows(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...] = SIZES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram hash, row of the slice) for each size; n-grams never cross rows."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    code, hashes = _letters()
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = lead[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    codes = hashes[code[np.minimum(points, 0xFFFF)]]
    prefix = prefix_hashes(codes)
    for n in sizes:
        if len(codes) >= n:
            at = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
            yield run_hashes(prefix, at, at + n), row[at]


@dataclass
class Model:
    hashes: np.ndarray  # sorted n-gram hashes
    weights: np.ndarray  # regression weight times log-count ratio, in the same order
    bias: float

    def __post_init__(self):
        self.mask = np.zeros(1 << MASK_BITS, bool)
        self.mask[self.hashes & np.uint64((1 << MASK_BITS) - 1)] = True

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, feature number) pairs, sorted."""
        found = []
        for h, row in gram_rows(data, offsets):
            k = np.flatnonzero(self.mask[h & np.uint64((1 << MASK_BITS) - 1)])
            at = np.searchsorted(self.hashes, h[k])
            ok = at < len(self.hashes)
            ok[ok] = self.hashes[at[ok]] == h[k][ok]
            found.append(row[k[ok]] * len(self.hashes) + at[ok])
        pairs = np.unique(np.concatenate(found)) if found and len(self.hashes) else np.zeros(0, np.int64)
        return pairs // max(len(self.hashes), 1), pairs % max(len(self.hashes), 1)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, feature = self.features(data, offsets)
        margin = self.bias + np.bincount(row, self.weights[feature], minlength=len(offsets) - 1)
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic, doc_id of the sampled labelled documents outside the held-out fold, written to the shared folder."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    chosen = known.filter(fold != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return materialize(texts.select("text", "toxic", "doc_id"), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    train = training_rows(docs, labels, sample)
    totals = {int(r["toxic"] > 0): r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        share = min(max(n1 / max(n1 + n0, 1), 1e-9), 1 - 1e-9)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column(1).to_numpy() > 0
            for i, j, data, offsets in slices(b.column(0)):
                keys, pos = [], []
                for h, row in gram_rows(data, offsets):
                    order = np.lexsort((h, row))
                    h, row = h[order], row[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    keys.append(h[new])
                    pos.append(toxic[i + row[new]])
                if keys:
                    grams, number = np.unique(np.concatenate(keys), return_inverse=True)
                    one = np.bincount(number, np.concatenate(pos), len(grams)).astype(np.int64)
                    all_ = np.bincount(number, minlength=len(grams))
                    yield pa.RecordBatch.from_arrays([long_array(grams), pa.array(one), pa.array(all_ - one)], names=["h", "p", "q"])

    counts = train.mapInArrow(count, "h long, p long, q long").groupBy("h").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    p, q = F.col("p").cast("double"), F.col("q").cast("double")
    n = float(n1 + n0)

    def term(seen, kind_total: float, other):
        return F.when(seen > 0, seen * F.log(seen * n / ((p + q) * kind_total))).otherwise(0.0)

    g2 = 2 * (
        term(p, float(n1), q) + term(q, float(n0), p)
        + F.when(n1 - p > 0, (n1 - p) * F.log((n1 - p) * n / ((n - p - q) * n1))).otherwise(0.0)
        + F.when(n0 - q > 0, (n0 - q) * F.log((n0 - q) * n / ((n - p - q) * n0))).otherwise(0.0)
    )
    best = counts.filter("p + q >= 4").withColumn("g2", g2).filter(F.col("g2") >= LEAST_G2)
    rows = best.orderBy(F.desc("g2"), "h").limit(features).select("h", "p", "q").collect()
    hashes = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    pos = np.array([r["p"] for r in rows], float)[order]
    neg = np.array([r["q"] for r in rows], float)[order]
    ratio = np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n0 + 2))
    model = Model(hashes[order], ratio, 0.0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column(0)):
                row, feature = model.features(data, offsets)
                lists = list_array(pa.array(feature.astype(np.int32)), np.bincount(row, minlength=j - i))
                y = pa.array((b.column(1).to_numpy()[i:j] > 0).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(2).slice(i, j - i), y, lists], names=["doc_id", "y", "x"])

    read_rows = train.mapInArrow(read, "doc_id long, y int, x array<int>")
    table_ = read_rows.orderBy("doc_id", F.xxhash64("x")).toArrow().combine_chunks()
    y = table_["y"].to_numpy().astype(float)
    lists = table_["x"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    col = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy())
    model.weights, model.bias = regress(row, col, ratio, y)
    return model


def regress(row: np.ndarray, col: np.ndarray, ratio: np.ndarray, y: np.ndarray, steps: int = 300, l2: float = 1e-4):
    """Logistic regression on presence times ratio (adaptive gradient steps); returns folded weights and the bias."""
    n, k = len(y), len(ratio)
    w, bias = np.full(k, 0.05), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    scaled = ratio[col]
    for t in range(1, steps + 1):
        margin = np.clip(bias + np.bincount(row, w[col] * scaled, minlength=n), -30, 30)
        error = (1 / (1 + np.exp(-margin)) - y) / n
        grad = np.append(np.bincount(col, error[row] * scaled, minlength=k) + l2 * w, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w * ratio, float(bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` and ``predicted`` added."""
    hashes, weights, bias = model.hashes, model.weights, model.bias
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    text, names = docs.columns.index("text"), [*docs.columns, "__score", "__predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(hashes, weights, bias)
        for b in batches:
            got = [own.scores(data, offsets) for _, _, data, offsets in slices(b.column(text))]
            s = np.concatenate(got) if got else np.zeros(0)
            cols = [*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, ", ".join([*fields, "__score double, __predicted int"]))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not call toxic."""
    return score(docs, fit(docs, labels)).filter("__predicted = 0").select(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))
