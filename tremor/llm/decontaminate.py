"""Benchmark decontamination by greedy string tiling.

Words are runs of bytes other than 0x20 and 0x09-0x0D of the lower-cased text. Seeds are
runs of ``MIN_MATCH`` words. Documents and benchmark items are joined on
shared seeds; before that a bit table of fixed size, filled from the
benchmark's seeds, drops all other seeds while the documents are read, so what
travels grows with the contaminated text, not with the corpus. For each
(document, item) pair the longest common word runs are found by running
Karp-Rabin and marked as tiles, longest first and never overlapping, down to
``MIN_MATCH`` words. An item is leaked where its tiles cover ``COVERAGE`` of its
words in any order, so reordered passages count as well.

Defined cases: null texts count as empty; items with fewer than ``MIN_MATCH``
words can leak only as a whole (their single seed is the whole item); items
without words never leak; repeated items and rows give repeated results; ties
between items: the least item_id is reported; an empty table gives no rows (an
empty benchmark leaves all documents clean); other columns are kept by
``decontaminate`` and ignored by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.anchors import NULL_ID, keyed
from tremor.llm.common import gram_hashes, list_array, long_array, materialize, slices, text_key, word_hashes, words
from tremor.session import table

MIN_MATCH = 5
COVERAGE = 0.7
TABLE_BITS = 22


def _seeds(data: np.ndarray, offsets: np.ndarray, size: int):
    """(seed hashes, first word, last word + 1, row): runs of ``size`` words, and whole shorter texts."""
    starts, ends, row = words(data, offsets, False)
    hashes = word_hashes(data, starts, ends)
    grams = gram_hashes(hashes, size)
    at = np.flatnonzero(row[: len(grams)] == row[size - 1 :]) if len(grams) else np.zeros(0, np.int64)
    return starts, ends, row, hashes, grams, at


def _short(hashes: np.ndarray, row: np.ndarray, n_rows: int, size: int):
    """(hash, row) of whole texts with fewer than ``size`` words."""
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    for k in range(1, size):
        r = np.flatnonzero(count == k)
        if len(r):
            yield gram_hashes(hashes, k)[first[r]], r, k


def item_seeds(benchmark: DataFrame, size: int) -> DataFrame:
    """item_id, n_words, seed for every distinct seed of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in slices(b.column(1)):
                _, _, row, hashes, grams, at = _seeds(data, offsets, size)
                parts = [(grams[at], row[at])] + [(h, r) for h, r, _ in _short(hashes, row, j - i, size)]
                seed, r = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                ids = b.column(0).slice(i, j - i).take(pa.array(r))
                n = np.bincount(row, minlength=j - i)[r]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), long_array(seed)], names=["item_id", "n_words", "seed"])

    return benchmark.select("item_id", "text").mapInArrow(run, "item_id long, n_words long, seed long").distinct()


def seed_table(seeds: DataFrame, bits: int) -> bytes:
    """Bit table of ``2**bits`` bits holding every seed; its size does not depend on the benchmark."""
    slots = seeds.select(F.pmod("seed", F.lit(1 << bits)).alias("s")).distinct()
    words_ = slots.groupBy(F.floor(F.col("s") / 8).cast("int").alias("byte")).agg(
        F.bit_or(F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), F.col("s") % 8).cast("int")).alias("bits")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    got = words_.toArrow()  # at most 2**(bits - 3) rows
    out[got["byte"].to_numpy()] = got["bits"].to_numpy()
    return out.tobytes()


def seed_hits(texts: DataFrame, filled: bytes, size: int, longest_short: int, bits: int) -> DataFrame:
    """uid, th, seeds, runs: the seeds of each document that may be shared, and the words they cover.

    ``runs`` joins neighbouring covered words by spaces and separate runs by newlines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(filled, np.uint8), bitorder="little").astype(bool)
        low = np.uint64((1 << bits) - 1)
        for b in batches:
            uid, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j, data, offsets in slices(b.column(2)):
                starts, ends, row, hashes, grams, at = _seeds(data, offsets, size)
                place = at[known[grams[at] & low]]
                found, seeds = [(place, size)], [grams[place]]
                for k in range(1, min(size, longest_short + 1)):  # seeds of items shorter than ``size``
                    g = gram_hashes(hashes, k)
                    a = np.flatnonzero(row[: len(g)] == row[k - 1 :]) if len(g) else np.zeros(0, np.int64)
                    a = a[known[g[a] & low]]
                    found.append((a, k))
                    seeds.append(g[a])
                place = np.concatenate([a for a, _ in found])
                if not len(place):
                    continue
                change = np.zeros(len(row) + 1, np.int64)
                for a, k in found:
                    np.add.at(change, a, 1)
                    np.add.at(change, a + k, -1)
                covered = np.flatnonzero(np.cumsum(change[:-1]) > 0)
                seed = np.concatenate(seeds)
                seed_row = row[place]
                order = np.lexsort((seed, seed_row))
                seed, seed_row = seed[order], seed_row[order]
                new = np.ones(len(seed), bool)
                new[1:] = (seed[1:] != seed[:-1]) | (seed_row[1:] != seed_row[:-1])
                seed, seed_row = seed[new], seed_row[new]
                rows = np.unique(seed_row)
                counts = np.bincount(seed_row, minlength=j - i)[rows]
                edges = np.searchsorted(row[covered], np.append(rows, j - i))
                runs = []
                for x in range(len(rows)):
                    part = covered[edges[x] : edges[x + 1]]
                    out = bytearray()
                    for n, w in enumerate(part):
                        if n:
                            out += b" " if w == part[n - 1] + 1 else b"\n"
                        out += data[starts[w] : ends[w]].tobytes()
                    runs.append(bytes(out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[i + rows]), pa.array(th[i + rows]), list_array(long_array(seed), counts), pa.array(runs, pa.binary())],
                    names=["uid", "th", "seeds", "runs"],
                )

    return texts.select("uid", "th", "text").mapInArrow(run, "uid long, th long, seeds array<bigint>, runs binary")


BASE, PRIME = 1_000_003, (1 << 61) - 1


def rolling(tokens: list, marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every unmarked run of ``size`` tokens, the hash kept running."""
    top = pow(BASE, size - 1, PRIME)
    h = n = 0
    for i, t in enumerate(tokens):
        if marked[i]:
            h = n = 0
            continue
        if n == size:
            h = (h - tokens[i - size] * top) % PRIME
            n -= 1
        h = (h * BASE + t) % PRIME
        n += 1
        if n == size:
            yield i - size + 1, h


def tiles(item: list[int], doc: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, doc start, length): longest common unmarked runs first, none overlapping."""
    used_item, used_doc = [False] * len(item), [t < 0 for t in doc]
    size, out = max(shortest, min(len(item), len(doc)) // 2), []
    while True:
        table_: dict[int, list[int]] = {}
        for a, h in rolling(item, used_item, size):
            table_.setdefault(h, []).append(a)
        found = []
        for b, h in rolling(doc, used_doc, size):
            for a in table_.get(h, ()):
                if item[a : a + size] != doc[b : b + size]:
                    continue
                n = size
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and not (used_item[a + n] or used_doc[b + n]):
                    n += 1
                found.append((-n, a, b))
        again = False
        for n, a, b in sorted(found):
            if any(used_item[a : a - n]) or any(used_doc[b : b - n]):
                again = True  # part of it may still be free
                continue
            used_item[a : a - n] = [True] * -n
            used_doc[b : b - n] = [True] * -n
            out.append((a, b, -n))
        if again:
            continue
        if size == shortest:
            return out
        size = max(shortest, size // 2)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, size: int = MIN_MATCH, bits: int = TABLE_BITS) -> DataFrame:
    """uid, th, item_id, coverage of every leaked item of every document with leaks."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text")).distinct()
    seeds = materialize(item_seeds(items, size), "seeds")
    short = seeds.filter(F.col("n_words") < size).agg(F.max("n_words")).first()[0] or 0
    texts = keyed(docs).withColumn("text", F.lower("text"))
    hits = materialize(seed_hits(texts, seed_table(seeds, bits), size, int(short), bits).distinct(), "seed-hits")
    pairs = (
        hits.select("uid", "th", F.explode("seeds").alias("seed")).join(seeds, "seed").select("uid", "th", "item_id").distinct()
    )
    full = pairs.join(items, "item_id").join(hits.select("uid", "th", "runs"), ["uid", "th"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, share = [], []
            texts_, runs = b.column(3).to_pylist(), b.column(4).to_pylist()
            for r in range(b.num_rows):
                data = np.frombuffer(texts_[r].encode(), np.uint8)
                starts, ends, _ = words(data, np.array([0, len(data)]), False)
                item = [data[s:e].tobytes() for s, e in zip(starts, ends)]
                number = {w: k + 1 for k, w in enumerate(dict.fromkeys(item))}
                doc: list[int] = []
                for part in runs[r].split(b"\n"):
                    doc += [number.get(w, 0) or -1 for w in part.split(b" ")] + [-1]
                shortest = min(size, len(item))
                got = sum(n for *_, n in tiles([number[w] for w in item], doc, shortest)) / len(item)
                if got >= coverage:
                    keep.append(r)
                    share.append(got)
            if keep:
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).take(at) for k in range(3)), pa.array(share, pa.float64())], names=["uid", "th", "item_id", "coverage"]
                )

    return full.select("uid", "th", "item_id", "text", "runs").mapInArrow(run, "uid long, th long, item_id long, coverage double")


def report(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, size: int = MIN_MATCH) -> DataFrame:
    """doc_id, contaminated, n_items, item_id and coverage of the best covered leaked item, for every document."""
    found = leaks(docs, benchmark, coverage, size).groupBy("uid", "th").agg(
        F.count("*").alias("n_items"), F.max(F.struct("coverage", -F.col("item_id"))).alias("best")
    )
    best = found.select("uid", "th", "n_items", F.col("best.coverage").alias("coverage"), (-F.col("best.col2")).alias("item_id"))
    return keyed(docs).select("uid", "th").join(best, ["uid", "th"], "left").select(
        F.when(F.col("uid") != NULL_ID, F.col("uid")).alias("doc_id"),
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        "item_id",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, size: int = MIN_MATCH) -> DataFrame:
    """The documents that hold no leaked item."""
    found = leaks(docs, benchmark, coverage, size).select("uid", "th").distinct()
    uid = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    rows = docs.select(F.struct("*").alias("row"), uid.alias("uid"), text_key(F.col("text")).alias("th"))
    return rows.join(found, ["uid", "th"], "left_anti").select("row.*")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document held against every benchmark item."""
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
