"""Importance resampling and the radix sort against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremor.llm import radix_sort, resample
from tremor.llm.common import materialize

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(lower)
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, min_words=20, seed=42, size=10_000):
    def count(texts):
        out = [0] * size
        for t in texts:
            for g in grams(t)[1]:
                out[zlib.crc32(g.encode()) % size] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + size) / ((a + 1) * (sum(t) + size)))) for a, b in zip(s, t)]
    rows = []
    for d, text in docs:
        w, g = grams(text)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(x.encode()) % size] for x in g)
        rows.append([d, len(w), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], -(1 << 63) if r[0] is None else r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def sample(n=400, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "a1", "été", "日本語", "Straße", "x" * 70, "of", "İ", "naïve", "wordy", "zz9"]
    rows = []
    for i in range(n):
        parts = [rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "_", "--", "\t"]) for _ in range(rnd.choice([0, 3, 19, 20, 21, 60]))]
        rows.append((i * 7919 - 5 if i != 9 else None, "".join(parts) if i % 37 else None))
    return rows + [(-(10**15), "the of " * 30), (10**15, "a1 " * 25)]


def test_scores_and_ranks_match_brute_force(spark, make_docs):
    rows, target = sample(), ["the of the", "été wordy", None, ""]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resample.rank(resample.score(make_docs(rows), bench), percent=30)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, percent=30)


def test_drawn_documents_keep_their_columns(spark, make_docs):
    rows, target = sample(), ["the of the", "été wordy"]
    docs = make_docs(rows).withColumn("score", F.lit("mine")).withColumn("row", F.lit(1))
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    out = resample.resample(docs, bench, percent=30)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in brute(rows, target, percent=30) if r[5])


def test_repeated_rows_have_ranks_of_their_own(spark, make_docs):
    rows = [(5, "the " * 30)] * 4 + [(6, "of " * 30)] * 2
    bench = spark.createDataFrame([("the",)], "text string")
    got = resample.rank(resample.score(make_docs(rows), bench), percent=100).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5, 6]
    order = [r.doc_id for r in sorted(got, key=lambda r: r["rank"])]
    assert order in ([5] * 4 + [6] * 2, [6] * 2 + [5] * 4)


def test_empty_tables(spark, empty_docs, make_docs):
    none = spark.createDataFrame([], "text string")
    assert resample.rank(resample.score(empty_docs, none)).count() == 0
    assert resample.resample(empty_docs, none).count() == 0
    assert resample.rank(resample.score(make_docs([(1, None), (2, "")]), none)).filter("n_features = 0 and rank is null").count() == 2


def test_long_words_and_texts(spark, make_docs):
    rows = [(1, "y" * 3_000_000), (2, "word " * 400_000), (3, "ab cd")]
    bench = spark.createDataFrame([("ab cd",)], "text string")
    got = resample.rank(resample.score(make_docs(rows), bench), percent=100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, ["ab cd"], percent=100)


@pytest.mark.parametrize("digit_bits, block_bits, group_bits", [(14, 12, 12), (5, 4, 2)])
def test_radix_sort_is_a_stable_sort(spark, monkeypatch, digit_bits, block_bits, group_bits):
    for name, v in (("DIGIT_BITS", digit_bits), ("BLOCK_BITS", block_bits), ("GROUP_BITS", group_bits)):
        monkeypatch.setattr(radix_sort, name, v)
    rnd = random.Random(5)
    rows = [(rnd.choice([0, 0, 0, -3, 7, 10**6]), rnd.randint(-(10**4), 10**4) if i % 3 else 4, i) for i in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5).withColumn("_at", F.monotonically_increasing_id())
    df = materialize(df, "radix-test")
    first = {r.i: r._at for r in df.collect()}
    got = [(r.a, r.b, first[r.i]) for r in radix_sort.sort_positions(df, ["a", "b"]).orderBy("position").collect()]
    assert got == sorted((a, b, first[i]) for a, b, i in rows)


def test_checksums_carry_on():
    data = np.frombuffer("ab héllo wörld".encode() * 30, np.uint8)
    starts, ends = np.array([0, 3, 9, 0]), np.array([2, 9, 9, 300])
    state = resample.extend(np.full(4, resample.ONES), data, starts, ends) ^ resample.ONES
    assert [int(x) for x in state] == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_only_rows_that_can_be_drawn_are_sorted(spark, make_docs, monkeypatch):
    rows, target = sample(), ["the of the", "été wordy"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    sorted_rows, sort = [], resample.sort_positions

    def counting(df, keys):
        sorted_rows.append(df.count())
        return sort(df, keys)

    monkeypatch.setattr(resample, "sort_positions", counting)
    got = resample.rank(resample.score(make_docs(rows), bench), percent=5).collect()
    expected = brute(rows, target, percent=5)
    drawn = sum(r["rank"] is not None for r in got)
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert 0 < drawn <= sorted_rows[0] <= 2 * drawn + 10
