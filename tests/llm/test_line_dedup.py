"""Line dedup and its perfect hash against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremor.llm import line_dedup
from tremor.llm.perfect_hash import PerfectHash

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))


def brute(rows, min_chars=40, min_docs=5):
    low = -(1 << 63)
    holders = defaultdict(list)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(low if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        me = low if d is None else d
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != me)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def sample(n=200, seed=1):
    rnd = random.Random(seed)
    shared = ["Shared line number %d, é long enough to count as one of them" % k for k in range(40)]
    shared += ["x" * 39, "x" * 40, "é" * 40, "É" * 40, "ß" * 39 + " ", "Z" * 40, "z" * 40, " " + "n" * 39]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rnd.choice([0, 1, 3, 9])):
            x = rnd.choice(shared) if rnd.random() < 0.6 else "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 90)))
            lines.append(rnd.choice(["", " ", "\t", "\r", "\x0b "]) + (x.upper() if x.isascii() and rnd.random() < 0.3 else x) + rnd.choice(["", "\r", "  "]))
        rows.append((rnd.randint(-5, 10**12) if i != 7 else None, "\n".join(lines) if i % 23 else None))
    rows[8] = (None, rows[7][1])
    return rows + rows[:6] + [(3, shared[0] + "\n" + shared[0] + "\n"), (10**15, "\n\n" + shared[1] + "\n" + shared[1])]


def got(docs, **more):
    out = line_dedup.edited(docs, **more).select("row.doc_id", "n_lines", "n_dropped", "kept")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_lines_match_brute_force(make_docs):
    rows = sample()
    assert got(make_docs(rows)) == brute(rows)


@pytest.mark.parametrize("probes", [1 << 21, 40])
def test_probes_at_the_shards_give_the_same_rows(make_docs, monkeypatch, probes):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    monkeypatch.setattr(line_dedup, "TASK_PROBES", probes)
    rows = sample()
    assert got(make_docs(rows), broadcast_bytes=0) == brute(rows)
    assert got(make_docs(rows)) == brute(rows)


def test_thresholds(make_docs):
    rows = sample(seed=4)
    assert got(make_docs(rows), min_chars=5, min_docs=2) == brute(rows, 5, 2)


def test_deduplicate_keeps_rows_and_columns(make_docs):
    rows = sample()
    docs = make_docs(rows).withColumn("row", F.lit("mine")).withColumn("kept", F.lit(1)).withColumn("a.b", F.lit(2))
    out = line_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    nulls = sum(t is None for _, t in rows)
    assert sum(t is None for _, t in texts) == nulls
    assert sorted(((d, t or "") for d, t in texts), key=str) == sorted(((d, t) for d, *_, t in brute(rows)), key=str)


def test_empty_table_and_empty_texts(empty_docs, make_docs):
    assert got(empty_docs) == [] and got(empty_docs, broadcast_bytes=-1) == []
    assert got(make_docs([(1, None), (2, ""), (3, "\n")])) == [(1, 1, 0, ""), (2, 1, 0, ""), (3, 2, 0, "\n")]


def test_very_long_line_and_text(make_docs):
    long = "w" * 2_000_000
    rows = [(d, long + "\n" + "tail %d" % d) for d in range(6)] + [(9, "\n".join("line %d of a text with very many lines in it" % k for k in range(60_000)))]
    assert got(make_docs(rows)) == brute(rows)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 60_000):
        raw = np.frombuffer(b"".join(hashlib.md5(b"%d" % k).digest() for k in range(n)), "<u8").reshape(-1, 2)
        hashed = PerfectHash.build(raw[:, 0], raw[:, 1])
        assert sorted(hashed.lookup(raw[:, 0], raw[:, 1]).tolist()) == list(range(n))
        other = hashed.lookup(rng.integers(0, 1 << 63, 500, np.uint64), rng.integers(0, 1 << 63, 500, np.uint64))
        assert ((other >= -1) & (other < max(1, n))).all()
        assert len(hashed.words) * 64 <= 8 * n + 640
