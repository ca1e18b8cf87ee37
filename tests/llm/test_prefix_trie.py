"""The conversation prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tremor.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string"


def rebuild(rows, family, heads):
    def order(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = own.get(c - c % family, [])[:h] + turns[h:]
    return out


def brute(rows, family=100, heads=6):
    convs = rebuild(rows, family, heads)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        kids = sum(len(n) == len(node) + 1 for n in below)
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.trie(df, **more).collect()), key=str)


def sample(seed, n=60, step=1):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        c = k * step
        if rnd.random() < 0.1:
            continue
        for t in range(rnd.choice([1, 2, 2, 3, 5, 8])):
            turn = None if rnd.random() < 0.1 else t
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "é日", "", None, "hello", "hello"])))
    return rows + rows[:3] + [(None, 0, "user", "nobody's")]


@pytest.mark.parametrize("seed, family", [(1, 10), (2, 100), (3, 7)])
def test_nodes_match_brute_force(spark, seed, family):
    rows = sample(seed)
    assert got(spark, rows, family=family) == brute(rows, family)


def test_copies_and_proper_prefixes(spark):
    turns = [("user", "one"), ("assistant", "two"), ("user", "three")]
    rows = [(c, k, *t) for c in range(100, 9000, 13) for k, t in enumerate(turns[: 1 + c % 3])]
    assert got(spark, rows) == brute(rows)


def test_absent_base_and_turnless_conversation(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 3)
    rows = [(c, 0, "user", "gone"), (c, 1, "assistant", "gone too")]
    assert got(spark, rows) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_long_conversation_and_texts(spark):
    rows = [(0, k, "user", "x" * (k % 5)) for k in range(3000)] + [(1, 0, "user", "y" * 1_000_000), (2, 0, "user", "y" * 1_000_000)]
    out = got(spark, rows)
    assert len(out) == len({tuple(t[:d]) for t in rebuild(rows, 100, 6).values() for d in range(len(t) + 1)})
    assert max(r[1] for r in out) == 3000


def test_end_lists_are_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RANGE_BITS", 2)
    rows = [(c, 0, "user", "same") for c in range(0, 5000, 100)] + [(c, 0, "user", "same") for c in range(1, 60)]
    assert got(spark, rows) == brute(rows)
