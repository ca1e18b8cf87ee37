"""Byte, word and near-copy deduplication against brute force."""

import random

import numpy as np
import pytest

import brute
from tremor.llm import anchors, jaccard_join, substring_dedup, suffix_dedup
from tremor.llm.components import components
from tremor.llm.fm_index import FMIndex


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def mixed_rows(seed, make, pieces, n=150):
    """Texts glued from shared pieces; copies, runs, nulls, empties, repeated rows and a null id."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t = "".join(rnd.choice(pieces + [make(rnd, rnd.randint(0, 60))] * 3) for _ in range(rnd.randint(0, 4)))
        if rows and rnd.random() < 0.15:
            t = rnd.choice(rows)[1]
        if rnd.random() < 0.05:
            t = "a " * rnd.randint(0, 60)
        rows.append((i if i != 7 else None, t if rnd.random() < 0.95 else None))
    return rows + rows[:4]


def letters(rnd, n):
    return "".join(rnd.choice("abc é") for _ in range(n))


def some_words(rnd, n):
    return " ".join(rnd.choice(["a", "b", "é", "the", "of", str(rnd.randint(0, 50))]) for _ in range(n)) + rnd.choice([" ", "\n"])


@pytest.fixture()
def small_groups(monkeypatch):
    monkeypatch.setattr(anchors, "SPLIT", 3)
    monkeypatch.setattr(anchors, "CONTEXTS", 40)


def byte_rows():
    rnd = random.Random(1)
    return mixed_rows(2, letters, [letters(rnd, n) for n in (25, 45, 60)])


def test_bytes_match_brute_force(make_docs):
    rows = byte_rows()
    assert rows_of(suffix_dedup.report(make_docs(rows), 24)) == sorted(brute.byte_dedup(rows, 24), key=str)


def test_bytes_match_when_groups_are_split(make_docs, small_groups):
    rows = byte_rows()
    assert rows_of(suffix_dedup.report(make_docs(rows), 24)) == sorted(brute.byte_dedup(rows, 24), key=str)


def test_window_with_its_anchor_at_several_places_is_one_place(make_docs, small_groups):
    """Unique texts around a short periodic run: its gram recurs in one window, but windows at the edges occur once."""
    rnd = random.Random(12)

    def unique(n):
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    rows = [(10 * k + j, unique(30) + unit * 9 + unique(30)) for k, unit in enumerate(("a ", "- ", "xy", "* ", "q.", "==")) for j in range(8)]
    assert rows_of(suffix_dedup.report(make_docs(rows), 24)) == sorted(brute.byte_dedup(rows, 24), key=str)


def test_cut_keeps_rows_and_columns(make_docs):
    rows = byte_rows()
    docs = make_docs(rows)
    out = suffix_dedup.cut(docs, 24)
    assert out.columns == docs.columns and out.count() == len(rows)
    kept = {d: n - g for d, n, g, *_ in brute.byte_dedup(rows, 24)}
    for r in out.collect():
        assert r.text is None or len(r.text.encode()) <= kept[r.doc_id]
        assert r.text is None or r.n_chars == len(r.text)


def test_very_long_text(make_docs):
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(700_000))
    rows = [(1, long), (2, "x" * 50 + long[300_000:300_400] + "y" * 50)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(make_docs(rows)).collect()}
    assert got == {1: (700_000, 400, 1), 2: (500, 400, 1)}


def word_rows():
    rnd = random.Random(4)
    return mixed_rows(5, some_words, [some_words(rnd, n) for n in (10, 18, 25, 14)])


@pytest.mark.parametrize("length", [13, 9])
def test_words_match_brute_force(make_docs, length):
    rows = word_rows()
    assert rows_of(substring_dedup.report(make_docs(rows), length)) == sorted(brute.word_dedup(rows, length), key=str)


def test_words_match_when_groups_are_split(make_docs, small_groups):
    rows = word_rows()
    assert rows_of(substring_dedup.report(make_docs(rows))) == sorted(brute.word_dedup(rows, 13), key=str)


def test_fm_index_counts_patterns():
    import numpy as np

    rng = np.random.default_rng(6)
    text = np.concatenate([[0], rng.integers(1, 6, 300), [0]])
    patterns = rng.integers(1, 7, (200, 4))
    lo, hi, matched = FMIndex(text, 16).search(patterns)
    windows = [tuple(text[i : i + 4]) for i in range(len(text) - 3)]
    for p, a, b, m in zip(patterns, lo, hi, matched):
        assert (b - a if m == 4 else 0) == windows.count(tuple(p))


def near_rows():
    rnd = random.Random(7)

    def text(n):
        return " ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 9)) for _ in range(n))

    base, rows = [text(n) for n in (3, 4, 6, 9, 14, 20, 40, 80, 200)], []
    for i in range(300):
        w = rnd.choice(base).split() if rnd.random() < 0.75 else text(rnd.randint(0, 12)).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
            w.insert(rnd.randint(0, len(w)), text(1))
        rows.append((i if i != 11 else None, rnd.choice([" ".join(w), " ".join(w).upper()]) if i % 40 else None))
    return rows + rows[:3] + [(3, base[5]), (3, base[6])]


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_near_copies_match_brute_force(make_docs, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = near_rows()
    out = jaccard_join.link_components(make_docs(rows))
    got = [(d if d != brute.NULL_ID else None, n, c if c != brute.NULL_ID else None) for d, _, n, c in map(tuple, out.select("uid", "th", "n_shingles", "component").collect())]
    assert sorted(got, key=str) == sorted(brute.jaccard(rows, 85, 100, 4), key=str)


def test_deduplicate_keeps_one_of_each_group(make_docs):
    rows = near_rows()
    docs = make_docs(rows)
    out = jaccard_join.deduplicate(docs, 80, 100, 5)
    groups = {c for _, _, c in brute.jaccard(rows, 80, 100, 5)}
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(map(str, groups))


def test_pipeline_judges_texts_that_share_an_id_by_themselves(spark, make_docs):
    import corpus_pipeline

    rnd = random.Random(13)

    def text():
        return " ".join(str(rnd.randint(0, 999)) for _ in range(60))

    texts = [text() for _ in range(40)]
    rows = [(None, t) for t in texts[:20]] + [(5, t) for t in texts[20:]]  # nothing is similar
    rows += [(100, texts[0] + " end"), (101, texts[1] + " end")]  # near copies of two documents without id
    rows += [(5, texts[25]), (None, texts[3])]  # repeated rows
    rows += [(6, texts[0] + " end"), (7, texts[39] + " end")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, make_docs(rows), "").collect()]
    assert sorted(got, key=str) == sorted(rows[:40], key=str)


def test_empty_tables(empty_docs):
    for f in (suffix_dedup.report, suffix_dedup.cut, substring_dedup.report, jaccard_join.link_components, jaccard_join.deduplicate):
        assert f(empty_docs).count() == 0


def thue_morse(n, flip):
    return "".join("ab"[(bin(k).count("1") + flip) % 2] for k in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_a_pattern_and_its_complement_differ(make_docs, n):
    head = " ".join(f"w{k}" for k in range(12))
    rows = [(1, f"{head} {thue_morse(n, 0)}"), (2, f"{head} {thue_morse(n, 1)}"), (3, thue_morse(n, 0)), (4, thue_morse(n, 1))]
    assert rows_of(substring_dedup.report(make_docs(rows))) == sorted(brute.word_dedup(rows, 13), key=str)
    got = jaccard_join.link_components(make_docs(rows)).select("uid", "component")
    assert rows_of(got) == sorted([(d, c) for d, _, c in brute.jaccard(rows, 85, 100, 4)], key=str)
    assert rows_of(suffix_dedup.report(make_docs(rows), 200)) == sorted(brute.byte_dedup(rows, 200), key=str)


def test_rows_without_id_whose_texts_agree_in_32_hash_bits(spark, make_docs):
    """xxhash64 of the first two texts agrees in its low 32 bits."""
    from tremor.llm import decontaminate

    rows = [(None, "text number 106349"), (None, "text number 378502"), (7, "a clean row")]
    docs = make_docs(rows)
    assert rows_of(suffix_dedup.report(docs, 24)) == sorted(brute.byte_dedup(rows, 24), key=str)
    assert rows_of(substring_dedup.report(docs, 13)) == sorted(brute.word_dedup(rows, 13), key=str)
    assert suffix_dedup.cut(docs, 24).count() == jaccard_join.deduplicate(docs, by_text=True).count() == 3
    benchmark = spark.createDataFrame([(1, "nothing of this occurs in any row at all here")], "item_id long, text string")
    assert decontaminate.decontaminate(docs, benchmark).count() == 3


def test_column_names_with_dots_and_keys_of_our_own(spark, make_docs):
    from pyspark.sql import functions as F

    from tremor.llm import decontaminate

    docs = make_docs([(1, "some text"), (2, "other text")]).withColumn("a.b", F.lit(1)).withColumn("th", F.lit("mine")).withColumn("__uid", F.lit("x"))
    benchmark = spark.createDataFrame([(1, "nothing of this occurs in any row at all here")], "item_id long, text string")
    for out in (decontaminate.decontaminate(docs, benchmark), jaccard_join.deduplicate(docs, by_text=True), suffix_dedup.cut(docs)):
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("num", [80, 85, 95])
def test_linked_sets_agree_in_more_digests_than_they_may_leave_out(num):
    rnd = np.random.default_rng(num)
    segments = jaccard_join.Segments(num, 100, 2000)
    for _ in range(400):
        n = int(rnd.integers(1, 400))
        base = rnd.integers(1, 1 << 62, n * 2).astype(np.uint64)
        a, b = np.unique(base[:n]), np.unique(base[int(rnd.integers(0, n // 8 + 1)) : n + int(rnd.integers(0, n // 8 + 1))])
        both = len(np.intersect1d(a, b))
        if both * 100 < num * (len(a) + len(b) - both):
            continue
        row = np.repeat([0, 1], [len(a), len(b)])
        digest, owner, spare = segments.digests(np.concatenate([a, b]), row, 2)
        common = np.intersect1d(digest[owner == 0], digest[owner == 1])
        # at least in one band's segments, what both keep after leaving out their spares still meets
        kept = []
        for x in (0, 1):
            mine = []
            for up in (0, 1):
                at = (owner == x) & (spare & 1 == up)
                shared = np.sort(np.intersect1d(digest[at], common))
                mine.append(shared[int((spare[at] >> 1).max(initial=0)) :])
            kept.append(np.concatenate(mine))
        assert len(np.intersect1d(*kept)), (len(a), len(b), both)


def test_star_edges_keep_components_with_few_edges(spark):
    """A group whose documents share the same roots: one edge per document and one per root, not one per pair of both."""
    roots, docs = range(10), range(100, 200)
    meets = spark.createDataFrame([(d, r) for d in docs for r in roots] + [(900, 800)], "uid long, root long")
    edges = jaccard_join.star_edges(meets)
    assert edges.count() == len(docs) + len(roots) - 1 + 1
    got = {(r.id, r.label) for r in components(edges).collect()}
    assert got == {(x, 0) for x in [*docs, *roots] if x} | {(900, 800)}
