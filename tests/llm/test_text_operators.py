"""Chat formatting, URL filter, fingerprints, toxicity, decontamination, pipeline and the registered queries."""

import hashlib
import os
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
import corpus_pipeline
from tremor.llm import chat, decontaminate, imatch, queries, toxicity, urls
from tremor.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(r[k] for k in order) for r in ([None if v is None else str(v) for v in row] for row in rows)) if not any(
        v is None for row in rows for v in row
    ) else sorted((str([r[k] for k in order]) for r in rows))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert multiset(df.columns, [tuple(r) for r in df.collect()]) == multiset(rel.columns, rel.fetchall())


def test_all_queries_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


# chat -----------------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "[~INST]", "<~~/s>", "a[+]b", "[:]", "[ASST]x</s>", "<", "[", "<<s>", "", None, "~", "[/INST", "s>", "$1\\"]


def test_chats_read_back(spark):
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "x[:]", None]), rnd.choice(TRICKY)) for c in [1, 2, 3, None] for t in range(25)]
    rows += [(9, 0, "user", "tie"), (9, 0, "user", "tie"), (9, None, "assistant", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_chats(chat.format_chats(turns)).collect()}
    for c in (1, 2, 3, None, 9):
        mine = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x in rows if k == c))
        assert [tuple(t) for t in back[c].turns] == [(r, x) for _, r, x in mine]
        assert back[c].loss_texts == [x for _, r, x in mine if r == "assistant"]


def test_chats_merge_adjacent_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert got.formatted == "<s>[INST]user[:]a[+]b[/INST][ASST]c[+]d</s>"
    assert [got.formatted[s : s + n] for s, n in got.loss_mask] == ["c", "d"]


def test_chats_stay_native(spark):
    plan = chat.op10_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_chats(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# urls -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "url, expected",
    [
        (None, ("", "", None, "allow")),
        ("no scheme casino", ("", "", None, "block")),
        ("http://a.EXAMPLE.org/es/1?x#y", ("a.example.org", "/es/1", "example.org/es/", "block")),
        ("http://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")),
        ("http://notexample.org/es/1", ("notexample.org", "/es/1", "org/", "allow")),
        ("http://x.org", ("x.org", "", None, "allow")),
        ("http://com/fr/casino", ("com", "/fr/casino", "com/fr/", "allow")),
        ("http://x.net#a/de/", ("x.net", "", None, "allow")),
        ("http://mycasino.net/", ("mycasino.net", "/", None, "allow")),
        ("http://my-casino.net/", ("my-casino.net", "/", None, "block")),
        ("http://free.net/free", ("free.net", "/free", None, "allow")),
        ("http://free.net/bets", ("free.net", "/bets", None, "block")),
        ("http://ÄB.net/é", ("Äb.net", "/é", None, "allow")),
    ],
)
def test_urls(url, expected):
    assert urls.UrlFilter(urls.RULES, urls.STRICT, urls.SOFT, urls.MIN_SOFT).judge(url) == expected


def test_url_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "h"), (None, None, None)], "page_id long, url string, host string")
    assert sorted(urls.judge_urls(pages).collect(), key=str) == [(1, "a.org", "/", "org/", "allow"), (None, "", "", None, "allow")]
    assert urls.judge_urls(pages.limit(0)).count() == 0


# fingerprints -----------------------------------------------------------------


def test_fingerprints(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_DOCS", 4)
    rnd = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(d, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 80)))) for d in rnd.sample(range(10_000), 150)]
    rows += [(20_000, rows[0][1]), (20_001, None), (20_002, ""), (None, "null id"), (20_003, "!!! ß é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in imatch.op5_imatch(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        edited = t[: len(t) - h] + after[:h]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    assert got[20_000].fingerprint == got[rows[0][0]].fingerprint
    assert got[20_001].fingerprint == got[20_002].fingerprint != got[20_003].fingerprint
    assert got[20_002].near_next == 1.0  # the empty text is followed by the null text
    near = sorted(r.near_edited for r in got.values())
    assert near[len(near) // 2] > sorted(r.near_next for r in got.values())[len(near) // 2]


def test_fingerprints_stay_native(spark):
    plan = imatch.op5_imatch(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_no_and_one_document(spark, tmp_path):
    for n in (0, 1):
        spark.createDataFrame([(4, "just one")][:n], "doc_id long, text string").write.parquet(f"{tmp_path}/{n}/documents.parquet")
        got = imatch.op5_imatch(spark, f"{tmp_path}/{n}").collect()
        assert len(got) == n
    assert got[0].edited_sha256 == hashlib.sha256(b"justjust").hexdigest()


# toxicity -----------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).drop("text").collect()}
    held = [(r.toxic, scored[r.doc_id]) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(t == s["__predicted"] for t, s in held) / len(held) > 0.97
    assert sum(s["__predicted"] for t, s in held if t) / sum(t for t, _ in held) > 0.85


def test_toxicity_edge_cases(spark, make_docs, empty_docs):
    rows = [(k, ("you stupid clown " if k % 3 == 0 else "a calm and friendly text ") * 3) for k in range(60)] + [(100, None), (101, ""), (None, "ß")]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(k, 1 if k % 3 == 0 else 0) for k in range(60)] + [(2, None), (None, 1), (777, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(out) == len(rows) and all(out[k]["__predicted"] == (k % 3 == 0) for k in range(60))
    assert out[100]["__score"] == out[101]["__score"] == out[None]["__score"]
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {k for k in range(60) if k % 3}
    nothing = toxicity.fit(docs, labels.limit(0))
    assert all(r["__predicted"] == 0 for r in toxicity.score(docs, nothing).collect())
    assert toxicity.reject(empty_docs, labels).count() == 0


def test_toxicity_grams_match_plain_loops():
    import numpy as np

    texts = ["Straße ÄÖ 12 😀x", "", "abcdef"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    got = [np.bincount(row, minlength=3).tolist() for _, row in toxicity.gram_rows(np.frombuffer(b"".join(raw), np.uint8), offsets)]
    assert got == [[max(0, len(t) - n + 1) for t in texts] for n in toxicity.SIZES]


# decontamination ------------------------------------------------------------------

tokens = st.lists(st.integers(1, 6), max_size=40)


@settings(max_examples=80, deadline=None)
@given(tokens, tokens)
def test_tiles_are_common_runs_and_maximal(item, doc):
    got = decontaminate.tiles(item, doc, 3)
    used_item, used_doc = set(), set()
    for a, b, n in got:
        assert n >= 3 and item[a : a + n] == doc[b : b + n]
        assert not used_item & set(range(a, a + n)) and not used_doc & set(range(b, b + n))
        used_item |= set(range(a, a + n))
        used_doc |= set(range(b, b + n))
    for a in range(len(item) - 2):  # nothing of the least length is left on both sides
        for b in range(len(doc) - 2):
            if item[a : a + 3] == doc[b : b + 3]:
                assert used_item & set(range(a, a + 3)) or used_doc & set(range(b, b + 3))


def test_leaks(spark, make_docs, empty_docs):
    rnd = random.Random(3)

    def words(n):
        return [f"t{rnd.randint(0, 10**6)}" for _ in range(n)]

    items = [words(30) for _ in range(6)]
    bench = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in enumerate(items)] + [(6, "two words"), (7, None), (8, ""), (9, " ".join(items[0]))],
        "item_id long, text string",
    )
    glue = lambda *parts: "  ".join(" ".join(words(20)) + "\n" + " ".join(p).upper() for p in parts)
    rows = [(1, glue(items[1])), (2, glue(items[2][15:], items[2][:15])), (3, glue(items[3][:12])), (4, " ".join(words(200)))]
    rows += [(5, "here are two words"), (6, None), (7, ""), (8, glue(items[0], items[4])), (8, glue(items[0], items[4])), (None, glue(items[5]))]
    got = decontaminate.report(make_docs(rows), bench).collect()
    assert len(got) == len(rows)
    found = {(r.doc_id, r.n_items, r.item_id) for r in got if r.contaminated}
    assert found == {(1, 1, 1), (2, 1, 2), (5, 1, 6), (8, 3, 0), (None, 1, 5)}
    clean = decontaminate.decontaminate(make_docs(rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 6, 7] and clean.columns == make_docs(rows).columns
    assert decontaminate.report(empty_docs, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(make_docs(rows), bench.limit(0)).collect())


# pipeline ----------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 100
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_pipeline_of_no_documents(spark, empty_docs, tmp_path):
    empty_docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, os.fspath(tmp_path)).count() == 0
