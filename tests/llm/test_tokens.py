"""Tokenization, token files and packing: exact round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.llm import coder, packing, token_files
from tremor.llm.common import shared_path
from tremor.llm.tokens import Encoder, tokenizer_path

ODD = ["", "  a  b", "can't ''s 's x", "\n\n \t a b 12３４ é́ 日本語 <|endoftext|>x", "   ", "a" * 3000, "'s't 'll  'l"]


@pytest.fixture(scope="module")
def enc():
    return Encoder(tokenizer_path())


def plain(enc, text, end):
    return enc.tokenizer.encode(text, add_special_tokens=False).ids + [end]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_encoder_equals_the_library(texts):
    e = Encoder.shared = getattr(Encoder, "shared", None) or Encoder(tokenizer_path())
    texts = texts + ODD
    ids, sizes = e.encode(texts, 2)
    ends = np.cumsum(sizes)
    for t, n, z in zip(texts, sizes, ends):
        assert ids[z - n : z].tolist() == plain(e, t, 2)


def test_piece_ends_by_bytes_equal_the_library_s_words(enc):
    """Ids and ids per piece of the fast form, whose pieces are told by bytes, against the form that numbers words."""
    pieces = [" and,", " of", "12３４", " é́日本", "\n\n", " 😀x", "</s>", "a" * 300]
    full = enc.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
    ids, lengths = enc._encoded(pieces)
    assert ids.tolist() == full.ids
    assert lengths.tolist() == np.bincount(full.word_ids, minlength=len(pieces)).tolist()
    assert enc.id_bytes[ids].sum() == len("".join(pieces).encode())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 5, 300, 65535, 257, 1024]), max_size=200), max_size=6))
def test_coder_round_trip(blocks):
    blocks = [np.array(b, np.uint16) for b in blocks]
    codes = coder.encode_blocks(blocks)
    back = coder.decode_blocks(codes, np.array([len(b) for b in blocks]))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_coder_learns_and_handles_random_ids():
    rng = np.random.default_rng(1)
    noise = [rng.integers(0, 1 << 16, n).astype(np.uint16) for n in (0, 1, 2, 1025, 4096)]
    regular = [np.tile(rng.integers(0, 50_000, 40), 100).astype(np.uint16)]
    for blocks in (noise, regular):
        codes = coder.encode_blocks(blocks)
        assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode_blocks(codes, np.array([len(b) for b in blocks]))))
    assert len(codes[0]) < 4000 * 2 * 0.25


ROWS = [(5, "b b"), (3, None), (9, ""), (None, "null id"), (4, "x y z " * 30_000), (3, "again"), (3, None), (8, "ünï")]


def test_token_files(spark, make_docs, enc):
    path = shared_path(spark, "t")
    token_files.write_token_files(make_docs(ROWS), path, tokenizer_path())
    got = {(r.doc_id, r.start): r for r in token_files.read_token_files(spark, path).collect()}
    start = 0
    for d, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(plain(enc, t or "", 2), "<u4")
        r = got.pop((d, start))
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert np.frombuffer(r.ids, "<u2").tolist() == ids.tolist()
        start += len(ids)
    assert not got


def test_damaged_file_is_noticed(spark, make_docs):
    path = shared_path(spark, "t")
    token_files.write_token_files(make_docs([(1, "some text of some length")]), path, tokenizer_path())
    bad = shared_path(spark, "t")
    rows = spark.read.parquet(path).selectExpr("*", "transform(block_crcs, c -> c + 1) AS other").drop("block_crcs")
    rows.withColumnRenamed("other", "block_crcs").write.parquet(bad)
    with pytest.raises(Exception, match="checksum"):
        token_files.read_token_files(spark, bad).collect()


def check_pieces(rows, pieces, enc, seq_len):
    full = {}
    for d, t in rows:
        full.setdefault(d, np.array(plain(enc, t or "", 0), "<u4"))
    by_doc, by_seq = {}, {}
    for p in pieces:
        ids = full[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(full[p.doc_id])
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, x in by_doc.items():
        assert sorted(x) == [(sum(n for _, n in sorted(x)[:k]), n) for k, (_, n) in enumerate(sorted(x))]
        assert sum(n for _, n in x) == len(full[d])
    assert set(by_doc) == set(full)
    totals = []
    for x in by_seq.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))]
        totals.append(sum(n for _, n in x))
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert sum(n < seq_len for n in totals) <= 1


@pytest.mark.parametrize("weights", [None, {"src0": 5, "src1": 1}])
def test_packing(make_docs, enc, weights):
    rows = [(k, "word " * (k * 7 % 90) + str(k)) for k in range(120)] + [(500, None), (None, "null id"), (900, "long " * 5000)]
    pieces = packing.pack(make_docs(rows), tokenizer_path(), 64, 256, weights=weights).collect()
    check_pieces(rows, pieces, enc, 64)
    if weights is None:  # every full window holds the corpus mixture within one token
        total = sum(p.length for p in pieces)
        share, windows = {}, {}
        for p in pieces:
            share[p.source] = share.get(p.source, 0) + p.length
            w = windows.setdefault(p.sequence_id // 4, {})
            w[p.source] = w.get(p.source, 0) + p.length
        for w, got in windows.items():
            if (w + 1) * 256 <= total:
                assert all(abs(got.get(s, 0) - 256 * n / total) < 2 for s, n in share.items())


def test_schedule_serves_a_prefix_of_one_order():
    s = packing.Schedule([50, 7, 1, 200], [1, 3, 2, 10], 16)
    before = [s.before(w) for w in range(s.windows + 1)]
    for w, (a, b) in enumerate(zip(before, before[1:])):
        assert all(x <= y for x, y in zip(a, b)) and sum(a) == w * 16
    assert before[-1] == [50, 7, 1, 200]
    for q, n in enumerate((50, 7, 1, 200)):
        for token in range(n):
            w = s.window_of(q, token)
            assert before[w][q] <= token < before[w + 1][q]


def test_many_sources_share_queues(make_docs, enc):
    rows = [(k, "word " * (k % 9)) for k in range(30)]
    check_pieces(rows, packing.pack(make_docs(rows), tokenizer_path(), 16, 32, max_queues=2).collect(), enc, 16)


def test_many_sources_keep_weights_and_names(spark, enc):
    """More sources than queues: weighted and large ones have their share of each window, small ones share evenly."""
    sizes = {"big": 400, "heavy": 40} | {f"small{k:02}": 20 for k in range(30)}
    rows = [(f"{s}", f"word {k}") for s, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(4)
    pieces = packing.pack(docs, tokenizer_path(), 64, 256, weights={"heavy": 500}, max_queues=3).collect()
    check_pieces([(i, t) for i, (_, t) in enumerate(rows)], pieces, enc, 64)
    assert all(p.source == rows[p.doc_id][0] for p in pieces)
    total, got = {}, {}
    for p in pieces:
        total[p.source] = total.get(p.source, 0) + p.length
        w = got.setdefault(p.sequence_id // 4, {})
        w[p.source] = w.get(p.source, 0) + p.length
    target = total | {"heavy": 500}
    whole = sum(target.values())
    assert abs(got[0]["heavy"] - min(total["heavy"], 256 * 500 / whole)) < 2
    assert abs(got[0]["big"] - 256 * total["big"] / whole) < 2
    served = dict.fromkeys(total, 0)
    for w in sorted(got):  # small sources of equal size never drift apart by more than two documents
        for s, n in got[w].items():
            served[s] += n
        small = [n for s, n in served.items() if s.startswith("small")]
        assert max(small) - min(small) <= 2 * max(p.doc_tokens for p in pieces)


def test_empty_tables(spark, empty_docs):
    path = shared_path(spark, "t")
    token_files.write_token_files(empty_docs, path, tokenizer_path())
    assert token_files.read_token_files(spark, path).count() == 0
    assert packing.pack(empty_docs, tokenizer_path()).count() == 0


def test_pieces_are_looked_up_once_for_a_group_of_texts(enc):
    """The cache is asked for a distinct piece of a group, not for each of its words."""
    e = Encoder(tokenizer_path())
    asked = []
    e.spaced = type("Counted", (dict,), {"__getitem__": lambda s, k: (asked.append(k), dict.__getitem__(s, k))[1], "__missing__": lambda s, k: type(enc.spaced).__missing__(s, k)})()
    e.spaced.before, e.spaced.queue, e.spaced.done = " ", e.queue, 0
    texts = ["x " + "one two " * 500 + "y"] * 3 + ["a  b\x1c \x1cc one", "   ", " one"]
    ids, sizes = e.encode(texts, 2)
    assert sorted(asked) == ["one", "two", "y"]
    ends = np.cumsum(sizes)
    for t, n, z in zip(texts, sizes, ends):
        assert ids[z - n : z].tolist() == plain(e, t, 2)
