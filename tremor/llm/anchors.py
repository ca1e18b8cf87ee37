"""Repeated windows across documents, found by content-chosen anchors.

A window is ``window`` consecutive units (bytes or words) of one document. Its
anchor is the ``gram``-unit run with the least hash inside it, so equal
windows have equal anchors at equal places, wherever they occur. Only anchors
travel through the first shuffle; the text around an anchor (every window that
can hold it) follows where an anchor occurs more than once and its
surroundings are not simply equal. A resolver then judges the windows of each
anchor's occurrences exactly.

Copies of a whole text are settled first, by digest: one representative of
each text takes part. Occurrences with equal surroundings are settled by their
digest. An anchor with more than ``SPLIT`` different surroundings is dealt to
several tasks by salt; windows that stay open there meet once more by their
own digest, at most one row of each subgroup's distinct windows. So no group
of copies and no common passage is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import BYTE_CODES, long_array, mix, parts, prefix_hashes, run_hashes, slices, text_key, word_hashes, words

NULL_ID = -(1 << 63)
SPLIT = 2048
SLICE = 1 << 18
#: contexts that a task resolves at a time
CONTEXTS = 3000

ANCHORS = "ahash long, chash long, uid long, th long, at long, state int"
#: of an occurrence: still open; open, but known to repeat; settled within its batch
OPEN, TWICE, SETTLED = 0, 1, 2
CONTEXT = "ahash long, salt long, split boolean, uid long, th long, lo long, lead long, query boolean, index boolean, text binary"
FOUND = "open boolean, k1 long, k2 long, uid long, th long, first long, end long"


@dataclass(frozen=True)
class Units:
    """How texts divide into units: ``codes(data, offsets)`` gives (code of each unit, unit offsets of the rows,
    first byte of each unit, end byte of each unit)."""

    codes: Callable
    window: int
    gram: int


def byte_units(data: np.ndarray, offsets: np.ndarray):
    place = np.arange(len(data))
    return BYTE_CODES[data], offsets, place, place + 1


def word_units(data: np.ndarray, offsets: np.ndarray):
    starts, ends, row = words(data, offsets, False)
    return word_hashes(data, starts, ends), np.searchsorted(row, np.arange(len(offsets))), starts, ends


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Index of the least value (leftmost) of every run of ``size`` values."""
    best, at = values, np.arange(len(values), dtype=np.int32)
    width = 1
    while width < size:
        step = min(width, size - width)
        left, right = best[:-step], best[step:]
        later = right < left
        best = np.where(later, right, left)
        at = np.where(later, at[step:], at[:-step])
        width += step
    return at


def choose_anchors(codes: np.ndarray, row_starts: np.ndarray, units: Units):
    """(gram start, row, context start, context end, gram hash, context hash) of the anchors of all rows."""
    none = np.zeros(0, np.int64)
    if len(codes) < units.window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = prefix_hashes(codes)
    grams = np.arange(len(codes) - units.gram + 1)
    at = sliding_argmin(run_hashes(prefix, grams, grams + units.gram), units.window - units.gram + 1)
    row = np.repeat(np.arange(len(row_starts) - 1), np.diff(row_starts))
    first = np.arange(len(codes) - units.window + 1)
    at = at[first][row[first] == row[first + units.window - 1]].astype(np.int64)
    if not len(at):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    r = row[at]
    lo = np.maximum(at - (units.window - units.gram), row_starts[r])
    hi = np.minimum(at + units.window, row_starts[r + 1])
    context = run_hashes(prefix, lo, hi) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return at, r, lo, hi, run_hashes(prefix, at, at + units.gram), context


def keyed(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """uid, th, text: uid stands for doc_id (null: the least value), th tells texts of one doc_id apart.

    With ``whole_rows`` also ``rest``, a struct of the row's columns without the text and ``no_text_`` (it was null).
    Functions here hand ``rest`` through, so that all steps read the texts from one and the same exchange.
    """
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.col("text").isNull().alias("no_text_")).alias("rest")]
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("uid"),
        F.coalesce("text", F.lit("")).alias("text"),
        *(rest if whole_rows else []),
    ).withColumn("th", text_key("text"))


def rest_of(texts: DataFrame) -> list[str]:
    return ["rest"] if "rest" in texts.columns else []


def representatives(texts: DataFrame) -> DataFrame:
    """uid, th, copies: one document (least id) of each different text."""
    return (
        texts.groupBy(F.md5("text").alias("digest"), "th")
        .agg(F.min("uid").alias("uid"), F.count("*").alias("copies"))
        .select("uid", "th", "copies")
    )


def find_anchors(texts: DataFrame, units: Units, earlier: bool) -> DataFrame:
    """Anchor occurrences. Those that another of their batch settles (equal surroundings; with ``earlier``: of a
    smaller uid) are marked and dealt by document, so a passage held by very many documents sends one row per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 4000):
            uid, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            found = []
            for i, j, data, offsets in slices(b.column(2), SLICE):
                codes, rows, _, _ = units.codes(data, offsets)
                at, r, _, _, gram, context = choose_anchors(codes, rows, units)
                found.append((gram, context, uid[i + r], th[i + r], at - rows[r]))
            if not found:
                continue
            gram, context, ids, ths, at = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((at, ths, ids, context, gram))
            gram, context, ids, ths, at = (x[order] for x in (gram, context, ids, ths, at))
            state = np.zeros(len(at), np.int32)
            if len(at):
                head = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])]))
                size = np.diff(np.concatenate([head, [len(at)]]))
                lead = np.repeat(head, size)
                if earlier:
                    state[ids > ids[lead]] = SETTLED
                else:
                    state[np.repeat(size, size) > 1] = SETTLED
                    state[head[size > 1]] = TWICE
            done = state == SETTLED
            gram[done] = mix(ids[done].view(np.uint64) + at[done].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            cols = [long_array(gram), long_array(context), pa.array(ids), pa.array(ths), pa.array(at), pa.array(state)]
            yield pa.RecordBatch.from_arrays(cols, names=["ahash", "chash", "uid", "th", "at", "state"])

    return texts.select("uid", "th", "text", *rest_of(texts)).mapInArrow(run, ANCHORS).repartition("ahash")


def label_any(anchors: DataFrame) -> DataFrame:
    """Occurrences that matter where any second occurrence counts: settled by digest, or to be compared."""
    group, same = Window.partitionBy("ahash"), Window.partitionBy("ahash", "chash")
    seen = anchors.withColumn("rn", F.row_number().over(same.orderBy("uid", "th", "at"))).withColumn("n", F.count("*").over(same))
    seen = seen.withColumn("kinds", F.sum((F.col("rn") == 1).cast("long")).over(group))
    open_ = (F.col("kinds") > 1) & (F.col("rn") == 1) & (F.col("state") != SETTLED)
    done = (F.col("n") > 1) | (F.col("state") != OPEN)
    return seen.filter(done | open_).select(
        "ahash", "uid", "th", "at", "kinds", done.alias("done"), open_.alias("query"), open_.alias("index")
    )


def label_earlier(anchors: DataFrame) -> DataFrame:
    """Occurrences that matter where only a smaller uid counts."""
    group, same = Window.partitionBy("ahash"), Window.partitionBy("ahash", "chash")
    seen = anchors.withColumn("rn", F.row_number().over(same.orderBy("uid", "th", "at"))).withColumn("least", F.min("uid").over(same))
    seen = seen.withColumn("kinds", F.sum((F.col("rn") == 1).cast("long")).over(group)).withColumn(
        "first", F.min("uid").over(group)
    )
    settled = F.col("state") == SETTLED
    done = (F.col("least") < F.col("uid")) | settled
    several = F.col("kinds") > 1
    query = ~done & several & (F.col("first") < F.col("uid"))
    index = (F.col("rn") == 1) & several & ~settled
    return seen.filter(done | query | index).select(
        "ahash", "uid", "th", "at", "kinds", done.alias("done"), query.alias("query"), index.alias("index")
    )


def contexts(texts: DataFrame, labels: DataFrame, units: Units) -> DataFrame:
    """Rows to resolve; settled occurrences come as rows with ``index`` and ``query`` false and their span in (lo, lead)."""
    salt = F.when(F.col("kinds") > SPLIT, F.pmod(F.xxhash64("uid", "th", "at"), F.ceil(F.col("kinds") / SPLIT))).otherwise(F.lit(0))
    marks = (
        labels.withColumn("salt", salt.cast("long"))
        .groupBy("uid", "th")
        .agg(
            F.collect_list(
                F.struct("at", "ahash", "salt", (F.col("kinds") > SPLIT).alias("split"), "done", "query", "index")
            ).alias("marks")
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CONTEXT.split(", ")]
        for b in parts(batches, 1000):
            uid, th, all_marks = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            for i, j, data, offsets in slices(b.column(2), SLICE):
                _, rows, first, end = units.codes(data, offsets)
                part = all_marks.slice(i, j - i)
                flat = part.flatten()
                sizes = part.value_lengths().to_numpy()
                r = np.repeat(np.arange(j - i), sizes)
                col = {n: flat.field(k).to_numpy(zero_copy_only=False) for k, n in enumerate(("at", "ahash", "salt", "split", "done", "query", "index"))}
                at = col["at"] + rows[r]
                lo = np.maximum(at - (units.window - units.gram), rows[r])
                hi = np.minimum(at + units.window, rows[r + 1])
                done = np.flatnonzero(col["done"])
                if len(done):  # settled: union of their spans, as few rows as possible
                    done = done[np.argsort(lo[done], kind="stable")]
                    top = np.maximum.accumulate(hi[done])
                    new = np.concatenate([[True], (lo[done][1:] > top[:-1]) | (r[done][1:] != r[done][:-1])])
                    head = np.flatnonzero(new)
                    tail = np.concatenate([head[1:], [len(done)]]) - 1
                    d = done[head]
                    spans = (lo[d] - rows[r[d]], top[tail] - rows[r[d]])
                    no = np.zeros(len(d), bool)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[i + r[d]]), pa.array(np.zeros(len(d), np.int64)), pa.array(no), pa.array(uid[i + r[d]]), pa.array(th[i + r[d]]),
                         pa.array(spans[0]), pa.array(spans[1]), pa.array(no), pa.array(no), pa.array([b""] * len(d), pa.binary())],
                        names=names,
                    )
                k = np.flatnonzero(col["query"] | col["index"])
                if len(k):
                    a, z = first[lo[k]], end[hi[k] - 1]
                    size = z - a
                    where = np.concatenate([[0], np.cumsum(size)])
                    raw = data[np.repeat(a - where[:-1], size) + np.arange(where[-1])]
                    text = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(where.astype(np.int32)), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col["ahash"][k]), pa.array(col["salt"][k]), pa.array(col["split"][k]), pa.array(uid[i + r[k]]), pa.array(th[i + r[k]]),
                         pa.array(lo[k] - rows[r[k]]), pa.array(at[k] - lo[k]), pa.array(col["query"][k]), pa.array(col["index"][k]), text],
                        names=names,
                    )

    joined = texts.join(marks, ["uid", "th"])
    return joined.select("uid", "th", "text", "marks", *rest_of(texts)).mapInArrow(run, CONTEXT)


def resolve(rows: DataFrame, resolver: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Deal contexts by (ahash, salt), hand whole groups to the resolver, pass settled spans on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            for k in range(0, b.num_rows, CONTEXTS):
                held.append(b.slice(k, CONTEXTS))
                n += held[-1].num_rows
                if n < CONTEXTS:
                    continue
                t = pa.Table.from_batches(held).combine_chunks()
                a, s = t["ahash"].to_numpy(), t["salt"].to_numpy()
                cut = np.flatnonzero((a[1:] != a[:-1]) | (s[1:] != s[:-1]))
                if not len(cut):
                    held = t.to_batches()
                    continue
                yield from judge(t.slice(0, int(cut[-1]) + 1))
                rest = t.slice(int(cut[-1]) + 1).combine_chunks()
                held, n = rest.to_batches(), rest.num_rows
        if held:
            yield from judge(pa.Table.from_batches(held).combine_chunks())

    def judge(t: pa.Table) -> Iterator[pa.RecordBatch]:
        settled = ~(t["query"].to_numpy() | t["index"].to_numpy())
        if settled.any():
            s = t.filter(pa.array(settled))
            yield found_rows(False, s["uid"].to_numpy(), s["th"].to_numpy(), s["uid"].to_numpy(), s["th"].to_numpy(), s["lo"].to_numpy(), s["lead"].to_numpy())
        if not settled.all():
            yield from resolver(t.filter(pa.array(~settled)).combine_chunks())

    dealt = rows.repartition("ahash", "salt").sortWithinPartitions("ahash", "salt")
    return dealt.mapInArrow(run, FOUND)


def found_rows(open_: bool, k1, k2, uid, th, first, end) -> pa.RecordBatch:
    cols = [pa.array(np.full(len(uid), open_)), long_array(k1), long_array(k2), pa.array(uid), pa.array(th), long_array(first), long_array(end)]
    return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in FOUND.split(", ")])


def spans(found: DataFrame, earlier: bool) -> DataFrame:
    """uid, th, spans: settle the windows left open by split groups, then gather each document's spans."""
    same = Window.partitionBy("open", "k1", "k2")
    if earlier:
        keep = F.min("uid").over(same) < F.col("uid")
    else:
        # one window may come from several occurrences of its anchor: only another place counts
        place = F.struct("uid", "th", "first")
        keep = F.min(place).over(same) != F.max(place).over(same)
    kept = found.withColumn("keep", ~F.col("open") | keep).filter("keep and end > first")
    return kept.groupBy("uid", "th").agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` units lies in a span (spans end at ``n``)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.minimum(starts, n), 1)
    np.add.at(change, np.minimum(ends, n), -1)
    return np.cumsum(change[:-1]) > 0


def window_ranges(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start in it) of every window of contexts of these lengths."""
    n = np.maximum(lengths - window + 1, 0)
    context = np.repeat(np.arange(len(lengths)), n)
    return context, np.arange(len(context)) - np.repeat(np.cumsum(n) - n, n)


def merge_runs(context: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, end) of runs of consecutive windows (sorted by context and start)."""
    if not len(context):
        return context, start, start
    new = np.concatenate([[True], (context[1:] != context[:-1]) | (start[1:] != start[:-1] + 1)])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(context)]]) - 1
    return context[head], start[head], start[tail] + window
