"""Removal of repeated byte strings by hash-compared suffix sorting.

Every byte covered by a ``length``-byte string that also starts anywhere else
(same document included) is removed; strings are judged on the input, overlaps
count, matches never cross documents. :mod:`tremor.llm.anchors` brings together
the places where a repeat is possible. There the suffixes are sorted by
mergesort; two suffixes are compared by their longest common extension, found
by binary search over prefix polynomial hashes, so a comparison costs a
logarithmic number of steps. Neighbours in sorted order whose common extension
reaches ``length`` are verified byte by byte before they count.

Defined cases: a null text counts as empty; repeated rows and texts repeat
each other, so they lose every byte if they have ``length`` or more; repeated
doc_ids are judged as separate documents; an empty table gives no rows; other
columns are kept by ``cut`` and ignored by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm import anchors
from tremor.llm.common import BYTE_CODES, parts, prefix_hashes, run_hashes, slices
from tremor.session import table

LENGTH = 200


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Longest common extension (up to ``limit``) of the suffixes at ``a`` and ``b``, by binary search on hashes."""
    equal = run_hashes(prefix, a, a + limit) == run_hashes(prefix, b, b + limit)
    lo = np.where(equal, limit, 0)
    hi = np.full(len(a), limit)
    todo = np.flatnonzero(~equal)
    while len(todo):
        mid = (lo[todo] + hi[todo]) // 2
        x, y = a[todo], b[todo]
        same = run_hashes(prefix, x, x + mid) == run_hashes(prefix, y, y + mid)
        lo[todo] = np.where(same, mid, lo[todo])
        hi[todo] = np.where(same, hi[todo], mid)
        todo = todo[hi[todo] - lo[todo] > 1]
    return lo


def suffix_sort(data: np.ndarray, prefix: np.ndarray, at: np.ndarray, segment: np.ndarray, limit: int) -> np.ndarray:
    """Order of the suffixes ``at`` (first ``limit`` bytes) inside each contiguous segment: bottom-up mergesort.

    Each pass ranks every suffix in its sibling run by binary search; all comparisons of a step run together.
    """
    n = len(at)
    order = np.arange(n)
    if not n:
        return order
    head = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    size = np.diff(np.concatenate([head, [n]]))
    begin, stop = np.repeat(head, size), np.repeat(head + size, size)
    place = np.arange(n)
    run = 1
    while run < size.max():
        number = (place - begin) // run
        own = begin + number * run
        left = begin + (number ^ 1) * run
        lo = np.minimum(left, stop)
        hi = np.minimum(left + run, stop)
        odd = (number & 1) == 1
        base = lo.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) // 2
            mine, other = at[order[todo]], at[order[mid]]
            ext = common_extension(prefix, mine, other, limit)
            inside = np.minimum(ext, limit - 1)
            x, y = data[mine + inside].astype(np.int16), data[other + inside].astype(np.int16)
            sign = np.where(ext >= limit, 0, x - y)
            right = np.where(odd[todo], sign >= 0, sign > 0)
            lo[todo] = np.where(right, mid + 1, lo[todo])
            hi[todo] = np.where(right, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        target = begin + (number // 2) * 2 * run + (place - own) + (lo - base)
        merged = np.empty(n, np.int64)
        merged[target] = order
        order = merged
        run *= 2
    return order


def repeated(data: np.ndarray, prefix: np.ndarray, at: np.ndarray, segment: np.ndarray, limit: int) -> np.ndarray:
    """Which suffixes (contiguous by segment) share their first ``limit`` bytes with another of their segment."""
    order = suffix_sort(data, prefix, at, segment, limit)
    a, b = at[order[:-1]], at[order[1:]]
    out = np.zeros(len(at), bool)
    near = np.flatnonzero(segment[order[:-1]] == segment[order[1:]])
    near = near[common_extension(prefix, a[near], b[near], limit) >= limit]
    reach = np.arange(limit)
    for k in range(0, len(near), 20_000):  # verified byte by byte
        part = near[k : k + 20_000]
        same = (data[a[part][:, None] + reach] == data[b[part][:, None] + reach]).all(axis=1)
        out[order[part[same]]] = out[order[part[same] + 1]] = True
    return out


def _resolver(length: int):
    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        uid, th, lo, lead = (t[c].to_numpy() for c in ("uid", "th", "lo", "lead"))
        a, s, split = t["ahash"].to_numpy(), t["salt"].to_numpy(), t["split"].to_numpy()
        _, _, data, offsets = next(slices_binary(t["text"]))
        group = np.cumsum(np.concatenate([[False], (a[1:] != a[:-1]) | (s[1:] != s[:-1])]))
        context, start = anchors.window_ranges(np.diff(offsets), length)
        at = offsets[context] + start
        prefix = prefix_hashes(BYTE_CODES[data])
        whole = run_hashes(prefix, at, at + length)
        # equal windows stand at equal distance from the anchor; hashes that occur once cannot repeat
        segment = group[context] * (length + 1) + (lead[context] - start)
        order = np.lexsort((whole, segment))
        same = (segment[order[1:]] == segment[order[:-1]]) & (whole[order[1:]] == whole[order[:-1]])
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        k = np.flatnonzero(twice)
        k = k[np.argsort(segment[k], kind="stable")]
        hit = np.zeros(len(at), bool)
        hit[k] = repeated(data, prefix, at[k], segment[k], length)
        c, first, end = anchors.merge_runs(context[hit], start[hit], length)
        yield anchors.found_rows(False, uid[c], th[c], uid[c], th[c], lo[c] + first, lo[c] + end)
        if split.any():  # one row of each different window of a subgroup meets those of the other subgroups
            k = np.flatnonzero(split[context])
            key = np.lexsort((whole[k], segment[k]))
            k = k[key]
            k = k[np.concatenate([[True], (segment[k][1:] != segment[k][:-1]) | (whole[k][1:] != whole[k][:-1])])]
            c = context[k]
            k2 = a[c] ^ run_hashes(prefix, at[k], at[k] + length // 2).view(np.int64)
            first = lo[c] + start[k]
            yield anchors.found_rows(True, whole[k], k2, uid[c], th[c], first, first + length)

    return run


def slices_binary(column):
    """All rows of a binary column as one slice."""
    arr = column.combine_chunks().cast(pa.large_binary())
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks)
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    yield 0, len(arr), data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """uid, th, text, whole, spans (and rest) of keyed texts: ``whole`` marks copies of another text, ``spans`` the repeated byte spans."""
    units = anchors.Units(anchors.byte_units, length, length // 2)
    first = anchors.representatives(texts)
    alone = texts.join(first, ["uid", "th"], "left")
    marks = anchors.label_any(anchors.find_anchors(alone.filter("copies is not null"), units, earlier=False))
    found = anchors.resolve(anchors.contexts(texts, marks, units), _resolver(length))
    return alone.join(anchors.spans(found, earlier=False), ["uid", "th"], "left").select(
        "uid", "th", "text", (~F.coalesce(F.col("copies") == 1, F.lit(False))).alias("whole"), "spans", *anchors.rest_of(texts)
    )


def _cut(column: pa.Array, whole: np.ndarray, all_spans: pa.Array, length: int):
    """(row, text bytes, removed mask) of every row."""
    lists = all_spans.to_pylist()
    for i, j, data, offsets in slices(column):
        for r in range(i, j):
            text = data[offsets[r - i] : offsets[r - i + 1]]
            if whole[r] and len(text) >= length:
                gone = np.ones(len(text), bool)
            elif lists[r]:
                pairs = np.array([(x["first"], x["end"]) for x in lists[r]], np.int64)
                gone = anchors.covered(len(text), pairs[:, 0], pairs[:, 1])
            else:
                gone = None
            yield r, text, gone


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            out: list[list] = [[], [], [], []]
            for _, text, gone in _cut(b.column(1), b.column(2).to_numpy(zero_copy_only=False), b.column(3), length):
                kept = text if gone is None else text[~gone]
                runs = 0 if gone is None else int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                for col, v in zip(out, (len(text), len(text) - len(kept), runs, hashlib.sha256(kept.tobytes()).hexdigest())):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    doc_id = F.when(F.col("uid") != anchors.NULL_ID, F.col("uid")).alias("doc_id")
    return byte_spans(anchors.keyed(docs), length).select(doc_id, "text", "whole", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def cut(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated spans removed from ``text`` and ``n_chars`` adjusted.

    A character only part of which is covered goes with the span. Rows stay, also where no text is left.
    """

    spans = byte_spans(anchors.keyed(docs, whole_rows=True), length).select("text", "whole", "spans", "rest")
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType()), spans.schema["rest"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts, changed = [], []
            for _, text, gone in _cut(b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2), length):
                changed.append(gone is not None)
                texts.append((text if gone is None else text[~gone]).tobytes().decode("utf-8", "ignore"))
            cols = [pa.array(texts, pa.string()), pa.array(changed, pa.bool_()), b.column(3)]
            yield pa.RecordBatch.from_arrays(cols, names=["text", "changed", "rest"])

    out = spans.mapInArrow(run, schema)
    columns = []
    for c in docs.columns:
        own = F.col("rest").getField(c)
        if c == "text":
            columns.append(F.when(F.col("rest").getField("no_text_"), F.lit(None)).otherwise(F.col("text")).alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("changed"), F.length("text").cast(docs.schema[c].dataType)).otherwise(own).alias(c))
        else:
            columns.append(own.alias(c))
    return out.select(*columns)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every whole text of ``documents``."""
    return report(table(spark, sf_dir, "documents"))
