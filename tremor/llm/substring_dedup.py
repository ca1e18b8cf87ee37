"""Removal of repeated word windows by matching statistics on FM-index shards.

Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. Every word
covered by a window of ``length`` words whose word sequence also starts in a
document with a smaller doc_id is removed; windows are judged on the input.
:mod:`tremor.llm.anchors` deals the places where that is possible to shards. A
shard indexes its contexts as a compressed FM-index (wavelet matrix), streams
the windows of later documents through backward search, and reports those
whose matching statistics reach ``length`` in a document with a smaller id
(least id of the suffix interval).

Defined cases: a null text has no words; a null doc_id counts as the smallest;
rows with equal doc_id are no earlier than each other, so repeated rows do not
remove each other's words; ties cannot occur otherwise; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import anchors
from tremor.llm.common import parts, prefix_hashes, run_hashes, slices, word_hashes, words
from tremor.llm.fm_index import FMIndex, RangeMinimum
from tremor.llm.suffix_dedup import slices_binary
from tremor.session import table

LENGTH = 13
GRAM = 5


def _resolver(length: int):
    def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
        uid, th, lo = (t[c].to_numpy() for c in ("uid", "th", "lo"))
        split, query, index = (t[c].to_numpy() for c in ("split", "query", "index"))
        _, _, data, offsets = next(slices_binary(t["text"]))
        starts, ends, row = words(data, offsets, False)
        hashes = word_hashes(data, starts, ends)
        symbols = np.unique(hashes, return_inverse=True)[1].astype(np.int64) + 1
        sizes = np.bincount(row, minlength=len(uid))
        base = np.cumsum(sizes) - sizes
        # indexed contexts one after another, a separator before each
        taken = index[row]
        r = row[taken]
        place = np.arange(len(r)) + np.cumsum(np.concatenate([[1], r[1:] != r[:-1]])) if len(r) else r
        text = np.zeros(int(place[-1]) + 2 if len(r) else 1, np.int64)
        text[place] = symbols[taken]
        owner = np.full(len(text), np.iinfo(np.int64).max)
        owner[place] = uid[r]
        shard = FMIndex(text, 4 * length)
        context, start = anchors.window_ranges(sizes, length)
        k = np.flatnonzero(query[context])
        first = base[context[k]] + start[k]
        hit = np.zeros(len(k), bool)
        least = RangeMinimum(owner[shard.order])
        for at in range(0, len(k), 50_000):
            patterns = symbols[first[at : at + 50_000, None] + np.arange(length)]
            low, high, matched = shard.search(patterns)
            full = np.flatnonzero(matched == length)
            hit[at + full] = least.query(low[full], high[full]) < uid[context[k[at + full]]]
        c, a, z = anchors.merge_runs(context[k[hit]], start[k[hit]], length)
        yield anchors.found_rows(False, uid[c], th[c], uid[c], th[c], lo[c] + a, lo[c] + z)
        if split.any():  # what no smaller id of the subgroup holds meets the other subgroups
            open_ = split[context]
            open_[k[hit]] = False
            k = np.flatnonzero(open_)
            prefix = prefix_hashes(hashes)
            first = base[context[k]] + start[k]
            k1, k2 = run_hashes(prefix, first, first + length), run_hashes(prefix, first, first + length // 2)
            c = context[k]
            yield anchors.found_rows(True, k1, k2, uid[c], th[c], lo[c] + start[k], lo[c] + start[k] + length)

    return run


def word_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """uid, th, text, whole, spans: ``whole`` marks later copies of a text, ``spans`` the repeated word spans."""
    units = anchors.Units(anchors.word_units, length, gram)
    texts = anchors.keyed(docs)
    alone = texts.join(anchors.representatives(texts), ["uid", "th"], "left")
    marks = anchors.label_earlier(anchors.find_anchors(alone.filter("copies is not null"), units, earlier=True))
    found = anchors.resolve(anchors.contexts(texts, marks, units), _resolver(length))
    return alone.join(anchors.spans(found, earlier=True), ["uid", "th"], "left").select(
        "uid", "th", "text", F.col("copies").isNull().alias("whole"), "spans"
    )


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            whole, lists = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_pylist()
            out: list[list] = [[], [], []]
            for i, j, data, offsets in slices(b.column(1)):
                starts, ends, row = words(data, offsets, False)
                edge = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(i, j):
                    a, z = edge[r - i], edge[r - i + 1]
                    n = int(z - a)
                    gone = np.zeros(n, bool)
                    if whole[r] and n >= length:
                        gone[:] = True
                    elif lists[r]:
                        pairs = np.array([(x["first"], x["end"]) for x in lists[r]], np.int64)
                        gone = anchors.covered(n, pairs[:, 0], pairs[:, 1])
                    raw = data[offsets[r - i] : offsets[r - i + 1]].tobytes()
                    kept = b" ".join([raw[x:y] for x, y in zip(starts[a:z][~gone] - offsets[r - i], ends[a:z][~gone] - offsets[r - i])])
                    for col, v in zip(out, (n, int(gone.sum()), hashlib.sha256(kept).hexdigest())):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    doc_id = F.when(F.col("uid") != anchors.NULL_ID, F.col("uid")).alias("doc_id")
    return word_spans(docs, length).select(doc_id, "text", "whole", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every whole text of ``documents``."""
    return report(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), v AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) t(i)
), gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS p FROM v JOIN (SELECT s, min(doc_id) AS m FROM v GROUP BY s) USING (s) WHERE m < doc_id)
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) u(p)) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
