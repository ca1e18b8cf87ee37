"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. A window of ``window_tokens``
is one round: every queue's deficit grows by its share of the window, the
whole tokens owed are served, and the tokens left over by rounding go to the
queues next due. What a queue is still owed is carried to the next window. The
tokens served before window w have a closed form (they are the first tokens in
the order of (j + 1) / weight), so every partition starts at any window with
exact deficits and no pass over earlier windows. An emptied queue starts a new
phase in which the others share the windows. By default weights are the
queues' token totals: all windows then hold the corpus mixture and all queues
end together.

Inside a window the queues follow one another; sequences are consecutive cuts
of ``seq_len`` tokens, so only the very last sequence can need padding.

Defined cases: a null text counts as empty (its document holds the end id
alone); null sources form a queue of their own; repeated rows are packed as
often as they come; an empty table gives no pieces; other columns are ignored.
At most ``max_queues`` queues are kept: with more sources, the weighted and the
largest ones keep queues of their own and the others share one, which carries
the sum of their weights. In it documents follow one another by (tokens of
their source before them) / weight, so each source gets its proportion of the
shared queue to within a document; what it is owed carries on.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm.common import materialize
from tremor.llm.tokens import encoder, text_groups, tokenizer_path
from tremor.session import table

SEQ_LEN = 1024
WINDOW_TOKENS = 16 * SEQ_LEN
END_ID = 0
MAX_QUEUES = 1024
#: (partition, queue) rows up to which their offsets are broadcast
BROADCAST_ROWS = 200_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
)


class Schedule:
    """Tokens each queue has been served before any window."""

    def __init__(self, totals: list[int], weights: list[int], window: int):
        self.window, self.total, self.n = window, sum(totals), len(totals)
        self.windows = -(-self.total // window)
        self.phases: list[tuple[int, list[int], list[int], dict[int, int]]] = []
        served, at = [0] * self.n, 0
        while at < self.total:
            left = {s: totals[s] - served[s] for s in range(self.n) if totals[s] > served[s]}
            active = {s: weights[s] for s in left}
            whole = sum(active.values())
            length = max(1, min(left[s] * whole // w for s, w in active.items()))
            length = min(length, self.total - at)
            self.phases.append((at, list(served), [left.get(s, 0) for s in range(self.n)], active))
            served = self._at(len(self.phases) - 1, at + length)
            at += length
        self.end = served
        self.cache: dict[int, list[int]] = {}

    def _at(self, phase: int, tokens: int) -> list[int]:
        start, served, left, active = self.phases[phase]
        f, whole = tokens - start, sum(active.values())
        got = list(served)
        rest = f
        due = []
        for s, w in active.items():
            n = min(f * w // whole, left[s])
            got[s] += n
            rest -= n
            if n < left[s]:
                due.append((Fraction(n + 1, w), s, n))
        heapq.heapify(due)
        for _ in range(rest):
            _, s, n = heapq.heappop(due)
            got[s] += 1
            if n + 1 < left[s]:
                heapq.heappush(due, (Fraction(n + 2, active[s]), s, n + 1))
        return got

    def before(self, w: int) -> list[int]:
        """Served tokens by queue when window ``w`` begins."""
        if w >= self.windows:
            return self.end
        found = self.cache.get(w)
        if found is None:
            if len(self.cache) > 4096:
                self.cache.clear()
            tokens = w * self.window
            phase = max(k for k, p in enumerate(self.phases) if p[0] <= tokens)
            found = self.cache[w] = self._at(phase, tokens)
        return found

    def window_of(self, queue: int, token: int) -> int:
        """The window that serves the queue's token."""
        lo, hi = 0, self.windows - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.before(mid)[queue] <= token:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def pieces(self, queue: int, first: int, end: int, w: int, seq_len: int) -> Iterator[tuple[int, int, int]]:
        """(queue token, length, place in the packed stream) of the queue's tokens [first, end) from window ``w`` on."""
        while first < end:
            here, after = self.before(w), self.before(w + 1)
            stop = min(end, after[queue])
            place = w * self.window + sum(after[s] - here[s] for s in range(queue)) + first - here[queue]
            while first < stop:
                n = min(stop - first, seq_len - place % seq_len)
                yield first, n, place
                first, place = first + n, place + n
            w += 1


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Written table of (pid, source, local, doc_id, n, ids): local counts the source's tokens before it in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pid = encoder(tokenizer), TaskContext.get().partitionId()
        served: dict[str, int] = {}
        for b in batches:
            texts, sources = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, j in text_groups(texts):
                ids, sizes = enc.encode([t or "" for t in texts[i:j]], end_id)
                local = np.zeros(j - i, np.int64)
                for k, (q, n) in enumerate(zip(sources[i:j], sizes.tolist())):
                    local[k] = served.get(q, 0)
                    served[q] = int(local[k]) + n
                at = np.concatenate([[0], np.cumsum(sizes) * ids.itemsize]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(at), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, pid)), b.column(2).slice(i, j - i), pa.array(local), b.column(0).slice(i, j - i), pa.array(sizes), raw],
                    names=["pid", "source", "local", "doc_id", "n", "ids"],
                )

    rows = docs.select("doc_id", "text", F.coalesce(F.col("source"), F.lit("")).alias("source"))
    return materialize(rows.mapInArrow(run, "pid long, source string, local long, doc_id long, n long, ids binary"), "tokens")


def interleaved(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, source, first, n, ids, weight) of the shared queue with ``first`` as place in that queue."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, served = TaskContext.get().partitionId(), 0
        for b in batches:
            ends = served + np.cumsum(b.column(3).to_numpy())
            served = int(ends[-1]) if len(ends) else served
            local = pa.array(ends - b.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, pid)), b.column(0), b.column(1), local, b.column(3), b.column(4)],
                names=["pid", "doc_id", "source", "local", "n", "ids"],
            )

    due = (F.col("first") / F.col("weight")).alias("due")
    dealt = rows.select("doc_id", "source", "first", "n", "ids", due)
    dealt = dealt.repartitionByRange("due", "source", "first").sortWithinPartitions("due", "source", "first").drop("due")
    table_ = materialize(dealt.mapInArrow(run, "pid long, doc_id long, source string, local long, n long, ids binary"), "shared-queue")
    running = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)  # one row per partition
    base = table_.groupBy("pid").agg(F.sum("n").alias("n")).select("pid", (F.sum("n").over(running) - F.col("n")).alias("base"))
    return table_.join(F.broadcast(base), "pid").select("doc_id", "source", (F.col("local") + F.col("base")).alias("first"), "n", "ids")


def spark_weights(spark: SparkSession, weights: Mapping[str, int] | None) -> DataFrame:
    return spark.createDataFrame([(s, int(w)) for s, w in (weights or {}).items()], "source string, weight long")


def pack(
    docs: DataFrame,
    tokenizer: str,
    seq_len: int = SEQ_LEN,
    window_tokens: int = WINDOW_TOKENS,
    end_id: int = END_ID,
    weights: Mapping[str, int] | None = None,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """One row per piece of (doc_id, text, source): where its ids lie in the packed sequences.

    ``weights`` gives target proportions by source (missing sources weigh their token total).
    """
    if window_tokens % seq_len:
        raise ValueError("window_tokens must be a multiple of seq_len")
    tokens = tokenized(docs, tokenizer, end_id)
    width = encoder(tokenizer).dtype.itemsize
    per_part = materialize(tokens.groupBy("source", "pid").agg(F.sum("n").alias("n")), "source-parts")
    totals = per_part.groupBy("source").agg(F.sum("n").alias("n"))
    given = spark_weights(docs.sparkSession, weights)
    totals = totals.join(F.broadcast(given), "source", "left")
    totals = totals.select("source", "n", F.coalesce("weight", "n").alias("weight"), F.col("weight").isNotNull().alias("given"))
    # at most max_queues + 1 rows reach the driver
    ranked = totals.orderBy(F.desc("given"), F.desc("n"), "source").limit(max_queues + 1).collect()
    shared = len(ranked) > max_queues
    own = sorted((r["source"], r["n"], r["weight"]) for r in (ranked[: max_queues - 1] if shared else ranked))
    number = {name: k for k, (name, _, _) in enumerate(own)}
    queues = [(n, w) for _, n, w in own]
    running = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)
    base = per_part.select("source", "pid", (F.sum("n").over(running) - F.col("n")).alias("base"))
    if per_part.count() <= BROADCAST_ROWS:
        base = F.broadcast(base)
    placed = tokens.join(base, ["source", "pid"]).select(
        "doc_id", "source", (F.col("local") + F.col("base")).alias("first"), "n", "ids"
    )
    if shared:
        names = docs.sparkSession.createDataFrame([(name,) for name in number], "source string")
        tail = totals.join(F.broadcast(names), "source", "left_anti")
        queues.append(tuple(map(int, tail.agg(F.sum("n"), F.sum("weight")).first())))
        rest = interleaved(placed.join(tail.select("source", "weight"), "source"))
        placed = placed.join(F.broadcast(names), "source", "left_semi").select(*rest.columns).unionByName(rest)
    schedule = Schedule([int(n) for n, _ in queues], [int(w) for _, w in queues], window_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, tuple[int, int]] = {}
        dtype = np.dtype(f"<u{width}")
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            doc_ids, sources, firsts, sizes = (b.column(k).to_pylist() for k in range(4))
            raws = b.column(4)
            for k, (doc, name, first, n) in enumerate(zip(doc_ids, sources, firsts, sizes)):
                q = number.get(name, len(number))  # the shared queue is the last one
                token, w = at.get(q, (-1, 0))
                if token != first:
                    w = schedule.window_of(q, first)
                wide = memoryview(np.frombuffer(raws[k].as_buffer(), dtype).astype("<u4")).cast("B")
                for x, length, place in schedule.pieces(q, first, first + n, w, seq_len):
                    s = x - first
                    for col, v in zip(
                        out,
                        (doc, s, length, zlib.crc32(wide[4 * s : 4 * (s + length)]), n, place // seq_len, place % seq_len, name),
                    ):
                        col.append(v)
                last = schedule.windows - 1
                w = min(out[5][-1] * seq_len // window_tokens, last)
                while w < last and schedule.before(w + 1)[q] <= first + n:
                    w += 1
                at[q] = (first + n, w)
            types = [pa.int64()] * 7 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], names=[f.split()[0] for f in PIECES.split(", ")]
            )

    return placed.mapInArrow(run, PIECES)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
