"""Connected components of a graph given as edges, by alternating star contraction.

Each round first contracts the edges that a task happens to hold (union-find
over ``EDGES`` edges at a time, bounded memory), then joins every vertex to the least
vertex it knows, first among larger neighbours, then among smaller ones. A
round is written to the shared folder, so lineage stays short, and the one
before it is removed. Rounds grow with the logarithm of a component's diameter. Minima are pre-aggregated and
joined back, so a vertex with very many neighbours is split by the adaptive
skew join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import stored
from tremor.sinks.tables import delete_folder

MAX_ROUNDS = 60
#: edges that a task contracts at a time
EDGES = 1 << 20


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, least vertex of its component) for every vertex of the edges but those least ones."""
    ids, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[: len(a)], number[len(a) :]
    least = np.arange(len(ids))
    while True:
        low = np.minimum(least[x], least[y])
        before = least.copy()
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        np.minimum.at(least, before[x], low)
        np.minimum.at(least, before[y], low)
        while True:
            jump = least[least]
            if np.array_equal(jump, least):
                break
            least = jump
        if np.array_equal(least, before):
            break
    moved = np.flatnonzero(least != np.arange(len(ids)))
    return ids[moved], ids[least[moved]]


def _contract(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            n += b.num_rows
            if n >= EDGES:
                yield contracted(held)
                held, n = [], 0
        if held:
            yield contracted(held)

    def contracted(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        x, y = star_forest(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every vertex of edges (a, b) except each component's least vertex, which is the label."""
    now, folder = stored(_contract(edges.filter("a <> b").select("a", "b").distinct()), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("id"), F.col("b").alias("label"))
        seen = state
        both = now.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small, "a").select(
            F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))
        )
        last = folder
        now, folder = stored(_contract(linked.filter("a <> b").distinct()), "edges")
        delete_folder(edges.sparkSession, last)  # nothing reads an earlier round again
    raise RuntimeError("components did not settle")
