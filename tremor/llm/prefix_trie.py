"""Prefix trie of conversations, by collapsing whole sequences.

Conversations are rebuilt first: conversation c takes the first h turns of conversation c - c % ``family`` (h: crc32 of c
modulo ``heads``), then its own turns after its first h. Turns sort by turn (null first); equal turns by role, then by the
md5 of the turn. Each distinct sequence of first d rebuilt turns (role, text) is a node; the root has no turn.

1. A turn becomes a digest (md5 of role and text) and its length, so no text is ever shuffled. First turns are found by
   a row limit per conversation that Spark applies before the shuffle; sorted by conversation, the turns stream through
   :func:`_prefixes`, which chains digests into one digest per prefix. It holds one turn at a time.
2. Identical rebuilt conversations collapse to one weighted sequence (digest of the whole; counted before the shuffle,
   so copies cost one row per task), their ids go to end lists. Only one member's prefix rows stay per sequence.
3. Sequences that are proper prefixes of others are dropped by an anti-join; the rest are the leaves.
4. Weighted prefixes are aggregated to nodes. A node belongs to the sequence of its smallest member, so each node's
   length is added up once: saved(v) = sum over sequences s through v of weight * (length of s from v on)
   - (length of s from v on that s owns).

An end list is cut by ranges of 4,096 ids; the pieces stream through one SHA-256 in ascending order, so the list of a
sequence that a third of all conversations share is never held in one row.

Defined cases: a null role or text counts as empty; rows without conv_id belong to no conversation and make no node;
repeated rows are turns of their own; a conversation whose rebuilt form has no turns ends at the root; an empty table
gives no rows, also no root; other columns are ignored. A conversation of any length streams through one task in
bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm.common import materialize
from tremor.session import table

FAMILY = 100
HEADS = 6
RANGE_BITS = 12
ROOT = hashlib.md5(b"root").digest()
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
BATCH = 20_000
PREFIX_SCHEMA = "conv_id long, depth long, node binary, parent binary, n_before long, n_upto long, last boolean"


def head_turns(conv_id: Column, heads: int = HEADS) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % heads


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n_chars) of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
    )


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Turns by conversation with ``own``: 0 for the turns taken over, 1 for all own ones, the replaced first ones included."""
    base = F.col("conv_id") - F.col("conv_id") % family
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "digest"))
    firsts = turns.filter(F.col("conv_id") % family == 0).withColumn("_place", place).filter(F.col("_place") < heads)
    firsts = firsts.withColumnRenamed("conv_id", "_base")
    members = turns.select("conv_id").distinct().withColumn("_base", base)
    taken = members.join(firsts, "_base").filter(F.col("_place") <= head_turns(F.col("conv_id"), heads))
    columns = ["conv_id", "turn", "role", "digest", "n_chars"]
    return taken.select(*columns, F.lit(0).alias("own")).unionByName(turns.select(*columns, F.lit(1).alias("own")))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix rows of each conversation from its turns in order: root, then one per kept turn; the last one is marked."""
    out: list[tuple] = []
    conv, held, left = None, None, 0

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()))],
            names=[c.split()[0] for c in PREFIX_SCHEMA.split(", ")],
        )
        out.clear()
        return rows

    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("conv_id", "own", "skip", "digest", "n_chars")]
        for c, own, skip, digest, n in zip(*columns):
            if c != conv:
                if held:
                    out.append((*held, True))
                conv, held, left = c, (c, 0, ROOT, None, 0, 0), skip
            if own and left:
                left -= 1
                continue
            out.append((*held, False))
            held = (c, held[1] + 1, hashlib.md5(held[2] + digest, usedforsecurity=False).digest(), held[2], held[5], held[5] + n)
            if len(out) >= BATCH:
                yield flush()
    if held:
        out.append((*held, True))
    if out:
        yield flush()


def prefix_rows(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per conversation and prefix of its rebuilt turns (see ``PREFIX_SCHEMA``)."""
    rows = rebuilt(turn_digests(turns), family, heads).withColumn("skip", head_turns(F.col("conv_id"), heads))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "own", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", "own", "skip", "digest", "n_chars").mapInArrow(_prefixes, PREFIX_SCHEMA)


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): digest of each node's ids, ascending, joined by commas."""
    pieces = ends.groupBy("node", F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done: list[tuple[bytes, str]] = []
            for n, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if n != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in ((0, pa.binary()), (1, pa.string()))], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    ordered = pieces.repartition("node").sortWithinPartitions("node", "range")
    return ordered.select("node", "ids").mapInArrow(run, "node binary, ends_sha256 string")


def trie(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = materialize(prefix_rows(turns, family, heads), "prefixes")
    whole = rows.filter("last")
    sequences = whole.groupBy("node").agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.first("n_upto").alias("total")
    )
    sequences = materialize(sequences, "sequences")
    # the prefixes of one member stand for all of its copies
    prefixes = rows.join(sequences.select("conv_id", "weight", "total"), "conv_id")
    prefixes = materialize(prefixes, "sequence-prefixes")
    inner = prefixes.filter("not last").select("node").distinct()
    leaves = sequences.join(inner, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    smallest = prefixes.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.first("n_before").alias("n_before"))
    owned = smallest.groupBy("conv_id").agg(F.min("n_before").alias("owned_from"))
    facts = sequences.select("conv_id").join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
    through = prefixes.join(facts, "conv_id")
    rest = F.col("total") - F.col("n_before")
    owns = F.when(F.col("owned_from").isNotNull(), F.col("total") - F.greatest("n_before", "owned_from")).otherwise(0)
    nodes = through.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * rest - owns).alias("saved_tokens"),
    )
    nodes = materialize(nodes, "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = end_digests(whole.select("node", "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, "parent", "left").join(children, "node", "left").join(ends, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the trie of all rebuilt ``conversations``."""
    return trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, place, role, txt FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
  UNION ALL SELECT t.conv_id, 1, place, role, txt FROM t JOIN c ON t.conv_id = c.conv_id WHERE place > h
), x AS (
  SELECT conv_id, row_number() OVER w AS depth, length(txt) AS n,
    md5(string_agg(md5(length(role) || ':' || role || txt), '') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM x GROUP BY node, depth
), up AS (
  SELECT DISTINCT a.node, b.node AS parent FROM x a JOIN x b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1
), kids AS (
  SELECT parent, count(*) AS n_children FROM up GROUP BY parent
), subtree AS (
  SELECT DISTINCT a.node AS top, b.node FROM x a JOIN x b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), sums AS (
  SELECT top, sum((n_convs - 1) * n) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM subtree s JOIN nodes ON nodes.node = s.node LEFT JOIN kids ON kids.parent = s.node GROUP BY top
), ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM x JOIN (SELECT conv_id, max(depth) AS depth FROM x GROUP BY conv_id) USING (conv_id, depth) GROUP BY node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums ON sums.top = n.node LEFT JOIN up ON up.node = n.node LEFT JOIN nodes p ON p.node = up.parent
LEFT JOIN kids ON kids.parent = n.node LEFT JOIN ends ON ends.node = n.node
"""
