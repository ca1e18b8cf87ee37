"""N-gram Jaccard join by T-occurrence search (DivideSkip) and its components.

A document's set holds its distinct shingles of ``n`` words (lower-cased A-Z,
runs of bytes other than 0x20 and 0x09-0x0D); with fewer words the whole
sequence is one shingle, without words the set is empty and links to nothing.
Documents link where ``den * |intersection| >= num * |union|``.

1. Equal sets are grouped by digest; one representative goes on (within a
   batch of rows already before anything is sent).
2. Routing, exact by the pigeonhole principle: sets of linked documents differ
   in a bounded number of shingles, so if shingles are dealt into more segments
   than that, some segment is equal in both. Each representative sends one
   digest per segment. Linked sets agree in a number of digests that is known
   beforehand, so each may leave out that many but one, the most frequent ones
   (prefix filter); documents sharing one of the others fall into one block.
3. Within a block, T-occurrence search over inverted lists: the longest lists
   are set aside, the short ones merged, candidates with enough occurrences
   are completed by binary search in the long lists, and those reaching the
   required overlap link. Pairs already connected are skipped.
4. A block with more than ``CHUNK`` shingles is dealt to several tasks; each
   holds the block's first document too, so copies connect through it.
   Afterwards only documents outside the block's largest component still ask
   other chunks, one by one, and only those where one of their segment digests
   is held under another label. No task holds a whole group, and no pairs are
   listed within it.

Defined cases: null text counts as empty; a null doc_id counts as the smallest
id; rows with equal doc_id are one vertex (in ``deduplicate`` with ``by_text``
only rows with equal doc_id and text, by a 64-bit hash of both); repeated rows
repeat their result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm.anchors import NULL_ID, keyed
from tremor.llm.common import (
    gram_hashes,
    long_array,
    lowered,
    materialize,
    maybe_member,
    mix,
    slices,
    text_key,
    word_hashes,
    words,
)
from tremor.llm.components import components
from tremor.session import table

U64 = np.uint64
NUM, DEN = 85, 100
SHINGLE = 4
#: shingles that a task indexes at a time
CHUNK = 1 << 20
#: share of the shortest lists' work that long lists are worth (DivideSkip's constant)
MU = 0.05


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, row), distinct and sorted within each row."""
    data = lowered(data)
    starts, ends, row = words(data, offsets, True)
    hashes = word_hashes(data, starts, ends)
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    grams = gram_hashes(hashes, n)
    whole = row[: len(grams)] == row[n - 1 :] if len(grams) else np.zeros(0, bool)
    h, r = [grams[whole]], [row[: len(grams)][whole]]
    for k in range(1, n):
        short = np.flatnonzero(count == k)
        if len(short):
            h.append(gram_hashes(hashes, k)[first[short]] + U64(k))
            r.append(short)
    h, r = np.concatenate(h), np.concatenate(r)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def set_slices(column, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle hashes, rows) of consecutive slices of a text column."""
    for i, j, data, offsets in slices(column, 1 << 19):
        yield i, j, *shingle_sets(data, offsets, n)


def sums_of(h: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each row's set, as two sums."""
    sums = np.zeros(n_rows, U64), np.zeros(n_rows, U64)
    if len(h):
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        for s, x in zip(sums, (mix(h ^ U64(0x1D8E4E27C47D124F)), mix(h + U64(0xEB44ACCAB455D165)))):
            s[row[head]] = np.add.reduceat(x, head)
    return sums


class Segments:
    """Band limits and segment counts for the threshold."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        limits = [1]
        while limits[-1] <= largest * den // num + 1:
            limits.append(limits[-1] * den // num + 1)
        limits.append(limits[-1] * den // num + 1)
        self.limits = np.array(limits, np.int64)
        top = self.limits[1:] - 1  # largest size of each band
        differ = (den - num) * 2 * top // (den + num)
        self.slack = np.where(differ > 0, 1 + differ // 16, 0)
        self.count = differ + 1 + self.slack

    def digests(self, h: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment digest, row, spare) of each row's set, for its own band and the next.

        Two linked sets of one band's segments agree in more than (spare >> 1) of the digests sent (its last bit tells
        the two bands apart): all segments, less those that the most differing shingles can touch, less the empty
        ones that one of the two does not send.
        """
        sizes = np.bincount(row, minlength=n_rows)
        band = np.searchsorted(self.limits, sizes, "right") - 1
        value, spread = mix(h + U64(0x632BE59BD9B4E019)), mix(h ^ U64(0x8CB92BA72F3D8DD7)) >> U64(8)
        out, rows, spares = [], [], []
        for up in (0, 1):
            g = band + up
            most = np.minimum(sizes * self.den // self.num, self.limits[np.minimum(np.maximum(g, 0) + 1, len(self.limits) - 1)] - 1)
            differ = (self.den - self.num) * (sizes + most) // (self.den + self.num)
            k = self.count[np.maximum(g, 0)]
            seg = (spread % k[row].astype(U64)).astype(np.int64)
            base = np.cumsum(np.where(sizes > 0, k, 0)) - np.where(sizes > 0, k, 0)
            slot = base[row] + seg
            order = np.argsort(slot, kind="stable")
            ordered = slot[order]
            head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else order
            if not len(head):
                continue
            sums = np.add.reduceat(value[order], head)
            r, s = row[order[head]], seg[order[head]]
            tag = mix((g[r] * (1 << 32) + s + 1).astype(U64))
            out.append(mix(sums ^ tag))
            rows.append(r)
            # rows with so many empty segments that an empty one may be the only equal one send those as well
            empty = np.where(sizes > 0, k, 0) - np.bincount(r, minlength=n_rows)
            unsent = np.minimum(empty, self.slack[np.maximum(g, 0)])
            spare = np.maximum(k - differ - unsent - 1, 0) * 2 + up
            spares.append(spare[r])
            for x in np.flatnonzero((sizes > 0) & (empty > self.slack[np.maximum(g, 0)])):
                free = np.setdiff1d(np.arange(k[x]), s[r == x])
                out.append(mix(mix((g[x] * (1 << 32) + free + 1).astype(U64)) ^ U64(0x5851F42D4C957F2D)))
                rows.append(np.full(len(free), x))
                spares.append(np.full(len(free), spare[x]))
        if not out:
            return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out), np.concatenate(rows), np.concatenate(spares)


class Search:
    """T-occurrence search over inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den = num, den
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.tokens, number = np.unique(np.concatenate(sets), return_inverse=True)
        self.lists = np.repeat(np.arange(len(sets)), self.sizes)[np.argsort(number, kind="stable")]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(self.tokens)))])

    def required(self, a: int, b: np.ndarray) -> np.ndarray:
        """Least overlap at which sets of these sizes link."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def partners(self, query: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Allowed sets that link to the query set."""
        a = len(query)
        fits = allowed & (self.sizes * self.den >= a * self.num) & (self.sizes * self.num <= a * self.den)
        if not fits.any():
            return np.zeros(0, np.int64)
        least = int(self.required(a, self.sizes[fits].min()))
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        mine = at[self.tokens[at] == query]
        if len(mine) < least:
            return np.zeros(0, np.int64)
        length = self.begin[mine + 1] - self.begin[mine]
        order = np.argsort(length, kind="stable")
        aside = min(least - 1, int(least / (MU * np.log2(int(length.max()) + 1) + 1)))
        short, long = mine[order[: len(mine) - aside]], mine[order[len(mine) - aside :]]
        # merge of the short lists: occurrences of each set
        pieces = [self.lists[self.begin[t] : self.begin[t + 1]] for t in short]
        merged = np.bincount(np.concatenate(pieces), minlength=len(self.sizes))
        found = np.flatnonzero(fits & (merged >= least - aside))
        if not len(found):
            return found
        count = merged[found]
        need = self.required(a, self.sizes[found])
        left = len(long)
        for t in long:  # binary search of the candidates in each long list
            lst = self.lists[self.begin[t] : self.begin[t + 1]]
            at = np.searchsorted(lst, found)
            count = count + ((at < len(lst)) & (lst[np.minimum(at, len(lst) - 1)] == found))
            left -= 1
            alive = count + left >= need
            if not alive.all():
                found, count, need = found[alive], count[alive], need[alive]
                if not len(found):
                    break
        return found[count >= need]


class Group:
    """Search within one (block, chunk): its own sets are indexed, sets of other chunks are asked one by one.

    Labels stand for what is connected already; a link is reported only if it connects two labels.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.uid: list[int] = []
        self.sets: list[np.ndarray] = []
        self.asks: list[int] = []
        self.number: dict[int, int] = {}
        self.up: list[int] = []
        self.own: list[int] = []
        self.search: Search | None = None

    def _part(self, label: int) -> int:
        k = self.number.setdefault(label, len(self.up))
        if k == len(self.up):
            self.up.append(k)
        while self.up[k] != k:
            k = self.up[k]
        return k

    def add(self, uid: int, label: int, query: bool, shingles: np.ndarray) -> None:
        if query:
            self.asks.append(len(self.uid))
        self.uid.append(uid)
        self.sets.append(shingles)
        self.own.append(self._part(label))

    def ask(self, uid: int, label: int, shingles: np.ndarray) -> Iterator[tuple[int, int]]:
        if not self.uid:
            return
        if self.search is None:
            self.search = Search(self.sets, self.num, self.den)
            self.part = np.array([self.up[k] for k in self.own])
        mine = self._part(label)
        for y in self.search.partners(shingles, self.part != mine):
            other = int(self.part[y])
            if other != mine:
                self.up[other] = mine
                self.part[self.part == other] = mine
                yield uid, self.uid[y]

    def finish(self) -> Iterator[tuple[int, int]]:
        for x in self.asks if len(self.uid) > 1 else []:
            yield from self.ask(self.uid[x], self.labels[x], self.sets[x])

    @property
    def labels(self) -> list[int]:
        if not hasattr(self, "_labels"):
            names = {k: label for label, k in self.number.items()}
            self._labels = [names[k] for k in self.own]
        return self._labels


def find_links(members: DataFrame, num: int, den: int, n: int) -> DataFrame:
    """Edges (a, b) found within each (block, chunk); memory holds the chunk's own sets only.

    Texts travel, not sets: a set of 64-bit hashes takes more room than its compressed text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, group = None, None, Group(num, den)
        found: list[tuple[int, int]] = []
        for b in batches:
            block, chunk, ids, texts, labels, queries, homes = (b.column(k).to_pylist() for k in range(7))
            for i, j, flat, row in set_slices(b.column(7), n):
                edges = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(i, j):
                    if key != (block[r], chunk[r]):
                        found.extend(group.finish())
                        key, last, group = (block[r], chunk[r]), None, Group(num, den)
                    if last == (ids[r], texts[r]):  # a repeated row
                        continue
                    last = (ids[r], texts[r])
                    shingles = flat[edges[r - i] : edges[r - i + 1]]
                    if homes[r]:
                        group.add(ids[r], labels[r], queries[r], shingles.copy())
                    elif queries[r]:
                        found.extend(group.ask(ids[r], labels[r], shingles))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
                found = []
        found.extend(group.finish())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    dealt = members.repartition("block", "chunk").sortWithinPartitions("block", "chunk", F.desc("home"), "uid", "th")
    return dealt.mapInArrow(run, "a long, b long")


def other_places(state: DataFrame, meets: DataFrame) -> DataFrame:
    """Where documents of split blocks (uid, th, block, chunk, label) must still be compared: (uid, th, block, chunk,
    label, query, home).

    Only documents outside their block's largest component ask, and each asks only the chunks where a document with
    another label holds one of its segment digests (linked sets share one). Only such documents are indexed there.
    ``meets`` has (digest, uid, root) for every digest of several documents.
    """
    parts = state.groupBy("block", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("block").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts"))
    several = state.join(main.filter("parts > 1"), "block")
    holds = meets.select("digest", "uid").unionByName(meets.select("digest", F.col("root").alias("uid")).distinct())
    placed = several.select("uid", "th", "block", "chunk", "label")
    asking = holds.join(several.filter("label <> main").select(*placed.columns), "uid")
    asking = materialize(asking, "asking")
    both = [F.min("label").alias("low"), F.max("label").alias("high")]
    other = "low <> label or high <> label"
    asked = holds.join(asking.groupBy("digest").agg(*both), "digest").join(placed, "uid").filter(other)
    asked = materialize(asked.drop("low", "high"), "asked")
    homes = asked.select(*placed.columns, F.lit(False).alias("query"), F.lit(True).alias("home"))
    there = asked.groupBy("digest", F.col("chunk").alias("at")).agg(*both)
    # a document's own chunk has been searched before
    asks = asking.join(there, "digest").filter("at <> chunk").filter(other)
    asks = asks.select("uid", "th", "block", F.col("at").alias("chunk"), "label", F.lit(True).alias("query"), F.lit(False).alias("home"))
    return homes.distinct().unionByName(asks.distinct())


def star_edges(meets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the same documents as (uid, root): of a uid only the one to its least root, and each of its
    other roots to that one. Documents of a large group share most of their roots, so these pairs are few."""
    least = meets.select("uid", "root", F.min("root").over(Window.partitionBy("uid")).alias("m"))
    own = meets.groupBy("uid").agg(F.min("root").alias("b")).select(F.col("uid").alias("a"), "b")
    return own.unionByName(least.filter("root <> m").select(F.col("root").alias("a"), F.col("m").alias("b")).distinct())


def link_components(docs: DataFrame, num: int = NUM, den: int = DEN, n: int = SHINGLE) -> DataFrame:
    """uid, th, n_shingles, component for every row of (doc_id, text); rows with equal doc_id are one vertex."""
    return linked(keyed(docs), num, den, n)


def linked(texts: DataFrame, num: int, den: int, n: int) -> DataFrame:
    """uid, th, n_shingles, component (its least uid) for every row of (uid, th, text); ``uid`` is the vertex."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, h, r in set_slices(b.column(2), n):
                size = np.bincount(r, minlength=j - i)
                sums = sums_of(h, r, j - i)
                cols = [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), long_array(size), *map(long_array, sums)]
                yield pa.RecordBatch.from_arrays(cols, names=["uid", "th", "n_shingles", "d1", "d2"])

    sized = materialize(
        texts.select("uid", "th", "text").mapInArrow(measure, "uid long, th long, n_shingles long, d1 long, d2 long"), "shingle-sizes"
    )
    first = (
        sized.filter("n_shingles > 0")
        .groupBy("d1", "d2", "n_shingles")
        .agg(F.min(F.struct("uid", "th")).alias("first"))
        .select("d1", "d2", "n_shingles", "first.uid", "first.th")
    )
    largest = sized.agg(F.max("n_shingles")).first()[0] or 1
    segments = Segments(num, den, int(largest))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of equal sets in a batch only the least uid sends; the representative always does."""
        for b in batches:
            uid = b.column(0).to_numpy()
            order = np.argsort(uid, kind="stable")
            seen: set[tuple[int, int]] = set()
            parts = [(i, j, *sums_of(h, r, j - i), h, r) for i, j, h, r in set_slices(b.column(1), n)]
            if not parts:
                continue
            keys = list(zip(*(np.concatenate([p[k] for p in parts]).tolist() for k in (2, 3))))
            sends = np.zeros(len(uid), bool)
            for x in order:
                if keys[x] not in seen:
                    seen.add(keys[x])
                    sends[x] = True
            for i, j, _, _, h, r in parts:
                on = sends[i + r]
                digest, row, spare = segments.digests(h[on], r[on], j - i)
                cols = [long_array(digest), pa.array(uid[i + row]), pa.array(spare.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["digest", "uid", "spare"])

    routed = texts.select("uid", "text").mapInArrow(send, "digest long, uid long, spare int")
    sharing = Window.partitionBy("digest")
    shared = routed.withColumn("n", F.count("*").over(sharing)).filter("n > 1")
    several = sized.groupBy("uid").agg(F.count("*").alias("n")).filter("n > 1").select("uid")
    # rows that share a uid keep all digests: theirs cannot be told apart here
    shared = shared.withColumn("spare", F.when(maybe_member(several), 0).otherwise(F.col("spare")))
    shared = materialize(shared, "shared-digests")
    common = Window.partitionBy("uid", "spare").orderBy(F.desc("n"), "digest")
    rare = shared.filter("spare > 1").withColumn("at", F.row_number().over(common)).filter("at > shiftright(spare, 1)").drop("at")
    rare = rare.unionByName(shared.filter("spare <= 1")).select("digest", "uid")
    meets = materialize(rare.withColumn("root", F.min("uid").over(sharing)).filter("uid <> root"), "rare-digests")
    coarse = materialize(components(star_edges(meets)), "blocks")
    block = coarse.unionByName(coarse.select(F.col("label").alias("id"), "label").distinct())
    block = block.select(F.col("id").alias("uid"), F.col("label").alias("block")).join(first.select("uid", "th", "n_shingles"), "uid")
    size = block.groupBy("block").agg(F.sum("n_shingles").alias("shingles"))
    chunks = F.ceil(F.col("shingles") / CHUNK)
    placed = block.join(size, "block").select(
        "uid", "th", "block", chunks.alias("chunks"), F.pmod(F.xxhash64("uid", "th"), chunks).alias("chunk")
    )

    def members(where: DataFrame) -> DataFrame:
        """Texts of the documents at the places (block, chunk) that ``where`` names; at ``home`` they are indexed."""
        near = texts.filter(maybe_member(where.select("uid")))  # other texts are not shuffled
        return near.join(where, ["uid", "th"]).select("block", "chunk", "uid", "th", "label", "query", "home", "text")

    everywhere = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    first_of_split = (F.col("uid") == F.col("block")) & (F.col("chunks") > 1)
    at = F.explode(F.when(first_of_split, everywhere).otherwise(F.array("chunk"))).alias("chunk")
    own = placed.select("uid", "th", "block", at, F.col("uid").alias("label"), F.lit(True).alias("query"), F.lit(True).alias("home"))
    known = edges = materialize(find_links(members(own), num, den, n), "links")
    split = placed.filter("chunks > 1")
    if not split.isEmpty():
        labels = components(edges)
        state = split.join(labels.withColumnRenamed("id", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
        places = other_places(materialize(state, "split-blocks"), meets)
        more = find_links(members(materialize(places, "places")), num, den, n)
        known = materialize(labels.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(more), "links")

    copies = sized.filter("n_shingles > 0").join(first.withColumnRenamed("uid", "rep").drop("th"), ["d1", "d2", "n_shingles"])
    # rows of one doc_id with different texts are one vertex
    own = copies.groupBy("uid").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).filter("b < most")
    same_id = copies.join(own, "uid").select(F.col("rep").alias("a"), "b")
    labels = components(known.unionByName(same_id))
    member = copies.select("uid", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    member = member.groupBy("uid").agg(F.min(F.coalesce("label", "rep")).alias("component"))
    return sized.select("uid", "th", "n_shingles").join(member, "uid", "left").withColumn(
        "component", F.coalesce("component", "uid")
    )


def deduplicate(docs: DataFrame, num: int = NUM, den: int = DEN, n: int = SHINGLE, by_text: bool = False) -> DataFrame:
    """One document of each group of linked documents: the one with the least doc_id (a repeated row stays once).

    Rows with equal doc_id are one document; with ``by_text`` only rows with equal doc_id and text are, so rows that
    share a doc_id or have none are judged by their own texts.
    """
    row = F.struct("*").alias("row")
    own_id, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.coalesce("text", F.lit(""))
    th = text_key(F.col("text")).alias("th")
    rows = docs.select(row, text.alias("text"), own_id.alias("id"), own_id.alias("uid"), th)
    if by_text:  # an id that is certainly alone stands for its text (and takes less room than a hash)
        several = rows.groupBy("uid").agg(F.count("*").alias("n")).filter("n > 1").select("uid")
        rows = rows.withColumn("uid", F.when(maybe_member(several), F.xxhash64("id", "text")).otherwise(F.col("uid")))
    found = linked(rows.select("uid", "text", "th"), num, den, n).groupBy("uid").agg(
        F.min("th").alias("th"), F.count("*").alias("rows"), F.min("component").alias("component")
    )
    ids = rows.filter("id <> uid").groupBy("uid").agg(F.min("id").alias("id"))
    found = materialize(found.join(ids, "uid", "left").withColumn("id", F.coalesce("id", "uid")), "groups")
    kept = found.groupBy("component").agg(F.min(F.struct("id", "uid", "th")).alias("k")).select("k.uid", "k.th")
    kept = materialize(kept, "kept")
    gone = found.join(kept, ["uid", "th"], "left_anti").select("uid")
    # rows whose document is certainly alone and kept pass without a shuffle
    doubtful = maybe_member(gone.unionByName(found.filter("rows > 1").select("uid")))
    keyed_rows = rows.select("row", "uid", "th")
    own = keyed_rows.filter(doubtful).join(kept, ["uid", "th"], "left_semi")
    one = own.withColumn("n", F.row_number().over(Window.partitionBy("uid", "th").orderBy("uid"))).filter("n = 1")
    return keyed_rows.filter(~doubtful).select("row.*").unionByName(one.select("row.*"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every whole text of ``documents``."""

    def real(c: str):
        return F.when(F.col(c) != NULL_ID, F.col(c))

    out = link_components(table(spark, sf_dir, "documents"))
    return out.select(real("uid").alias("doc_id"), "n_shingles", real("component").alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS s FROM d, unnest(range(1, greatest(len(w) - 2, 2))) t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), linked AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), both_ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
