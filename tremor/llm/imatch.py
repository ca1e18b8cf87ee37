"""I-Match document fingerprints from DataFrame expressions only.

Terms are lower-cased runs of letters and digits. The lexicon keeps terms whose
inverse document frequency lies in a band, i.e. which occur in a share of
``LOW`` to ``HIGH`` of all documents; their number is bounded by the mean
number of distinct terms divided by ``LOW``, however many documents there are.
The lexicon is a constant array of ``SLOTS`` slots addressed by term hash (terms
that share a slot: the least hash stays), so a term is looked up in constant time
inside a row and no term leaves its document. A fingerprint sorts a document's
distinct lexicon terms and hashes those in each of several random subsets of
the lexicon, at keep rates 1/4 to 1/1024: frequent subsets tell near copies
apart, sparse ones survive large edits. The likeness of two fingerprints is
the share of equal subset hashes among those that are not empty in both.

The next document by falling doc_id comes from windows over buckets of
neighbouring ids; the first row of each bucket is sent to its predecessor's
bucket as well, so no task sees all ids.

Defined cases: a null text counts as empty; a document without lexicon terms
uses all its terms; without terms the fingerprint is the digest of its text
and the likeness 1 for equal, else 0; a null doc_id comes last; rows of equal
doc_id follow one another by text; a single document is its own next one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.session import table

LOW, HIGH = 0.005, 0.1
SLOTS = 1 << 15
#: (bits, subsets): so many random subsets of the lexicon keep each term at rate 2**-bits
SUBSETS = ((2, 4), (4, 6), (6, 12), (8, 16), (10, 10))
RANGES = 64
BUCKET_DOCS = 4000
NULL_ID = -(1 << 63)


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, slots: int = SLOTS) -> Column:
    """Constant array of the slots' term hashes (0: none); the driver sees ``slots`` numbers, whatever the corpus."""
    n = docs.count()
    seen = docs.select(F.explode(term_hashes(F.coalesce("text", F.lit("")))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    band = seen.filter(F.col("df").between(low * n, high * n))
    chosen = band.groupBy(F.pmod("h", F.lit(slots)).alias("slot")).agg(F.min("h").alias("h")).collect()
    values = [0] * slots
    for r in chosen:
        values[r["slot"]] = r["h"]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def fingerprints(rows: DataFrame, text: str, out: str, lex: Column, slots: int = SLOTS) -> DataFrame:
    """Add ``out``: the subset hashes (0: no term in the subset) of column ``text``."""
    terms = rows.withColumn("_all", term_hashes(F.col(text)))
    chosen = F.filter("_all", lambda h: F.get(lex, F.pmod(h, F.lit(slots)).cast("int")) == h)
    terms = terms.withColumn("_in", chosen)
    terms = terms.withColumn("_terms", F.sort_array(F.when(F.size("_in") > 0, F.col("_in")).otherwise(F.col("_all"))))
    subsets = ", ".join(
        f"struct({bits * 100 + r} AS seed, {(1 << bits) - 1}L AS mask)" for bits, repeats in SUBSETS for r in range(repeats)
    )
    hashes = f"""transform(
        transform(array({subsets}), s -> filter(_terms, t -> (xxhash64(t, s.seed) & s.mask) = 0)),
        a -> if(size(a) = 0, 0L, greatest(1L, xxhash64(a) & 4294967295L)))"""
    return terms.withColumn(out, F.expr(hashes)).drop("_all", "_in", "_terms")


def as_string(hashes: Column, text: Column) -> Column:
    digits = F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x), 8, "0")), "")
    return F.when(F.exists(hashes, lambda x: x != 0), digits).otherwise(F.concat(F.lit("-"), F.md5(text)))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Share of equal subset hashes among those not empty in both; without any, whether the texts are equal."""
    some = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.greatest(x, y)), lambda x: x != 0))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != 0)), lambda x: x))
    return F.when(some > 0, same / some).otherwise(equal.cast("double"))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add next_<column> of the row that follows by falling uid (after the last: the first); ties by text."""
    ids = rows.select("uid").filter(F.col("uid") != NULL_ID)
    stats = ids.agg(
        F.count("*").alias("n"), F.min("uid").alias("least"), F.max("uid").alias("most"),
        F.percentile_approx("uid", [k / RANGES for k in range(1, RANGES)], 2000).alias("cuts"),
    ).first()  # a fixed number of values
    n, cuts = stats["n"], sorted(set(stats["cuts"] or []))
    low = [stats["least"] or 0, *cuts]
    high = [*cuts, (stats["most"] or 0) + 1]
    parts = max(1, min(64, -(-n // (len(low) * BUCKET_DOCS))))

    def constants(values: list[int]) -> Column:
        return F.expr("array(" + ", ".join(f"CAST({v} AS BIGINT)" for v in values) + ")")

    part = F.size(F.filter(constants(cuts), lambda c: c <= F.col("uid"))) if cuts else F.lit(0)
    rows = rows.withColumn("_range", part)
    a, b = (F.get(constants(x), F.col("_range")).cast("double") for x in (low, high))
    inside = F.floor((F.col("uid").cast("double") - a) / F.greatest(b - a, F.lit(1.0)) * parts)
    place = F.col("_range") * parts + F.greatest(F.lit(0), F.least(F.lit(parts - 1), inside))
    rows = rows.withColumn("_bucket", place.cast("int")).drop("_range")
    heads = {r["_bucket"]: r["m"] for r in rows.groupBy("_bucket").agg(F.max("uid").alias("m")).collect()}  # at most RANGES * 64
    if not heads:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in columns]).drop("_bucket")
    order = sorted(heads, reverse=True)
    before = {b: order[k - 1] for k, b in enumerate(order)}  # the first bucket follows the last
    size = max(order) + 1
    head = F.get(constants([heads.get(k, 0) for k in range(size)]), F.col("_bucket"))
    target = F.get(constants([before.get(k, 0) for k in range(size)]), F.col("_bucket")).cast("int")
    own = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("copy"))
    sent = F.struct(target.alias("b"), F.lit(1).alias("copy"))
    rows = rows.withColumn("_to", F.explode(F.when(F.col("uid") == head, F.array(own, sent)).otherwise(F.array(own))))
    rows = rows.select(*[c for c in rows.columns if c not in ("_to", "_bucket")], F.col("_to.b").alias("_b"), F.col("_to.copy").alias("_copy"))
    after = Window.partitionBy("_b").orderBy("_copy", F.desc("uid"), "text")
    nexts = [F.lead(c).over(after).alias(f"next_{c}") for c in columns]
    return rows.select("*", *nexts).filter("_copy = 0").drop("_b", "_copy")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document and its edited text."""
    docs = table(spark, sf_dir, "documents")
    lex = lexicon(docs)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("uid"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = with_next(fingerprints(rows, "text", "fp", lex), ["text", "fp"])
    cut = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - cut), F.substring(F.col("next_text"), F.lit(1), cut)
    )
    rows = fingerprints(rows.withColumn("edited", edited), "edited", "edited_fp", lex)
    return rows.select(
        F.when(F.col("uid") != NULL_ID, F.col("uid")).alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("fp"), F.col("text")).alias("fingerprint"),
        as_string(F.col("edited_fp"), F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), F.col("text") == F.col("next_text")).alias("near_next"),
    )
