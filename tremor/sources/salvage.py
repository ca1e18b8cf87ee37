"""Salvage of broken documents: the intact features of a document that does not parse, in the scan's own pass.

The JSON reader hands over a broken document as text and every other one parsed. A broken one is cut at the places where
a feature begins (an unescaped ``{"type":"Feature"`` cannot stand inside a JSON string), each piece is followed bracket
by bracket, strings skipped, until the feature closes, and pieces that close and parse are read with the declared feature
schema. A piece that breaks off or does not parse costs that feature only; work is linear in the document. The envelope's
metadata is kept if it is intact, so a packed document keeps its hour.

``salvage`` says what happened to a broken document (null for the others): features found and intact, and the byte offset
up to which the document is sound, i.e. the start of the first feature that is not, or the end of the last feature before
the envelope breaks (0: the envelope breaks before its first feature).

Defined cases: an empty line is no document; a document without any feature's beginning gives no feature; features whose
first member is not ``type`` are lost; a document that parses but holds a value of a wrong type is not broken (that value
is null, as without salvage); nulls and repeated documents are kept as they are.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import bronze

CORRUPT = "_corrupt"
FEATURE_START = re.compile(rb'\{\s*"type"\s*:\s*"Feature"\s*[,}]')
ENVELOPE = re.compile(rb'"features"\s*:\s*\[\s*$')
METADATA = re.compile(rb'"metadata"\s*:\s*(?=\{)')
BETWEEN = re.compile(rb"\s*,\s*")
TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.DOTALL)
CLOSES = {b"}": b"{", b"]": b"["}

CUT = T.StructType(
    [
        T.StructField("metadata", T.StringType()),
        T.StructField("pieces", T.ArrayType(T.StringType())),
        T.StructField("found", T.LongType()),
        T.StructField("break_offset", T.LongType()),
    ]
)


def object_end(data: bytes, start: int, stop: int) -> int | None:
    """End of the JSON object that opens at ``start``; None if its brackets do not close before ``stop`` or do not match."""
    depth: list[bytes] = []
    for t in TOKEN.finditer(data, start, stop):
        c = t.group()
        if c in (b"{", b"["):
            depth.append(c)
        elif c in CLOSES:
            if not depth or depth.pop() != CLOSES[c]:
                return None
            if not depth:
                return t.end()
    return None


def intact(data: bytes, start: int, stop: int) -> tuple[str, int] | None:
    """Text and end of the object at ``start`` if it closes and parses."""
    end = object_end(data, start, stop)
    if end is None:
        return None
    try:
        text = data[start:end].decode()
        json.loads(text)
    except (ValueError, RecursionError):
        return None
    return text, end


def cut(document: str | None) -> tuple | None:
    """(metadata, intact features, features found, offset of the break) of a broken document."""
    if document is None:
        return None
    data = document.encode("utf-8", "replace")
    starts = [m.start() for m in FEATURE_START.finditer(data)]
    head = data[: starts[0]] if starts else data
    meta = METADATA.search(head)
    meta = intact(data, meta.end(), len(head)) if meta else None
    pieces, broken_at = [], None if starts and ENVELOPE.search(head) else 0
    last = 0
    for start, stop in zip(starts, [*starts[1:], len(data)]):
        if broken_at is None and pieces and not BETWEEN.fullmatch(data, last, start):
            broken_at = last
        piece = intact(data, start, stop)
        if piece:
            pieces.append(piece[0])
            last = piece[1]
        elif broken_at is None:
            broken_at = start
    return meta and meta[0], pieces, len(starts), last if broken_at is None else broken_at


#: row by row on purpose: only broken documents reach Python as text, and pickled rows are batched by their bytes, while
#: an Arrow batch would gather up to 10,000 documents of many megabytes each
_cut = F.udf(cut, CUT, useArrow=False)


def mend(docs: DataFrame) -> DataFrame:
    """Parsed documents with their raw text in ``CORRUPT`` where they are broken -> the same with salvaged features."""
    feature = docs.schema["features"].dataType.elementType
    metadata = docs.schema["metadata"].dataType
    broken = F.col("features").isNull() & F.col("metadata").isNull() & F.col(CORRUPT).isNotNull()
    docs = docs.withColumn("_cut", _cut(F.when(broken, F.col(CORRUPT))))
    parsed = F.transform("_cut.pieces", lambda p: F.from_json(p, feature))
    was_broken = F.col("_cut").isNotNull()
    report = F.struct(
        F.col("_cut.found").alias("found"), F.size("_cut.pieces").cast("bigint").alias("intact"), F.col("_cut.break_offset").alias("break_offset")
    )
    rest = [c for c in docs.columns if c not in ("metadata", "features", CORRUPT, "_cut")]
    return docs.select(
        *rest,
        F.when(was_broken, F.from_json("_cut.metadata", metadata)).otherwise(F.col("metadata")).alias("metadata"),
        F.when(was_broken, parsed).otherwise(F.col("features")).alias("features"),
        F.when(was_broken, report).alias("salvage"),
    )


def read_documents(spark: SparkSession, path: str | list[str], streaming: bool = False, for_silver: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """``bronze.read_documents`` with the intact features of broken documents, and the column ``salvage``."""
    schema = schemas.SILVER_DOCUMENT if for_silver else schemas.BRONZE_DOCUMENT
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = bronze._reader(spark, streaming, with_text, max_files_per_trigger)
    return mend(reader.option("columnNameOfCorruptRecord", CORRUPT).json(path))


def report(docs: DataFrame) -> DataFrame:
    """One row: documents, broken ones, their features found, salvaged and lost."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("salvage").alias("broken_documents"),
        total("salvage.intact").alias("salvaged_features"),
        total(F.col("salvage.found") - F.col("salvage.intact")).alias("lost_features"),
    )
