"""Star integrity checks: orphans, duplicate keys, duplicate event ids.

Every check is an aggregate, so the whole report is one small DataFrame of
``(check, violations)`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOREIGN_KEYS = [
    ("dim_date", "DateKey"),
    ("dim_location", "LocationKey"),
    ("dim_magnitude", "MagnitudeKey"),
    ("dim_event_type", "EventTypeKey"),
]


def star_integrity(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All checks from one pass over the fact and one over each dimension.

    Fact rows are counted per (key name, value) with map-side partial aggregation, met by the dimensions' rows per
    (key name, value) in the same grouping, and one small aggregate per check follows.
    """
    names = [key for _, key in FOREIGN_KEYS] + ["EventID"]
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in names])
    rows = fact.select(F.inline(pairs)).select("name", "value", F.lit(1).alias("in_fact"), F.lit(0).alias("in_dim"))
    for dim_name, key in FOREIGN_KEYS:
        rows = rows.unionByName(
            dims[dim_name].select(
                F.lit(key).alias("name"), F.col(key).cast("string").alias("value"), F.lit(0).alias("in_fact"), F.lit(1).alias("in_dim")
            )
        )
    per_value = rows.groupBy("name", "value").agg(F.sum("in_fact").alias("f"), F.sum("in_dim").alias("d"))
    checks = []
    for dim_name, key in FOREIGN_KEYS:
        mine = F.col("name") == key
        checks.append((f"fact_{key}_orphans", F.sum(F.when(mine & (F.col("d") == 0), F.col("f")))))
    for dim_name, key in FOREIGN_KEYS:
        checks.append((f"{dim_name}_duplicate_{key}", F.sum(F.when((F.col("name") == key) & (F.col("d") > 1), F.col("d") - 1))))
    checks.append(("fact_duplicate_EventID", F.sum(F.when((F.col("name") == "EventID") & (F.col("f") > 1), F.col("f") - 1))))
    one = per_value.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in checks])
    each = F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("violations")) for name, _ in checks])
    return one.select(F.inline(each))
