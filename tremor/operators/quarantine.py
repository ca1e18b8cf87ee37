"""Quarantine: rejected rows stay readable and can be replayed under changed rules.

``fan_out`` sends each flattened Bronze row down one of two lanes in a single pass: a bit mask says which quality rules
the row fails (bit k: rule k of ``quality.rules``), and one partitioned write puts rows with an empty mask into
``lane=valid`` and the others, unchanged and with their mask, into ``lane=rejected`` of the run's folder. The Silver plan
then reads the valid lane, so Bronze is parsed once; ``settle`` removes that lane when Silver is written.

``replay`` judges the rejected rows again under the rules of today. Rows that now pass are merged into Silver and leave
the quarantine; the others stay, in a folder of the replay, with their new mask. The folders that it replaces are noted
and deleted after the merge. The next replay finishes one that was cut off after its merge and undoes one that did not
get that far, so no rejected row is lost or kept twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..plans import silver as silver_plan
from ..session import path_exists, touch
from ..sinks import tables
from . import quality

MASK = "failed_rules"
VALID, REJECTED = "valid", "rejected"
Rules = Callable[[], dict[str, Column]]


def failed_mask(rules: Rules = quality.rules) -> Column:
    """Bit k is set when rule k does not hold (null never holds)."""
    bits = [F.when(F.coalesce(p, F.lit(False)), 0).otherwise(1 << k) for k, p in enumerate(rules().values())]
    return sum(bits, F.lit(0)).cast("bigint")


def rule_names(mask: Column | str, rules: Rules = quality.rules) -> Column:
    """Names of the failed rules, in rule order."""
    m = F.col(mask) if isinstance(mask, str) else mask
    named = [F.when(m.bitwiseAND(F.lit(1 << k)) != 0, F.lit(n)) for k, n in enumerate(rules())]
    return F.array_compact(F.array(*named))


def masked(flat: DataFrame, rules: Rules = quality.rules) -> DataFrame:
    """Flattened Bronze rows with the mask of the rules that they fail."""
    packed = flat.select(F.struct("*").alias("_row"), "*")
    typed = silver_plan.select_typed(packed, keep=("_row",))
    return typed.select("_row", failed_mask(rules).alias(MASK)).select("_row.*", MASK)


def lane_schema(flat: DataFrame) -> StructType:
    return StructType([*flat.schema.fields, StructField(MASK, LongType())])


def fan_out(flat: DataFrame, path: str, run_id: str | None = None, rules: Rules = quality.rules) -> tuple[DataFrame, str]:
    """Write both lanes in one pass; returns the valid rows, read back, and the run's folder."""
    folder = f"{path}/run={run_id or uuid.uuid4().hex}"
    lane = F.when(F.col(MASK) == 0, VALID).otherwise(REJECTED).alias("lane")
    masked(flat, rules).select("*", lane).write.mode("overwrite").partitionBy("lane").parquet(folder)
    return read_lane(flat.sparkSession, folder, VALID, lane_schema(flat)).drop(MASK), folder


def read_lane(spark: SparkSession, folder: str, lane: str, schema: StructType) -> DataFrame:
    """One lane of a run (empty when no row took it)."""
    found = tables.glob_folders(spark, f"{folder}/lane=*")
    paths = [f for f in found if f.endswith(f"/lane={lane}")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def settle(spark: SparkSession, folder: str) -> None:
    """Remove the valid lane of a run whose rows are in Silver."""
    tables.delete_folder(spark, f"{folder}/lane={VALID}")


def rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All quarantined rows with their mask; ``schema``: that of the lanes."""
    folders = tables.glob_folders(spark, f"{path}/run=*/lane={REJECTED}")
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def balance(lanes: DataFrame, rules: Rules = quality.rules) -> DataFrame:
    """Per rule: rows that fail it and rows that pass it, from both lanes in one pass; ``all`` for all rules together."""
    names = list(rules())
    parts = [F.struct(F.lit(n).alias("rule"), (F.col(MASK).bitwiseAND(F.lit(1 << k)) != 0).alias("failed")) for k, n in enumerate(names)]
    parts.append(F.struct(F.lit("all").alias("rule"), (F.col(MASK) != 0).alias("failed")))
    return lanes.select(F.inline(F.array(*parts))).groupBy("rule").agg(
        F.count_if(~F.col("failed")).alias("valid_rows"), F.count_if("failed").alias("quarantined_rows"), F.count(F.lit(1)).alias("input_rows")
    )


def _finish_replays(spark: SparkSession, path: str) -> None:
    """Undo replays that did not reach Silver; drop what the others replaced."""
    for folder in tables.glob_folders(spark, f"{path}/run=replay-*"):
        if path_exists(spark, f"{folder}/_merged"):
            for mark in tables.glob_folders(spark, f"{folder}/_replaces/*"):
                tables.delete_folder(spark, f"{path}/{mark.rpartition('/')[2]}")
            settle(spark, folder)
        else:
            tables.delete_folder(spark, folder)


def replay(spark: SparkSession, path: str, silver_path: str, schema: StructType, rules: Rules = quality.rules) -> dict:
    """Merge the quarantined rows that pass ``rules`` into Silver; the others stay quarantined with their new mask."""
    from ..plans import jobs

    _finish_replays(spark, path)
    old = [f.rsplit("/", 2)[1] for f in tables.glob_folders(spark, f"{path}/run=*/lane={REJECTED}")]
    rows = rejected(spark, path, schema).drop(MASK)
    accepted, folder = fan_out(rows, path, f"replay-{uuid.uuid4().hex}", rules)
    merged = jobs.merge_silver(spark, accepted, silver_path, rules=rules)
    for run in old:
        touch(spark, f"{folder}/_replaces/{run}")
    touch(spark, f"{folder}/_merged")
    _finish_replays(spark, path)
    return {"accepted_rows": merged["flattened_rows"], "latest_rows": merged["latest_rows"], "months": merged["months"]}
