"""Ledger of landed folders that a run has read, and the pruned read it allows.

Bronze folders carry their hours in their names (``yyyy=/MM=/dd=/HH=``, ``yyyy/MM/dd/HH`` or a pack's ``from=/to=``), so
an incremental run can choose its folders from a listing, without opening a file: those that no earlier run has read,
whatever their hour (late fetches), and of the others those of the last 48 hours, which are read again because the
source corrects recent events. The ledger is a small table beside the lake, one row per folder read; a run adds its rows
after its tables are written, so a failed run's folders are read again (the merge makes that harmless).

The listing and the ledger hold one entry per landed folder, never per document or row.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..session import path_exists
from ..sinks import packs, tables
from . import bronze

LEDGER_SCHEMA = "folder string, run_id string, read_at timestamp"
HOUR_KEYS = ["yyyy", "MM", "dd", "HH"]
PLAIN_HOURS = re.compile(r"/(\d{4})/(\d{2})/(\d{2})/(\d{2})$")


@dataclass(frozen=True)
class Folder:
    """A landed folder; ``key`` names it in the ledger, ``origin`` the pack that its documents come from."""

    path: str
    key: str
    first: dt.datetime | None
    last: dt.datetime | None
    origin: str | None = None


def _hour(text: str) -> dt.datetime | None:
    return None if text == packs.NO_HOUR else dt.datetime.strptime(text, "%Y%m%d%H")


def landed(spark: SparkSession, path: str) -> list[Folder]:
    """All landed folders below ``path``, from three listings by pattern."""
    found = []
    for folder, v in tables.list_folders(spark, path, HOUR_KEYS):
        if all(v[k].isdigit() for k in HOUR_KEYS):
            hour = _hour("".join(v[k] for k in HOUR_KEYS))
            found.append(Folder(folder, "/".join(v[k] for k in HOUR_KEYS), hour, hour))
        else:  # rows without a time
            found.append(Folder(folder, "/".join(v[k] for k in HOUR_KEYS), None, None))
    for folder in tables.glob_folders(spark, f"{path}/[0-9][0-9][0-9][0-9]/[0-9][0-9]/[0-9][0-9]/[0-9][0-9]"):
        parts = PLAIN_HOURS.search(folder).groups()
        hour = _hour("".join(parts))
        found.append(Folder(folder, "/".join(parts), hour, hour))
    for token, (folder, first, last) in packs.packs(spark, path).items():
        origin = token.rpartition("~")[2] if "~" in token else None
        found.append(Folder(folder, token, _hour(first), _hour(last), origin))
    return found


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def seen(spark: SparkSession, ledger_path: str) -> set[str]:
    return {r["folder"] for r in read_ledger(spark, ledger_path).select("folder").distinct().collect()}


def record(spark: SparkSession, ledger_path: str, folders: list[Folder], run_id: str) -> None:
    """Note folders as read (call after the run's tables are written)."""
    if folders:
        now = dt.datetime.now(dt.timezone.utc)
        rows = spark.createDataFrame([(f.key, run_id, now) for f in folders], LEDGER_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(ledger_path)


@dataclass(frozen=True)
class Window:
    """What an incremental run reads: folders new to the ledger whole, known ones only from ``since`` on."""

    unread: list[Folder]
    recent: list[Folder]
    since: dt.datetime | None

    def folders(self) -> list[Folder]:
        return self.unread + self.recent


def pending(spark: SparkSession, path: str, ledger_path: str, lookback_hours: int = fixed.INCREMENTAL_HOURS) -> Window:
    """The unread folders, and the read ones that reach into the look-back before the newest landed hour."""
    known = seen(spark, ledger_path)
    folders = landed(spark, path)
    newest = max((f.last for f in folders if f.last), default=None)
    since = newest - dt.timedelta(hours=lookback_hours) if newest else None
    unread = [f for f in folders if f.key not in known and f.origin not in known]
    fresh = {f.key for f in unread}
    recent = [f for f in folders if f.key not in fresh and f.last and f.last > since]
    return Window(unread, recent, since)


def read_window(spark: SparkSession, window: Window, for_silver: bool = False, read=bronze.read_documents) -> DataFrame:
    """Flattened rows (with ``batch_ts``) of the window's folders; no other folder is listed or opened.

    ``read``: the document reader, ``bronze.read_documents`` or ``salvage.read_documents``.
    """
    parts = []
    if window.unread:
        docs = read(spark, [f.path for f in window.unread], for_silver=for_silver)
        parts.append(bronze.with_batch_ts(docs))
    if window.recent:
        docs = bronze.with_batch_ts(read(spark, [f.path for f in window.recent], for_silver=for_silver))
        parts.append(docs.filter(F.col("batch_ts") > F.lit(window.since.isoformat(sep=" ")).cast("timestamp_ntz")))
    if not parts:
        schema = schemas.SILVER_DOCUMENT if for_silver else schemas.BRONZE_DOCUMENT
        parts.append(spark.createDataFrame([], schema).withColumn("batch_ts", F.lit(None).cast("timestamp_ntz")))
    docs = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return bronze.flatten(docs)
