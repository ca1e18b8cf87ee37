"""Command-line jobs (``spark-submit -m``-style: ``python -m tremor <job> ...``).

The session comes from ``SparkSession.builder.getOrCreate()``, so a cluster's
submit-time configuration (master, shuffle partitions, checkpoint dir) is
used as given.

  bronze-to-silver  --bronze PATH --silver PATH [--merge]
  silver-to-gold    --silver PATH --gold PATH [--database NAME] [--dense-keys]
  run               --bronze PATH --root PATH [--database NAME] [--mode backfill|incremental]
                    [--dense-keys] [--rollups] [--keep-rejected] [--salvage]
                    (without --mode it follows from the run log and Silver; an incremental run reads the
                    folders that no run has read and the last 48 hours)
  stream            --bronze PATH --history PATH --checkpoint PATH [--stateful]
  retention         --silver PATH --as-of YYYY-MM-DD [--days N] [--bronze PATH] [--gold PATH]
                    [--database NAME] [--delete]
                    (lists expired partitions; removes them with --delete)
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import fixed
from .plans import jobs, runs
from .sinks import tables
from .sources import bronze as bronze_src
from .sources import salvage
from .streaming import incremental


def _flat(spark: SparkSession, path: str):
    docs = bronze_src.read_documents(spark, path, for_silver=True)
    return bronze_src.flatten(bronze_src.with_batch_ts(docs))


def _document_report(spark: SparkSession, path: str, salvaged: bool = False) -> dict:
    """Documents, unreadable ones, and features declared against features found, or those salvaged and lost."""
    if salvaged:
        return salvage.report(salvage.read_documents(spark, path, for_silver=True)).first().asDict()
    return bronze_src.document_counts(bronze_src.read_documents(spark, path, for_silver=True)).first().asDict()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="tremor")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("bronze-to-silver")
    a.add_argument("--bronze", required=True)
    a.add_argument("--silver", required=True)
    a.add_argument("--merge", action="store_true", help="upsert into existing Silver (dynamic overwrite)")
    b = sub.add_parser("silver-to-gold")
    b.add_argument("--silver", required=True)
    b.add_argument("--gold", required=True)
    b.add_argument("--database", default=fixed.GOLD_DATABASE)
    b.add_argument("--dense-keys", action="store_true", help="BIGINT keys from the key tables beside Gold")
    c = sub.add_parser("run")
    c.add_argument("--bronze", required=True)
    c.add_argument("--root", required=True)
    c.add_argument("--database", default=fixed.GOLD_DATABASE)
    c.add_argument("--check-documents", action="store_true", help="one more pass over Bronze: report unreadable documents")
    c.add_argument("--dense-keys", action="store_true", help="BIGINT keys from the key tables beside Gold")
    c.add_argument("--keep-rejected", action="store_true", help="rows that fail a quality rule go to ROOT/quarantine")
    c.add_argument("--salvage", action="store_true", help="load the intact features of broken documents")
    c.add_argument("--rollups", action="store_true", help="a backfill starts a log of roll-up deltas that merges keep current")
    c.add_argument("--mode", default=None, choices=["backfill", "incremental"])
    d = sub.add_parser("stream")
    d.add_argument("--bronze", required=True)
    d.add_argument("--history", required=True)
    d.add_argument("--checkpoint", required=True)
    d.add_argument("--stateful", action="store_true")
    d.add_argument("--compact-into", default=None, help="also keep a compacted Silver table at this path")
    d.add_argument("--max-files-per-trigger", type=int, default=incremental.MAX_FILES_PER_TRIGGER, help="bound each micro-batch")
    e = sub.add_parser("retention")
    e.add_argument("--silver", required=True)
    e.add_argument("--as-of", required=True)
    e.add_argument("--days", type=int, default=fixed.RETENTION_DAYS["silver"])
    e.add_argument("--bronze", default=None, help="also expire landed hours by the Bronze retention")
    e.add_argument("--gold", default=None, help="also expire fact rows by the Gold retention")
    e.add_argument("--database", default=fixed.GOLD_DATABASE)
    e.add_argument("--delete", action="store_true", help="remove expired partitions (default: list them)")
    args = p.parse_args(argv)

    spark = spark or SparkSession.builder.getOrCreate()
    if args.job == "bronze-to-silver":
        flat = _flat(spark, args.bronze)
        if args.merge and tables.path_has_table(spark, args.silver):
            result = jobs.merge_silver(spark, flat, args.silver)
        else:
            result = jobs.run_silver(flat, args.silver)
    elif args.job == "silver-to-gold":
        result = jobs.run_gold(spark, args.silver, args.gold, args.database, dense_keys=args.dense_keys)
    elif args.job == "run":
        result = jobs.run_landed(spark, args.bronze, args.root, args.database, mode=args.mode, dense_keys=args.dense_keys,
                                 rollups=args.rollups, keep_rejected=args.keep_rejected, salvaged=args.salvage)
        if args.check_documents:
            result["documents"] = _document_report(spark, args.bronze, args.salvage)
    elif args.job == "stream":
        if args.stateful:
            incremental.append_history_stateful(spark, args.bronze, args.history, args.checkpoint)
        else:
            incremental.append_history(spark, args.bronze, args.history, args.checkpoint,
                                       max_files_per_trigger=args.max_files_per_trigger)
        if args.compact_into:
            incremental.compact_silver(spark, args.bronze, args.compact_into, f"{args.checkpoint}_compacted",
                                       args.max_files_per_trigger)
        result = {"status": "succeeded"}
        if not args.stateful:
            result["late_rows"] = incremental.late_rows(spark, args.history)
    else:
        silver = tables.read_silver(spark, args.silver)
        as_of = F.to_timestamp_ntz(F.lit(args.as_of))
        row = runs.retention_summary(silver, "event_timestamp_utc", as_of, {"silver": args.days}).first()
        result = {"status": "succeeded", "rows_kept": row.rows_kept, "rows_to_expire": row.rows_expired}
        day = dt.datetime.fromisoformat(args.as_of)
        result["silver_partitions"] = runs.expire(spark, args.silver, "silver", day, args.days, not args.delete)
        if args.bronze:
            result["bronze_folders"] = runs.expire(spark, args.bronze, "bronze", day, None, not args.delete)
        if args.gold:
            result["gold"] = runs.expire_gold(spark, args.gold, args.database, day, None, not args.delete)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
