"""``quakes``: a seismic event catalogue derived from the driver's ``events``.

Every row of ``events`` becomes one Bronze-shaped revision: four
consecutive event ids share one quake id, events spread over 20 months,
some revisions move an event to another month, ``updated`` is null or tied
for some, coordinates differ past the sixth place, texts hold ``|``, values
land out of range on purpose, places take every shape the region parser
must handle. Only
integer and plain IEEE arithmetic is used, so DuckDB computes the same
rows (see ``tremor.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas
from .functions.casts import ts_to_epoch_ms


def quakes(events: DataFrame) -> DataFrame:
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    quake = F.floor(eid / 4)
    moved = F.when((eid % 4 == 3) & (quake % 5 == 0), 31).otherwise(0)
    event_ts = F.col("ts") + F.make_dt_interval((quake % 19 * 30 + moved).cast("int"))
    updated = (
        F.when(eid % 31 == 7, F.lit(None).cast("timestamp_ntz"))
        .when(quake % 7 == 0, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(event_ts + F.make_dt_interval(F.lit(0), (eid % 5).cast("int"), F.lit(0), F.lit(0)))
    )
    place = (
        F.when(uid % 11 == 0, F.lit(None).cast("string"))
        .when(uid % 7 == 0, F.concat(F.lit("Ridge "), (uid % 5).cast("string")))
        .when(
            uid % 17 == 0,
            F.concat(F.lit("a|b:"), (uid % 3).cast("string"), F.lit(", Land|"), (uid % 2).cast("string")),
        )
        .when(uid % 13 == 0, F.concat(F.lit("near X"), (uid % 3).cast("string"), F.lit(", ")))
        .otherwise(
            F.concat(
                uid.cast("string"),
                F.lit(" km N of Town"),
                (uid % 9).cast("string"),
                F.lit(", Prov"),
                (uid % 4).cast("string"),
                F.lit(", Land"),
                (uid % 6).cast("string"),
            )
        )
    )
    return events.select(
        F.concat(F.lit("q"), (eid - eid % 4).cast("string")).alias("id"),
        event_ts.alias("event_ts"),
        updated.alias("updated_ts"),
        eid.alias("revision"),
        F.when(eid % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("value") / 25.0 - 2.5).alias("magnitude"),
        (((eid * 37) % 1150).cast("double") - 50.0).alias("depth_km"),
        (((uid * 7) % 191).cast("double") - 95.0 + (eid % 4).cast("double") / 10000000.0).alias("latitude"),
        (((uid * 13) % 373).cast("double") - 186.0 + (uid % 7).cast("double") / 64.0).alias("longitude"),
        place.alias("place"),
        F.when(etype == "signup", "quarry blast").otherwise("earthquake").alias("event_type"),
        F.when(etype == "error", F.lit(None).cast("string"))
        .when(etype == "view", "ml")
        .when(etype == "click", "m|b")
        .otherwise("mb")
        .alias("mag_type"),
        F.when(eid % 10 == 3, F.lit(None).cast("int")).otherwise((eid % 2).cast("int")).alias("tsunami"),
        (eid % 1000).cast("int").alias("sig"),
        (uid % 50).cast("int").alias("felt"),
    )


def bronze_flat(q: DataFrame) -> DataFrame:
    """``quakes`` in the flattened-Bronze shape (epoch-ms times, API names).

    The properties the catalogue lacks are simple expressions of the
    revision number.
    """
    rev = F.col("revision")
    cols = {
        "id": F.col("id"),
        "mag": F.col("magnitude"),
        "place": F.col("place"),
        "time": ts_to_epoch_ms("event_ts"),
        "updated": ts_to_epoch_ms("updated_ts"),
        "url": F.concat(F.lit("http://x/"), F.col("id")),
        "felt": F.col("felt").cast("bigint"),
        "cdi": (rev % 10).cast("double"),
        "mmi": F.lit(None).cast("double"),
        "alert": F.when(rev % 5 == 0, "green"),
        "status": F.when(rev % 2 == 0, "reviewed").otherwise("automatic"),
        "tsunami": F.col("tsunami").cast("bigint"),
        "sig": F.col("sig").cast("bigint"),
        "net": F.lit("xx"),
        "code": rev.cast("string"),
        "nst": F.when(rev % 7 == 0, F.lit(None).cast("bigint")).otherwise(rev % 150),
        "dmin": F.lit(None).cast("double"),
        "rms": (rev % 100).cast("double") / 100.0,
        "gap": ((rev * 7) % 360).cast("double"),
        "magType": F.col("mag_type"),
        "type": F.col("event_type"),
        "title": F.concat(F.lit("Quake "), F.col("id")),
        "longitude": F.col("longitude"),
        "latitude": F.col("latitude"),
        "depth": F.col("depth_km"),
    }
    assert list(cols) == schemas.BRONZE_FLAT_COLUMNS
    return q.select(*[c.alias(n) for n, c in cols.items()])
