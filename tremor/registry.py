"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (or data
Spark derives from them) and returns a DataFrame whose columns carry the
same names as the oracle's. Columns holding the wall clock of a run are
left out of query results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed, fixtures, oracle, schemas
from .functions import casts, features, keys
from .operators import dedup, delta_rollups, dense_keys, dims, fact, integrity, month_index, quality, quarantine, rollups
from .plans import jobs, runs, staging
from .plans import silver as silver_plan
from .session import dataset_tag, scratch_dir, table
from .sinks import tables as sink_tables
from .sources import bronze, ledger, salvage
from .streaming import incremental


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}

GOLD_DATABASE = fixed.GOLD_DATABASE


def register(name: str, oracle_sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir)

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(build, oracle_sql)
        return build

    return deco


# --------------------------------------------------------------------------- inputs


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.quakes(table(spark, sf_dir, "events"))


def bronze_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_flat(quakes(spark, sf_dir))


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_plan.select_typed(bronze_flat(spark, sf_dir))


def silver_rows(spark: SparkSession, sf_dir: str, with_clock: bool = False) -> DataFrame:
    return silver_plan.silver(bronze_flat(spark, sf_dir), with_clock=with_clock)


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The written Gold tables (built once per application from the written Silver).

    Roll-ups and checks are queries over the star, so they scan these tables
    (column-pruned) rather than re-deriving Silver inside their own plans,
    where the fact and each dimension would each recompute the dedup shuffle.
    """
    root = staging.written_gold(spark, sf_dir, GOLD_DATABASE)
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in ("dim_date", "dim_location", "dim_magnitude", "dim_event_type")}
    tables["fact"] = spark.read.parquet(f"{root}/fact_earthquake_events")
    return tables


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink_tables.read_silver(spark, staging.written_silver(spark, sf_dir))


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in schemas.CLOCK_COLUMNS])


SILVER_SELECT = ", ".join(schemas.SILVER_SELECTED_COLUMNS)

# --------------------------------------------------------------------------- casts


@register(
    "epoch_to_ts",
    "select event_id, epoch_us(ts) // 1000 as time_ms, epoch_ms(epoch_us(ts) // 1000) as event_timestamp_utc from events",
)
def q_epoch_to_ts(spark, sf):
    """CST1-2: timestamp -> epoch ms -> timestamp (millisecond precision)."""
    ev = table(spark, sf, "events")
    ms = casts.ts_to_epoch_ms("ts")
    return ev.select("event_id", ms.alias("time_ms"), casts.epoch_ms_to_ts(ms).alias("event_timestamp_utc"))


@register(
    "date_key",
    "select event_id, cast(strftime(ts, '%Y%m%d') as integer) as DateKey from events",
)
def q_date_key(spark, sf):
    """CST6: timestamp -> INT yyyyMMdd."""
    return table(spark, sf, "events").select("event_id", casts.date_key("ts").alias("DateKey"))


@register(
    "silver_casts",
    oracle.sql(
        "select event_id, magnitude, depth_km, tsunami_warning, significance, felt_reports, nst_stations, "
        "rms_travel_time, gap_azimuthal from selected",
        "selected",
    ),
)
def q_silver_casts(spark, sf):
    """CST3-5: try_cast to double/int, flag to boolean."""
    return selected(spark, sf).select(
        "event_id", "magnitude", "depth_km", "tsunami_warning", "significance", "felt_reports",
        "nst_stations", "rms_travel_time", "gap_azimuthal",
    )


@register("silver_select", oracle.sql(f"select {SILVER_SELECT} from selected", "selected"))
def q_silver_select(spark, sf):
    """PRJ4: rename/reorder to the 20 Silver columns."""
    return selected(spark, sf)


# --------------------------------------------------------------------------- data quality and dedup


@register("dq_valid", oracle.sql(f"select {SILVER_SELECT} from valid", "valid"))
def q_dq_valid(spark, sf):
    """FLT1-5: the AND-ed validity gate."""
    return quality.valid(selected(spark, sf))


def _reject_sql() -> str:
    preds = oracle.RULE_PREDICATES
    cols = ["cast(count(*) as bigint) as input_rows"]
    for name, p in preds.items():
        cols.append(f"cast(count(*) filter (where not coalesce({p}, false)) as bigint) as rejected_{name}")
    allp = oracle.VALID_PREDICATE
    cols.append(f"cast(count(*) filter (where not coalesce({allp}, false)) as bigint) as rejected_rows")
    cols.append(f"cast(count(*) filter (where coalesce({allp}, false)) as bigint) as valid_rows")
    return oracle.sql("select " + ",\n  ".join(cols) + " from selected", "selected")


@register("dq_reject_counts", _reject_sql())
def q_dq_reject_counts(spark, sf):
    """FLT7: rows failing each rule, in one aggregate pass."""
    return quality.reject_counts(selected(spark, sf))


MASK_SQL = " + ".join(
    f"case when coalesce({p}, false) then 0 else {1 << k} end" for k, p in enumerate(oracle.RULE_PREDICATES.values())
)


_DAMAGED = "nst is not null and nst % 5 = 0"


@register(
    "salvage_rows",
    oracle.sql(f"select {', '.join(schemas.BRONZE_FLAT_COLUMNS)} from bronze where not ({_DAMAGED})", "bronze"),
)
def q_salvage_rows(spark, sf):
    """SRC1: the intact features of broken documents (all lack their end, some features are damaged inside)."""
    return bronze.flatten(salvage.read_documents(spark, staging.damaged_bronze(spark, sf)))


@register(
    "salvage_report",
    oracle.sql(
        f"select count(*) filter (where not ({_DAMAGED})) as salvaged_features, count(*) filter (where {_DAMAGED}) as lost_features, "
        "cast(0 as bigint) as unbroken_documents from bronze",
        "bronze",
    ),
)
def q_salvage_report(spark, sf):
    """SRC1: features salvaged from broken documents and features lost."""
    r = salvage.report(salvage.read_documents(spark, staging.damaged_bronze(spark, sf)))
    return r.select("salvaged_features", "lost_features", (F.col("documents") - F.col("broken_documents")).alias("unbroken_documents"))


@register(
    "quarantine_rows",
    oracle.sql(
        "select event_id, event_timestamp_utc, magnitude, depth_km, latitude, longitude, cast(m as bigint) as failed_rules, "
        + "array_to_string(["
        + ", ".join(f"case when m & {1 << k} > 0 then '{n}' end" for k, n in enumerate(oracle.RULE_PREDICATES))
        + f"], ',') as failed_names from (select *, {MASK_SQL} as m from selected) where m > 0",
        "selected",
    ),
)
def q_quarantine_rows(spark, sf):
    """FLT7: the rejected rows as the quarantine keeps them, with the rules that each fails."""
    schema = quarantine.lane_schema(bronze_flat(spark, sf))
    rows = quarantine.read_lane(spark, staging.quarantined(spark, sf), quarantine.REJECTED, schema)
    return silver_plan.select_typed(rows, keep=(quarantine.MASK,)).select(
        "event_id", "event_timestamp_utc", "magnitude", "depth_km", "latitude", "longitude", quarantine.MASK,
        F.array_join(quarantine.rule_names(quarantine.MASK), ",").alias("failed_names"),
    )


def _balance_sql() -> str:
    rules = [(n, p) for n, p in oracle.RULE_PREDICATES.items()] + [("all", oracle.VALID_PREDICATE)]
    return oracle.sql(
        "\nunion all\n".join(
            f"select '{n}' as rule, cast(count(*) filter (where coalesce({p}, false)) as bigint) as valid_rows, "
            f"cast(count(*) filter (where not coalesce({p}, false)) as bigint) as quarantined_rows, "
            "cast(count(*) as bigint) as input_rows from selected"
            for n, p in rules
        ),
        "selected",
    )


@register("quarantine_balance", _balance_sql())
def q_quarantine_balance(spark, sf):
    """FLT7: valid and quarantined rows per rule, from the two written lanes."""
    folder, schema = staging.quarantined(spark, sf), quarantine.lane_schema(bronze_flat(spark, sf))
    lanes = [quarantine.read_lane(spark, folder, lane, schema) for lane in (quarantine.VALID, quarantine.REJECTED)]
    return quarantine.balance(lanes[0].unionByName(lanes[1]))


@register("dedup_latest", oracle.sql(f"select {SILVER_SELECT} from latest", "latest"))
def q_dedup_latest(spark, sf):
    """WIN1/FLT6/PRJ6: latest valid revision per event id."""
    return silver_plan.latest(quality.valid(selected(spark, sf)))


LINEITEM_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@register(
    "dedup_lineitem",
    "select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by "
    + ", ".join(f"{c} desc nulls last" for c in LINEITEM_ORDER)
    + ") as rn from lineitem) where rn = 1",
)
def q_dedup_lineitem(spark, sf):
    """WIN1 on a key with real duplicates: newest ship date, every column as tiebreak."""
    li = table(spark, sf, "lineitem")
    return dedup.latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col(c).desc_nulls_last() for c in LINEITEM_ORDER])


# --------------------------------------------------------------------------- scalar features


@register(
    "magnitude_category",
    oracle.sql(f"select event_id, magnitude, {oracle.MAGNITUDE_CASE} as magnitude_category from selected", "selected"),
)
def q_magnitude_category(spark, sf):
    """SCL1 (a null magnitude falls through to the top class, as in the reference)."""
    return selected(spark, sf).select("event_id", "magnitude", features.magnitude_category().alias("magnitude_category"))


@register(
    "depth_category",
    oracle.sql(f"select event_id, depth_km, {oracle.DEPTH_CASE} as depth_category from selected", "selected"),
)
def q_depth_category(spark, sf):
    """SCL2: inclusive depth bounds."""
    return selected(spark, sf).select("event_id", "depth_km", features.depth_category().alias("depth_category"))


@register(
    "hemispheres",
    oracle.sql(
        "select event_id, latitude, longitude, "
        f"{oracle.HEMISPHERE_NS_CASE} as hemisphere_ns, {oracle.HEMISPHERE_EW_CASE} as hemisphere_ew from selected",
        "selected",
    ),
)
def q_hemispheres(spark, sf):
    """SCL3-4."""
    return selected(spark, sf).select(
        "event_id", "latitude", "longitude",
        features.hemisphere_ns().alias("hemisphere_ns"), features.hemisphere_ew().alias("hemisphere_ew"),
    )


@register(
    "calendar_parts",
    oracle.sql(
        "select event_id, event_timestamp_utc, cast(year(event_timestamp_utc) as integer) as year, "
        "cast(month(event_timestamp_utc) as integer) as month, cast(day(event_timestamp_utc) as integer) as day, "
        "cast(hour(event_timestamp_utc) as integer) as hour, "
        "cast(dayofweek(event_timestamp_utc) + 1 as integer) as day_of_week from selected",
        "selected",
    ),
)
def q_calendar_parts(spark, sf):
    """SCL5-9: UTC calendar parts, Sunday = 1."""
    s = selected(spark, sf)
    parts = features.calendar_parts("event_timestamp_utc")
    return s.select("event_id", "event_timestamp_utc", *[c.alias(n) for n, c in parts.items()])


@register(
    "place_region",
    oracle.sql(
        f"select event_id, place, {oracle.DETAIL_SQL} as extracted_region_detail, "
        f"case when {oracle.DETAIL_SQL} <> '' then {oracle.DETAIL_SQL} else trim(place) end as extracted_country "
        "from selected",
        "selected",
    ),
)
def q_place_region(spark, sf):
    """SCL10-11: region detail after the first comma, country with fallback."""
    s = selected(spark, sf).select("event_id", "place", features.region_detail().alias("extracted_region_detail"))
    return s.withColumn("extracted_country", features.country("extracted_region_detail"))


@register(
    "silver_features",
    oracle.sql(f"select {SILVER_SELECT}, {oracle.FEATURES_SQL} from valid", "valid"),
)
def q_silver_features(spark, sf):
    """PRJ5: every enrichment column in one projection (on all valid revisions)."""
    return silver_plan.enrich(quality.valid(selected(spark, sf)), with_clock=False)


@register("silver_events", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_silver_events(spark, sf):
    """RUN1: the whole Bronze -> Silver plan (processing-time column left out)."""
    return silver_rows(spark, sf)


# --------------------------------------------------------------------------- gold


@register("date_span", oracle.sql("select min_date, max_date from span", "span"))
def q_date_span(spark, sf):
    """AGG1: first and last event day."""
    return dims.date_span(silver_rows(spark, sf))


@register("dim_date", oracle.sql("select * from dim_date", "dim_date"))
def q_dim_date(spark, sf):
    """SRC3/SCL13-19: calendar generated inside the plan."""
    return dims.dim_date(silver_rows(spark, sf))


@register("dim_location", oracle.sql("select * from dim_location", "dim_location"))
def q_dim_location(spark, sf):
    """AGG2/PRJ7/KEY1."""
    return dims.dim_location(silver_rows(spark, sf))


@register("dim_event_type", oracle.sql("select * from dim_event_type", "dim_event_type"))
def q_dim_event_type(spark, sf):
    """AGG3/PRJ7/KEY1."""
    return dims.dim_event_type(silver_rows(spark, sf))


@register(
    "dim_magnitude",
    oracle.sql(
        "select m.*, cast(coalesce(c.n, 0) as bigint) as silver_events from dim_magnitude m "
        "left join (select magnitude_category, count(*) as n from silver group by 1) c "
        "on m.MagnitudeCategory = c.magnitude_category",
        "dim_magnitude",
        "silver",
    ),
)
def q_dim_magnitude(spark, sf):
    """SRC4: the eight fixed magnitude classes with their Silver event counts (Unknown never matches)."""
    per_class = silver_rows(spark, sf).groupBy("magnitude_category").agg(F.count(F.lit(1)).alias("n"))
    dm = dims.dim_magnitude(spark)
    joined = dm.join(per_class, dm["MagnitudeCategory"] == per_class["magnitude_category"], "left")
    return joined.select(*[dm[c] for c in dm.columns], F.coalesce(F.col("n"), F.lit(0)).alias("silver_events"))


@register(
    "surrogate_key",
    oracle.sql(
        f"select event_id, {oracle.loc_key_sql()} as LocationKey, {oracle.type_key_sql()} as EventTypeKey, "
        f"{oracle.mag_key_sql('magnitude_category')} as MagnitudeKey from silver",
        "silver",
    ),
)
def q_surrogate_key(spark, sf):
    """KEY1: layout-independent hash keys of each Silver row's natural keys."""
    return silver_rows(spark, sf).select(
        "event_id",
        keys.location_key().alias("LocationKey"),
        keys.event_type_key().alias("EventTypeKey"),
        keys.magnitude_key("magnitude_category").alias("MagnitudeKey"),
    )


DENSE_NATURALS = f"""
select 'dim_location' as dimension, {oracle.loc_key_sql()} as "natural", min((year * 12 + month) % {staging.KEY_RUNS}) as run from silver group by 2
union all
select 'dim_event_type', {oracle.type_key_sql()}, min((year * 12 + month) % {staging.KEY_RUNS}) from silver group by 2
union all
select 'dim_magnitude', MagnitudeKey, 0 from dim_magnitude
"""
DENSE_KEYS = f'select dimension, "natural", row_number() over (partition by dimension order by run, "natural") - 1 as key from ({DENSE_NATURALS})'


@register("dense_keys", oracle.sql(DENSE_KEYS, "silver", "dim_magnitude"))
def q_dense_keys(spark, sf):
    """KEY1: BIGINT keys of an append-only key table after three runs (numbered by run, then digest; never changed)."""
    root = staging.dense_keys_of_three_runs(spark, sf)
    parts = [
        dense_keys.read_keys(spark, f"{root}/{name}").select(F.lit(name).alias("dimension"), "natural", "key")
        for name in dense_keys.DENSE_DIMENSIONS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _dense_fact_sql() -> str:
    columns, joins = oracle.FACT_OUT, ""
    for name, column in dense_keys.DENSE_DIMENSIONS.items():
        columns = columns.replace(column, f"{name}_k.key as {column}")
        joins += f" join ({DENSE_KEYS}) {name}_k on {name}_k.dimension = '{name}' and {name}_k.\"natural\" = f.{column}"
    return oracle.sql(f"select {columns} from fact f{joins}", "fact", "silver", "dim_magnitude")


@register("fact_events_dense", _dense_fact_sql())
def q_fact_events_dense(spark, sf):
    """KEY1/JON1-4: the fact with BIGINT foreign keys looked up in the key tables."""
    root = staging.dense_keys_of_three_runs(spark, sf)
    out = fact.fact_events(written_silver(spark, sf), with_clock=False)
    for name, column in dense_keys.DENSE_DIMENSIONS.items():
        out = dense_keys.replace(out, column, dense_keys.read_keys(spark, f"{root}/{name}"))
    return out


@register("fact_events", oracle.sql(f"select {oracle.FACT_OUT} from fact", "fact"))
def q_fact_events(spark, sf):
    """RUN2/JON1-4/AGG4/PRJ8: fact with hash-derived keys, inner-lookup row loss."""
    return fact.fact_events(silver_rows(spark, sf), with_clock=False)


@register("fact_events_nullsafe", oracle.sql(f"select {oracle.FACT_OUT} from fact_nullsafe", "fact_nullsafe"))
def q_fact_events_nullsafe(spark, sf):
    """JON2/JON4 null-safe variant: no row lost."""
    return fact.fact_events(silver_rows(spark, sf), null_safe=True, with_clock=False)


@register("fact_events_joined", oracle.sql(f"select {oracle.FACT_OUT} from fact", "fact"))
def q_fact_events_joined(spark, sf):
    """JON1-4 as literal inner equi-joins of the written Silver against its dimensions."""
    s = written_silver(spark, sf)
    return fact.fact_events_joined(s, dims.all_dims(s), with_clock=False)


def _integrity_sql() -> str:
    rows = []
    for dim_name, key in integrity.FOREIGN_KEYS:
        rows.append(
            f"select 'fact_{key}_orphans' as \"check\", cast(count(*) as bigint) as violations "
            f"from fact f where not exists (select 1 from {dim_name} d where d.{key} = f.{key})"
        )
    for dim_name, key in integrity.FOREIGN_KEYS:
        rows.append(
            f"select '{dim_name}_duplicate_{key}', cast(coalesce(sum(n - 1), 0) as bigint) "
            f"from (select {key}, count(*) as n from {dim_name} group by {key})"
        )
    rows.append(
        "select 'fact_duplicate_EventID', cast(coalesce(sum(n - 1), 0) as bigint) "
        "from (select EventID, count(*) as n from fact group by EventID)"
    )
    return oracle.sql("\nunion all\n".join(rows), "fact")


@register("star_integrity", _integrity_sql())
def q_star_integrity(spark, sf):
    """KEY2: orphans, duplicate dimension keys, duplicate event ids (all 0)."""
    t = gold_tables(spark, sf)
    return integrity.star_integrity(t["fact"], t)


def _rollup_sql(group_cols: str, join: str) -> str:
    return oracle.sql(
        f"select {group_cols}, {oracle.ROLLUP_MEASURES} from fact f {join} group by {group_cols}",
        "fact",
    )


@register(
    "gold_by_region",
    _rollup_sql("l.extracted_country", "join dim_location l on f.LocationKey = l.LocationKey").replace(
        "select l.extracted_country,", "select l.extracted_country as extracted_country,"
    ),
)
def q_gold_by_region(spark, sf):
    """AGG6: events per country/region."""
    t = gold_tables(spark, sf)
    return rollups.by_region(t["fact"], t["dim_location"])


@register(
    "gold_by_magnitude",
    _rollup_sql(
        "m.MagnitudeCategory, m.MinMagnitude, m.MaxMagnitude", "join dim_magnitude m on f.MagnitudeKey = m.MagnitudeKey"
    ),
)
def q_gold_by_magnitude(spark, sf):
    """AGG6: events per magnitude class."""
    t = gold_tables(spark, sf)
    return rollups.by_magnitude(t["fact"], t["dim_magnitude"])


@register("gold_by_month", _rollup_sql("d.Year, d.Month", "join dim_date d on f.DateKey = d.DateKey"))
def q_gold_by_month(spark, sf):
    """AGG6: events per calendar month."""
    t = gold_tables(spark, sf)
    return rollups.by_month(t["fact"], t["dim_date"])


@register("gold_by_weekday", _rollup_sql("d.DayOfWeek, d.IsWeekend", "join dim_date d on f.DateKey = d.DateKey"))
def q_gold_by_weekday(spark, sf):
    """AGG6: events per weekday."""
    t = gold_tables(spark, sf)
    return rollups.by_weekday(t["fact"], t["dim_date"])


def _rollup_log(spark, sf):
    return delta_rollups.read_log(spark, staging.rolled_up(spark, sf))


@register("rollup_delta_region", REGISTRY["gold_by_region"].oracle)
def q_rollup_delta_region(spark, sf):
    """AGG6 incremental: events per country after three merges, from signed deltas."""
    return delta_rollups.by_region(_rollup_log(spark, sf))


@register("rollup_delta_magnitude", REGISTRY["gold_by_magnitude"].oracle)
def q_rollup_delta_magnitude(spark, sf):
    """AGG6 incremental: events per magnitude class."""
    return delta_rollups.by_magnitude(_rollup_log(spark, sf))


@register("rollup_delta_month", REGISTRY["gold_by_month"].oracle)
def q_rollup_delta_month(spark, sf):
    """AGG6 incremental: events per calendar month."""
    return delta_rollups.by_month(_rollup_log(spark, sf))


@register("rollup_delta_weekday", REGISTRY["gold_by_weekday"].oracle)
def q_rollup_delta_weekday(spark, sf):
    """AGG6 incremental: events per weekday."""
    return delta_rollups.by_weekday(_rollup_log(spark, sf))


# --------------------------------------------------------------------------- run-level


@register(
    "empty_noop",
    oracle.sql(
        "select 'all' as batch, case when count(*) = 0 then 'skipped' else 'processed' end as status, "
        "cast(count(*) as bigint) as records from quakes\n"
        "union all\n"
        "select 'after_latest', case when count(*) = 0 then 'skipped' else 'processed' end, cast(count(*) as bigint) "
        "from quakes where event_ts > (select max(event_ts) from quakes)",
        "quakes",
    ),
)
def q_empty_noop(spark, sf):
    """SRC5/RUN3: the zero-record gate on a full batch and on an empty one."""
    q = quakes(spark, sf)
    empty = q.filter(F.col("event_ts") > runs.as_of_latest(q, "event_ts"))
    return runs.gate(q, "all").unionByName(runs.gate(empty, "after_latest"))


def _retention_sql() -> str:
    parts = []
    for layer, days in runs.RETENTION_DAYS.items():
        parts.append(
            f"select '{layer}' as layer, {days} as retention_days, "
            f"cast(count(*) filter (where o_orderdate >= a.as_of - to_days({days})) as bigint) as rows_kept, "
            f"cast(count(*) filter (where o_orderdate < a.as_of - to_days({days})) as bigint) as rows_expired "
            "from orders, (select max(o_orderdate) as as_of from orders) a"
        )
    return "\nunion all\n".join(parts)


@register("retention", _retention_sql())
def q_retention(spark, sf):
    """RUN5: rows kept/expired per layer at as-of = newest order date."""
    orders = table(spark, sf, "orders")
    return runs.retention_summary(orders, "o_orderdate", runs.as_of_latest(orders, "o_orderdate"))


# --------------------------------------------------------------------------- bronze documents


def _landed_flat(spark, sf, with_batch_ts=True):
    docs = bronze.read_documents(spark, staging.landed_bronze(spark, sf))
    if with_batch_ts:
        docs = bronze.with_batch_ts(docs)
    return bronze.flatten(docs)


BRONZE_OUT = ", ".join(schemas.BRONZE_FLAT_COLUMNS)


@register("bronze_flatten", oracle.sql(f"select {BRONZE_OUT} from bronze", "bronze"))
def q_bronze_flatten(spark, sf):
    """SRC1/PRJ1-3/SNK4: catalogue -> GeoJSON documents on disk -> declared-schema scan -> flatten."""
    return _landed_flat(spark, sf, with_batch_ts=False)


@register(
    "geojson_nest",
    oracle.sql(
        "select cast(date_trunc('hour', epoch_ms(time)) as date) as batch_day, cast(count(*) as bigint) as features, "
        "cast(count(*) as bigint) as declared_features from bronze group by 1",
        "bronze",
    ),
)
def q_geojson_nest(spark, sf):
    """SNK4: landed documents per day, features counted two ways (array size, metadata.count)."""
    docs = bronze.with_batch_ts(bronze.read_documents(spark, staging.landed_bronze(spark, sf)))
    return docs.groupBy(F.to_date("batch_ts").alias("batch_day")).agg(
        F.sum(F.size("features")).cast("bigint").alias("features"),
        F.sum("metadata.count").cast("bigint").alias("declared_features"),
    )


@register(
    "landing_two_hours",
    oracle.sql(
        "select timestamp '{0}' as batch_ts, cast(count(*) as bigint) as features, cast(count(*) as bigint) as declared_features "
        "from bronze, (select date_trunc('day', min(epoch_ms(time))) + to_days({2}) as cut from bronze) "
        "where epoch_ms(time) < cut and cast(code as bigint) % 11 <> 5\n"
        "union all\n"
        "select timestamp '{1}', cast(count(*) as bigint), cast(count(*) as bigint) "
        "from bronze, (select date_trunc('day', min(epoch_ms(time))) + to_days({2}) as cut from bronze) "
        "where epoch_ms(time) >= cut - to_hours({3}) or cast(code as bigint) % 11 = 5 or cast(code as bigint) % 13 = 0".format(
            *staging.LATE_HOURS, staging.OVERLAP_DAYS, fixed.INCREMENTAL_HOURS
        ),
        "bronze",
    ),
)
def q_landing_two_hours(spark, sf):
    """SNK4: two hours landed one after the other in one folder; the first is still there."""
    docs = bronze.with_batch_ts(bronze.read_documents(spark, staging.late(spark, sf)["landing"]))
    return docs.groupBy("batch_ts").agg(
        F.sum(F.size("features")).cast("bigint").alias("features"),
        F.sum("metadata.count").cast("bigint").alias("declared_features"),
    )


@register(
    "batch_ts_from_path",
    oracle.sql(
        "select date_trunc('hour', epoch_ms(time)) as batch_ts, cast(count(*) as bigint) as features "
        "from bronze group by 1",
        "bronze",
    ),
)
def q_batch_ts_from_path(spark, sf):
    """SRC6: landing hour recovered from each file's path."""
    docs = bronze.with_batch_ts(bronze.read_documents(spark, staging.landed_by_hour(spark, sf)))
    return bronze.flatten(docs).groupBy("batch_ts").agg(F.count(F.lit(1)).alias("features"))


@register(
    "batch_ts_packed",
    oracle.sql(
        "select date_trunc('hour', epoch_ms(time)) as batch_ts, cast(count(*) as bigint) as features "
        "from bronze group by 1",
        "bronze",
    ),
)
def q_batch_ts_packed(spark, sf):
    """SRC6/SNK4: landing hour of documents in files that hold many hours."""
    return _landed_flat(spark, sf).groupBy("batch_ts").agg(F.count(F.lit(1)).alias("features"))


@register(
    "incremental_bronze",
    oracle.sql(
        f"select {BRONZE_OUT}, date_trunc('hour', epoch_ms(time)) as batch_ts from bronze "
        f"where time // 3600000 % {staging.LATE_MODULUS} = {staging.LATE_REMAINDER} "
        "or date_trunc('hour', epoch_ms(time)) > (select max(date_trunc('hour', epoch_ms(time))) from bronze) "
        f"- to_hours({fixed.INCREMENTAL_HOURS})",
        "bronze",
    ),
)
def q_incremental_bronze(spark, sf):
    """SRC8/SRC6: what an incremental run reads: hours that no run has read, and the last 48 hours."""
    lake = staging.landed_twice(spark, sf)
    return ledger.read_window(spark, ledger.pending(spark, lake["landing"], lake["ledger"]))


@register("incremental_run", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_incremental_run(spark, sf):
    """SRC8/RUN1/SNK1: Silver after a backfill run and an incremental run that read only unseen hours."""
    s = sink_tables.read_silver(spark, f"{staging.caught_up(spark, sf)}/silver/earthquakes_cleaned")
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


PAGE_SIZE = 20


def _pages_sql() -> str:
    order = "event_timestamp_utc desc, event_id asc, updated_timestamp_utc desc nulls last, " + ", ".join(
        f"{c} asc nulls last" for c in schemas.SILVER_SELECTED_COLUMNS
        if c not in ("event_timestamp_utc", "event_id", "updated_timestamp_utc")
    )
    return oracle.sql(
        f"select {SILVER_SELECT}, r // {PAGE_SIZE} as page, r % {PAGE_SIZE} as page_row from ("
        f"select *, row_number() over (order by {order}) - 1 as r from selected "
        f"where event_timestamp_utc between (select max(event_timestamp_utc) from selected) - to_days({fixed.BACKFILL_DAYS}) "
        f"and (select max(event_timestamp_utc) from selected) and magnitude >= {fixed.MIN_MAGNITUDE})",
        "selected",
    )


@register("extract_pages", _pages_sql())
def q_extract_pages(spark, sf):
    """SRC7: every row of the request window in pages of 20, newest first."""
    rows = selected(spark, sf)
    end = runs.as_of_latest(rows, "event_timestamp_utc")
    start = end - F.make_dt_interval(F.lit(bronze.BACKFILL_DAYS))
    return bronze.extract_pages(rows, start, end, page_size=PAGE_SIZE)


@register(
    "bounded_extract",
    oracle.sql(
        f"select {SILVER_SELECT} from selected "
        f"where event_timestamp_utc between (select max(event_timestamp_utc) from selected) - to_days({fixed.BACKFILL_DAYS}) "
        f"and (select max(event_timestamp_utc) from selected) and magnitude >= {fixed.MIN_MAGNITUDE} "
        "order by event_timestamp_utc desc, event_id asc, updated_timestamp_utc desc nulls last, "
        + ", ".join(f"{c} asc nulls last" for c in schemas.SILVER_SELECTED_COLUMNS
                    if c not in ("event_timestamp_utc", "event_id", "updated_timestamp_utc"))
        + f" limit {fixed.MAX_FEATURES_PER_DOCUMENT}",
        "selected",
    ),
)
def q_bounded_extract(spark, sf):
    """SRC7: one request page - [as_of - 365 d, as_of], magnitude >= 2.5, newest first, at most 20,000."""
    rows = selected(spark, sf)
    end = runs.as_of_latest(rows, "event_timestamp_utc")
    start = end - F.make_dt_interval(F.lit(bronze.BACKFILL_DAYS))
    return bronze.bounded_extract(rows, start, end)


@register(
    "incremental_window",
    oracle.sql(
        f"select {SILVER_SELECT}, case when exists (select 1 from silver) then 'incremental' else 'backfill' end as mode "
        "from selected where event_timestamp_utc >= (select max(event_timestamp_utc) from selected) - "
        f"case when exists (select 1 from silver) then to_hours({fixed.INCREMENTAL_HOURS}) "
        f"else to_days({fixed.BACKFILL_DAYS}) end",
        "selected",
        "silver",
    ),
)
def q_incremental_window(spark, sf):
    """SRC8: extract mode from table state (Silver has rows -> 48 h look-back, else 365 d backfill)."""
    rows = selected(spark, sf)
    has_rows = written_silver(spark, sf).exists()  # table state: the Silver table has a row
    as_of = runs.as_of_latest(rows, "event_timestamp_utc")
    return rows.filter(F.col("event_timestamp_utc") >= bronze.window_start(as_of, has_rows)).withColumn(
        "mode", bronze.window_mode(has_rows)
    )


# --------------------------------------------------------------------------- written tables


@register("silver_write_roundtrip", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_silver_write_roundtrip(spark, sf):
    """SNK1: Silver written partitioned by year/month, read back whole."""
    s = sink_tables.read_silver(spark, staging.written_silver(spark, sf))
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register("silver_scan", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_silver_scan(spark, sf):
    """SRC2: the whole Silver table, declared schema."""
    s = sink_tables.read_silver(spark, staging.written_silver(spark, sf))
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register(
    "silver_newest_month",
    oracle.sql(
        f"select {oracle.SILVER_OUT} from silver where year * 100 + month = "
        "(select max(year * 100 + month) from silver)",
        "silver",
    ),
)
def q_silver_newest_month(spark, sf):
    """SRC2 pruned: Silver scan of the newest month (partition filter on year/month)."""
    s = sink_tables.read_silver(spark, staging.written_silver(spark, sf))
    newest = s.agg(F.max(F.col("year") * 100 + F.col("month"))).scalar()
    s = s.filter((F.col("year") == (newest / 100).cast("int")) & (F.col("month") == (newest % 100).cast("int")))
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register(
    "silver_expired",
    oracle.sql(
        f"select {oracle.SILVER_OUT} from silver where last_day(event_timestamp_utc) + to_days(1) > "
        f"(select max(event_timestamp_utc) from silver) - to_days({staging.EXPIRE_DAYS})",
        "silver",
    ),
)
def q_silver_expired(spark, sf):
    """RUN5: Silver after months whose every possible row is older than the retention were removed."""
    s = sink_tables.read_silver(spark, staging.expired_silver(spark, sf))
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register("run_incremental", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_run_incremental(spark, sf):
    """RUN1/SRC8/SNK1: a backfill run, then a late, correcting run whose mode (merge) follows from the run log."""
    s = sink_tables.read_silver(spark, f"{staging.late(spark, sf)['lake']}/silver/earthquakes_cleaned")
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register("silver_incremental_merge", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_silver_incremental_merge(spark, sf):
    """SNK1 incremental: Silver of the first fetch, second fetch merged by dynamic partition overwrite."""
    s = sink_tables.read_silver(spark, staging.merged_silver(spark, sf))
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register(
    "merge_month_search",
    oracle.sql(
        "select distinct cast(year as integer) as year, cast(month as integer) as month from silver where event_id in "
        "(select event_id from selected where event_timestamp_utc > (select max(event_timestamp_utc) from selected) "
        f"- to_hours({fixed.INCREMENTAL_HOURS}))",
        "silver",
        "selected",
    ),
)
def q_merge_month_search(spark, sf):
    """SNK1: the months in which the events of the last 48 hours live, asked of the key-to-month index."""
    path = staging.indexed_silver(spark, sf)
    rows = selected(spark, sf)
    newest = runs.as_of_latest(rows, "event_timestamp_utc")
    ids = rows.filter(F.col("event_timestamp_utc") > newest - F.make_dt_interval(F.lit(0), F.lit(fixed.INCREMENTAL_HOURS)))
    return month_index.candidates(spark, path, ids.select("event_id").distinct(), month_index.shard_count(spark, path))


@register("gold_table_roundtrip", oracle.sql(f"select {oracle.FACT_OUT} from fact", "fact"))
def q_gold_table_roundtrip(spark, sf):
    """SNK2-3: fact written as an external table in the Gold database, read through the catalog."""
    staging.written_gold(spark, sf, GOLD_DATABASE)
    return _no_clock(spark.table(f"{GOLD_DATABASE}.fact_earthquake_events"))


@register(
    "run_metrics",
    oracle.sql(
        "select 'succeeded' as status, 'backfill' as mode, "
        "(select cast(count(*) as bigint) from bronze) as flattened_rows, "
        "(select cast(count(*) as bigint) from valid) as valid_rows, "
        "(select cast(count(*) as bigint) from latest) as latest_rows, "
        "(select cast(count(*) as bigint) from fact) as fact_rows, "
        "(select cast(count(*) as bigint) from dim_date) as dim_date_rows, "
        "(select cast(count(*) as bigint) from dim_location) as dim_location_rows",
        "bronze",
        "valid",
        "latest",
        "fact",
    ),
)
def q_run_metrics(spark, sf):
    """AGG5/RUN4/SNK5: a full Bronze -> Gold run; its observed counts read back from the run log."""
    run_id = uuid.uuid4().hex
    root = scratch_dir(spark, "runs", dataset_tag(sf), run_id)
    jobs.run_all(spark, staging.flat_quakes(spark, sf), root, database=f"gold_run_{run_id[:12]}", run_id=run_id)
    log = sink_tables.read_run_log(spark, f"{root}/run_log")
    return log.filter(F.col("run_id") == run_id).select(
        "status", "mode", "flattened_rows", "valid_rows", "latest_rows", "fact_rows", "dim_date_rows",
        "dim_location_rows",
    )


# --------------------------------------------------------------------------- streaming


def _stream_oracle_fetches() -> str:
    cut = f"(select date_trunc('day', min(epoch_ms(time))) + to_days({staging.OVERLAP_DAYS}) from bronze)"
    return (
        f"select * from bronze where epoch_ms(time) < {cut}\n"
        "union all\n"
        f"select * from bronze where epoch_ms(time) >= {cut} - to_hours({fixed.INCREMENTAL_HOURS})"
    )


@register(
    "stream_bronze_count",
    oracle.sql(
        "select cast(epoch_ms(time) as date) as event_day, cast(count(*) as bigint) as features "
        f"from ({_stream_oracle_fetches()}) group by 1",
        "bronze",
    ),
)
def q_stream_bronze_count(spark, sf):
    """STR1: features drained by the file stream over two overlapping fetches, per event day."""
    raw = spark.read.parquet(staging.streamed(spark, sf)["raw"])
    return raw.groupBy(F.to_date(casts.epoch_ms_to_ts("time")).alias("event_day")).agg(
        F.count(F.lit(1)).alias("features")
    )


@register("stream_dedup", oracle.sql(f"select {SILVER_SELECT} from valid", "valid"))
def q_stream_dedup(spark, sf):
    """STR2/STR4: re-fetched rows removed per micro-batch (pre-aggregated); every valid revision kept once."""
    hist = incremental.read_history(spark, staging.streamed(spark, sf)["history"])
    return hist.select(*schemas.SILVER_SELECTED_COLUMNS)


@register("stream_dedup_stateful", oracle.sql(f"select {SILVER_SELECT} from valid", "valid"))
def q_stream_dedup_stateful(spark, sf):
    """STR2 with the state store: withWatermark + dropDuplicates over the same two fetches."""
    hist = spark.read.parquet(staging.streamed(spark, sf)["history_stateful"])
    return hist.select(*schemas.SILVER_SELECTED_COLUMNS)


@register("stream_compacted_silver", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_stream_compacted_silver(spark, sf):
    """STR3 compacted form: each micro-batch merged into Silver (dynamic partition overwrite)."""
    s = sink_tables.read_silver(spark, staging.streamed(spark, sf)["compacted"])
    return s.select(*[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS])


@register("stream_latest_equals_batch", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_stream_latest_equals_batch(spark, sf):
    """STR3: latest revision computed over the streamed history equals batch Silver."""
    hist = incremental.read_history(spark, staging.streamed(spark, sf)["history"])
    return incremental.latest_from_history(hist, with_clock=False).select(
        *[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS]
    )


@register("stream_late_equals_batch", oracle.sql(f"select {oracle.SILVER_OUT} from silver", "silver"))
def q_stream_late_equals_batch(spark, sf):
    """STR2-4: a second fetch brings rows far behind the look-back and corrects content; latest equals batch Silver."""
    hist = incremental.read_history(spark, staging.late(spark, sf)["history"])
    return incremental.latest_from_history(hist, with_clock=False).select(
        *[c for c in schemas.SILVER_COLUMNS if c not in schemas.CLOCK_COLUMNS]
    )
