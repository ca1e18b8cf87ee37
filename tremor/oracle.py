"""DuckDB oracle SQL, composed from named CTE blocks.

Each block restates one layer in plain SQL over the pre-registered views
(``events``, ``orders``, ``lineitem``). ``sql(body, *blocks)`` emits the
blocks a query needs in dependency order. The Gold blocks use the
reference's *join* formulation (fact joined to each dimension on its
natural key), which independently checks the key-derived fact the Spark
side builds.
"""

from __future__ import annotations

from . import fixed
from .functions import keys
from .schemas import SILVER_SELECTED_COLUMNS

TIEBREAK_COLUMNS = [c for c in SILVER_SELECTED_COLUMNS if c not in ("event_id", "updated_timestamp_utc")]
from .functions.features import (
    DEPTH_CLASSES,
    DEPTH_TOP_CLASS,
    MAGNITUDE_CLASSES,
    MAGNITUDE_TOP_CLASS,
    REGION_PATTERN,
)

DETAIL_SQL = f"trim(regexp_extract(place, '{REGION_PATTERN}', 1))"
_DETAIL = DETAIL_SQL

MAGNITUDE_CASE = (
    "case "
    + " ".join(f"when magnitude < {b} then '{label}'" for b, label in MAGNITUDE_CLASSES)
    + f" else '{MAGNITUDE_TOP_CLASS}' end"
)
HEMISPHERE_NS_CASE = "case when latitude >= 0 then '{}' else '{}' end".format(*fixed.HEMISPHERE_NS)
HEMISPHERE_EW_CASE = "case when longitude >= 0 then '{}' else '{}' end".format(*fixed.HEMISPHERE_EW)
DEPTH_CASE = (
    "case "
    + " ".join(f"when depth_km <= {b} then '{label}'" for b, label in DEPTH_CLASSES)
    + f" else '{DEPTH_TOP_CLASS}' end"
)


def coordinate_sql(col: str) -> str:
    return f"case when abs({col}) < {keys.SMALLEST!r} then 0.0 else {col} end"


def _coordinate_part(col: str) -> str:
    x = f"(({coordinate_sql(col)}) * {keys.COARSE!r})"
    return (
        f"coalesce(concat(cast(cast(floor({x}) as bigint) as varchar), '.', "
        f"cast(cast(floor(({x} - floor({x})) * {keys.FINE!r}) as bigint) as varchar)) "
        f"|| case when {col} is null then null else '' end, '{keys.NULL_PART}')"
    )


def _text_part(col: str) -> str:
    return f"coalesce(cast(length({col}) as varchar) || ':' || {col}, '{keys.NULL_PART}')"


def hash_sql(*parts: str) -> str:
    return f"md5(concat_ws('|', {', '.join(parts)}))"


def loc_key_sql(prefix: str = "") -> str:
    p = prefix
    return hash_sql(_coordinate_part(f"{p}latitude"), _coordinate_part(f"{p}longitude"), _text_part(f"{p}place"))


def type_key_sql(prefix: str = "") -> str:
    return hash_sql(_text_part(f"{prefix}event_type"), _text_part(f"{prefix}magType"))


def mag_key_sql(col: str) -> str:
    return hash_sql(_text_part(col))


BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}


def _block(name: str, deps: tuple[str, ...], body: str) -> None:
    BLOCKS[name] = (deps, body)


_block(
    "quakes",
    (),
    """
select id, event_ts,
  case when event_id % 31 = 7 then null when event_id // 4 % 7 = 0 then timestamp '2026-01-01 00:00:00'
       else event_ts + to_hours(cast(event_id % 5 as int)) end as updated_ts, event_id as revision,
  case when event_id % 97 = 0 then null else value / 25.0 - 2.5 end as magnitude,
  cast((event_id * 37) % 1150 as double) - 50.0 as depth_km,
  cast((user_id * 7) % 191 as double) - 95.0 + cast(event_id % 4 as double) / 10000000.0 as latitude,
  cast((user_id * 13) % 373 as double) - 186.0 + cast(user_id % 7 as double) / 64.0 as longitude,
  case when user_id % 11 = 0 then null
       when user_id % 7 = 0 then concat('Ridge ', cast(user_id % 5 as varchar))
       when user_id % 17 = 0 then concat('a|b:', cast(user_id % 3 as varchar), ', Land|', cast(user_id % 2 as varchar))
       when user_id % 13 = 0 then concat('near X', cast(user_id % 3 as varchar), ', ')
       else concat(cast(user_id as varchar), ' km N of Town', cast(user_id % 9 as varchar),
                   ', Prov', cast(user_id % 4 as varchar), ', Land', cast(user_id % 6 as varchar)) end as place,
  case when event_type = 'signup' then 'quarry blast' else 'earthquake' end as event_type,
  case when event_type = 'error' then null when event_type = 'view' then 'ml' when event_type = 'click' then 'm|b'
       else 'mb' end as mag_type,
  case when event_id % 10 = 3 then null else cast(event_id % 2 as int) end as tsunami,
  cast(event_id % 1000 as int) as sig,
  cast(user_id % 50 as int) as felt
from (select *, concat('q', cast(event_id - event_id % 4 as varchar)) as id,
    ts + to_days(cast(event_id // 4 % 19 * 30 + case when event_id % 4 = 3 and event_id // 4 % 5 = 0 then 31 else 0 end as int))
      as event_ts
  from events)""",
)

_block(
    "bronze",
    ("quakes",),
    """
select id, magnitude as mag, place, epoch_us(event_ts) // 1000 as time, epoch_us(updated_ts) // 1000 as updated,
  concat('http://x/', id) as url, cast(felt as bigint) as felt,
  cast(revision % 10 as double) as cdi, cast(null as double) as mmi,
  case when revision % 5 = 0 then 'green' end as alert,
  case when revision % 2 = 0 then 'reviewed' else 'automatic' end as status,
  cast(tsunami as bigint) as tsunami, cast(sig as bigint) as sig, 'xx' as net,
  cast(revision as varchar) as code,
  case when revision % 7 = 0 then null else revision % 150 end as nst,
  cast(null as double) as dmin,
  cast(revision % 100 as double) / 100.0 as rms,
  cast((revision * 7) % 360 as double) as gap,
  mag_type as magType, event_type as type, concat('Quake ', id) as title,
  longitude, latitude, depth_km as depth
from quakes""",
)

_block(
    "selected",
    ("bronze",),
    """
select id as event_id, epoch_ms(time) as event_timestamp_utc, epoch_ms(updated) as updated_timestamp_utc,
  try_cast(mag as double) as magnitude, try_cast(depth as double) as depth_km, latitude, longitude, place,
  type as event_type, magType, tsunami = 1 as tsunami_warning,
  try_cast(sig as integer) as significance, try_cast(felt as integer) as felt_reports,
  try_cast(nst as integer) as nst_stations, try_cast(rms as double) as rms_travel_time,
  try_cast(gap as double) as gap_azimuthal, alert, status, url, title
from bronze""",
)

RULE_PREDICATES = {
    "magnitude_range": "magnitude is not null and magnitude between {} and {}".format(*fixed.MAGNITUDE_RANGE),
    "latitude_range": "latitude is not null and latitude between {} and {}".format(*fixed.LATITUDE_RANGE),
    "longitude_range": "longitude is not null and longitude between {} and {}".format(*fixed.LONGITUDE_RANGE),
    "depth_range": "depth_km is not null and depth_km >= {} and depth_km < {}".format(*fixed.DEPTH_RANGE),
    "time_and_id_present": "event_timestamp_utc is not null and event_id is not null",
}
VALID_PREDICATE = " and ".join(f"({p})" for p in RULE_PREDICATES.values())

_block("valid", ("selected",), f"select * from selected where {VALID_PREDICATE}")

_block(
    "latest",
    ("valid",),
    """
select * exclude (rn) from (
  select *, row_number() over (partition by event_id order by updated_timestamp_utc desc nulls last, {TIEBREAK}) as rn
  from valid) where rn = 1""".replace("{TIEBREAK}", ", ".join(f"{c} asc nulls last" for c in TIEBREAK_COLUMNS)),
)

FEATURES_SQL = f"""
  {MAGNITUDE_CASE} as magnitude_category,
  {DEPTH_CASE} as depth_category,
  {HEMISPHERE_NS_CASE} as hemisphere_ns,
  {HEMISPHERE_EW_CASE} as hemisphere_ew,
  cast(year(event_timestamp_utc) as integer) as year,
  cast(month(event_timestamp_utc) as integer) as month,
  cast(day(event_timestamp_utc) as integer) as day,
  cast(hour(event_timestamp_utc) as integer) as hour,
  cast(dayofweek(event_timestamp_utc) + 1 as integer) as day_of_week,
  {_DETAIL} as extracted_region_detail,
  case when {_DETAIL} <> '' then {_DETAIL} else trim(place) end as extracted_country"""

_block("silver", ("latest",), f"select *, {FEATURES_SQL} from latest")

_block(
    "span",
    ("silver",),
    """
select cast(min(event_timestamp_utc) as date) as min_date, cast(max(event_timestamp_utc) as date) as max_date
from silver""",
)

_block(
    "dim_date",
    ("span",),
    """
select cast(strftime(d, '%Y%m%d') as integer) as DateKey, d as FullDate,
  cast(year(d) as integer) as Year, cast(quarter(d) as integer) as Quarter, cast(month(d) as integer) as Month,
  monthname(d) as MonthName, cast(day(d) as integer) as DayOfMonth,
  cast(dayofweek(d) + 1 as integer) as DayOfWeek, dayname(d) as DayName,
  cast(case when dayofweek(d) in (0, 6) then 1 else 0 end as integer) as IsWeekend
from (select cast(unnest(generate_series(min_date, max_date + 30, interval 1 day)) as date) as d from span)""",
)

_block(
    "dim_location",
    ("silver",),
    f"""
select *, {loc_key_sql()} as LocationKey from (
  select distinct latitude, longitude, place, extracted_country, extracted_region_detail,
    {HEMISPHERE_NS_CASE} as hemisphere_ns, {HEMISPHERE_EW_CASE} as hemisphere_ew
  from (select * replace ({coordinate_sql('latitude')} as latitude, {coordinate_sql('longitude')} as longitude) from silver))""",
)

def _magnitude_values() -> str:
    MAGNITUDE_ROWS = fixed.MAGNITUDE_ROWS

    def lit(v):
        if v is None:
            return "cast(null as double)"
        if isinstance(v, float):
            return f"cast({v!r} as double)"
        return "'" + v.replace("'", "''") + "'"

    return ",\n  ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in MAGNITUDE_ROWS)


_block(
    "dim_magnitude",
    (),
    f"""
select *, {mag_key_sql('MagnitudeCategory')} as MagnitudeKey from (values
  {_magnitude_values()}
) t(MagnitudeCategory, MinMagnitude, MaxMagnitude, Description)""",
)

_block(
    "dim_event_type",
    ("silver",),
    f"select *, {type_key_sql()} as EventTypeKey from (select distinct event_type, magType from silver)",
)

FACT_SELECT = """
  s.event_id as EventID, d.DateKey, l.LocationKey, m.MagnitudeKey, t.EventTypeKey,
  s.magnitude as Magnitude, s.depth_km as DepthKm, s.tsunami_warning as TsunamiWarning,
  s.significance as Significance, s.felt_reports as FeltReports, s.nst_stations as NumberOfStations,
  s.rms_travel_time as RmsTravelTime, s.gap_azimuthal as AzimuthalGap, s.url as SourceURL"""

_DATE_KEY = "cast(strftime(s.event_timestamp_utc, '%Y%m%d') as integer)"

_block(
    "fact",
    ("silver", "dim_date", "dim_location", "dim_magnitude", "dim_event_type"),
    f"""
select {FACT_SELECT}
from silver s
join dim_date d on d.DateKey = {_DATE_KEY}
join dim_location l on s.latitude = l.latitude and s.longitude = l.longitude and s.place = l.place
join dim_magnitude m on s.magnitude_category = m.MagnitudeCategory
join dim_event_type t on s.event_type = t.event_type and s.magType = t.magType""",
)

_block(
    "fact_nullsafe",
    ("silver", "dim_date", "dim_location", "dim_magnitude", "dim_event_type"),
    f"""
select {FACT_SELECT}
from silver s
join dim_date d on d.DateKey = {_DATE_KEY}
join dim_location l on s.latitude is not distinct from l.latitude and s.longitude is not distinct from l.longitude
  and s.place is not distinct from l.place
join dim_magnitude m on s.magnitude_category = m.MagnitudeCategory
join dim_event_type t on s.event_type is not distinct from t.event_type and s.magType is not distinct from t.magType""",
)


def sql(body: str, *blocks: str) -> str:
    """``WITH`` the given blocks (and their dependencies) then ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in BLOCKS[name][0]:
            visit(dep)
        order.append(name)

    for b in blocks:
        visit(b)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


SILVER_OUT = (
    "event_id, event_timestamp_utc, updated_timestamp_utc, magnitude, depth_km, latitude, longitude, place, "
    "event_type, magType, tsunami_warning, significance, felt_reports, nst_stations, rms_travel_time, "
    "gap_azimuthal, alert, status, url, title, magnitude_category, depth_category, hemisphere_ns, hemisphere_ew, "
    "year, month, day, hour, day_of_week, extracted_region_detail, extracted_country"
)

FACT_OUT = (
    "EventID, DateKey, LocationKey, MagnitudeKey, EventTypeKey, Magnitude, DepthKm, TsunamiWarning, Significance, "
    "FeltReports, NumberOfStations, RmsTravelTime, AzimuthalGap, SourceURL"
)

def exact_avg_sql(col: str) -> str:
    """Half-up rounded average at 6 places from an exact micro-unit integer sum."""
    s = f"cast(sum(cast({col} as decimal(20,6))) * 1000000 as hugeint)"
    n = f"count({col})"
    return f"cast(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) as double) / 1000000.0"


ROLLUP_MEASURES = f"""cast(count(*) as bigint) as events, max(f.Magnitude) as max_magnitude,
  {exact_avg_sql('f.Magnitude')} as avg_magnitude, {exact_avg_sql('f.DepthKm')} as avg_depth_km,
  cast(count(*) filter (where f.TsunamiWarning) as bigint) as tsunami_events"""
