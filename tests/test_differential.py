"""Randomised differential test: Spark plans vs the DuckDB oracle on adversarial Bronze rows."""

import duckdb
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor import oracle, schemas
from tremor.operators import fact
from tremor.plans import silver as silver_plan

T0 = 1704067200000
ARROW_TYPES = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}

row = st.fixed_dictionaries(
    {
        "id": st.sampled_from(["a", "b", "c", "d", "e", "f", None]),
        "mag": st.sampled_from([None, -2.0, 2.5, 2.999, 3.0, 4.2, 5.5, 6.1, 7.9, 8.0, 10.0, 10.5]),
        "place": st.sampled_from([None, "x", "1 km N of A, B", "1 km N of A, B, C", "y, ", " z ,  w "]),
        "time": st.integers(min_value=T0 - 40 * 86400000, max_value=T0 + 40 * 86400000),
        "updated": st.sampled_from([None, T0, T0 + 1, T0 + 2]),
        "tsunami": st.sampled_from([None, 0, 1, 2]),
        "sig": st.sampled_from([None, 5, 3_000_000_000]),
        "magType": st.sampled_from([None, "mb", "ml", "mb"]),
        "type": st.sampled_from([None, "earthquake", "quarry blast", "earthquake"]),
        "longitude": st.sampled_from([None, -180.0, -0.5, 0.0, 12.25, 179.5, 180.0, 180.5]),
        "latitude": st.sampled_from([None, -90.0, -12.5, 0.0, 45.25, 90.0, 91.0]),
        "depth": st.sampled_from([None, -1.0, 0.0, 10.0, 70.0, 70.5, 300.0, 300.5, 999.0, 1000.0]),
    }
)


def flat_frames(spark, rows):
    cols = schemas.BRONZE_FLAT_COLUMNS
    types = {n: t.simpleString() for n, t in schemas.PROPERTY_FIELDS}
    types.update({"id": "string", "longitude": "double", "latitude": "double", "depth": "double"})
    data = [tuple(r.get(c) for c in cols) for r in rows]
    sdf = spark.createDataFrame(data, ", ".join(f"`{c}` {types[c]}" for c in cols))
    arrow = pa.table({c: pa.array([r.get(c) for r in rows], type=ARROW_TYPES[types[c]]) for c in cols})
    return sdf, arrow


def oracle_rows(arrow, body, *blocks):
    con = duckdb.connect()
    con.register("bronze_df", arrow)
    sql = oracle.sql(body, *blocks).replace(oracle.BLOCKS["bronze"][1], "\nselect * from bronze_df")
    return sorted(map(tuple, con.sql(sql).fetchall()), key=repr)


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=10, max_size=60))
def test_silver_and_fact_match_oracle(spark, rows):
    sdf, arrow = flat_frames(spark, rows)
    silver = silver_plan.silver(sdf, with_clock=False)
    got = sorted(map(tuple, silver.select(*oracle.SILVER_OUT.split(", ")).collect()), key=repr)
    assert got == oracle_rows(arrow, f"select {oracle.SILVER_OUT} from silver", "silver")
    for null_safe, block in ((False, "fact"), (True, "fact_nullsafe")):
        f = fact.fact_events(silver, null_safe=null_safe, with_clock=False)
        got = sorted(map(tuple, f.select(*oracle.FACT_OUT.split(", ")).collect()), key=repr)
        assert got == oracle_rows(arrow, f"select {oracle.FACT_OUT} from {block}", block)


@settings(max_examples=5, deadline=None)
@given(st.lists(row, min_size=10, max_size=60))
def test_dimensions_and_rollups_match_oracle(spark, rows):
    from tremor.operators import dims, rollups

    sdf, arrow = flat_frames(spark, rows)
    silver = silver_plan.silver(sdf, with_clock=False)
    if silver.isEmpty():
        return
    d = dims.all_dims(silver)
    f = fact.fact_events(silver, with_clock=False)
    for name in ("dim_date", "dim_location", "dim_event_type", "dim_magnitude"):
        got = sorted(map(tuple, d[name].collect()), key=repr)
        assert got == oracle_rows(arrow, f"select * from {name}", name), name
    cases = {
        "l.extracted_country": (rollups.by_region(f, d["dim_location"]), "join dim_location l on f.LocationKey = l.LocationKey"),
        "m.MagnitudeCategory, m.MinMagnitude, m.MaxMagnitude": (
            rollups.by_magnitude(f, d["dim_magnitude"]), "join dim_magnitude m on f.MagnitudeKey = m.MagnitudeKey"),
        "d.Year, d.Month": (rollups.by_month(f, d["dim_date"]), "join dim_date d on f.DateKey = d.DateKey"),
        "d.DayOfWeek, d.IsWeekend": (rollups.by_weekday(f, d["dim_date"]), "join dim_date d on f.DateKey = d.DateKey"),
    }
    for group, (df, join) in cases.items():
        body = f"select {group}, {oracle.ROLLUP_MEASURES} from fact f {join} group by {group}"
        want = oracle_rows(arrow, body, "fact")
        got = sorted(map(tuple, df.collect()), key=repr)
        assert sorted(got) == sorted(want), group


@settings(max_examples=4, deadline=None)
@given(st.lists(row, min_size=10, max_size=60), st.integers(min_value=0, max_value=2**31))
def test_incremental_merges_equal_one_batch(spark, rows, seed):
    """Silver from batch 1, then batches 2 and 3 merged in == Silver of all rows (months move, some empty)."""
    import random
    import uuid

    from tremor.plans import jobs
    from tremor.session import scratch_dir
    from tremor.sinks import tables

    rnd = random.Random(seed)
    parts = [[], [], []]
    for r in rows:
        parts[rnd.randrange(3)].append(r)
    path = scratch_dir(spark, "tests", "merge_diff", uuid.uuid4().hex, "silver")
    first = True
    for part in parts:
        if not part:
            continue
        sdf, _ = flat_frames(spark, part)
        if first and not silver_plan.silver(sdf, with_clock=False).isEmpty():
            jobs.run_silver(sdf, path)
            first = False
        elif not first:
            jobs.merge_silver(spark, sdf, path)
    all_rows, _ = flat_frames(spark, rows)
    want = sorted(map(tuple, silver_plan.silver(all_rows, with_clock=False).select(*oracle.SILVER_OUT.split(", ")).collect()), key=repr)
    got = [] if first else sorted(
        map(tuple, tables.read_silver(spark, path).select(*oracle.SILVER_OUT.split(", ")).collect()), key=repr
    )
    assert got == want
