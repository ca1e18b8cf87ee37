"""Property tests: Spark expressions vs plain-Python definitions on random inputs."""

import datetime as dt
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor import fixed
from tremor.functions import casts, features, keys

SETTINGS = settings(max_examples=8, deadline=None)
BOUNDARIES = [b for b, _ in fixed.MAGNITUDE_CLASSES] + [float(b) for b, _ in fixed.DEPTH_CLASSES]
doubles = st.one_of(
    st.floats(min_value=-5, max_value=1100),
    st.just(float("nan")),
    st.sampled_from(BOUNDARIES + [math.nextafter(b, -math.inf) for b in BOUNDARIES]),
    st.none(),
)


def classify(x, classes, top, inclusive):
    if x is None:
        return top  # a null falls through every WHEN (filtered upstream in the pipeline)
    for bound, label in classes:
        if (x <= bound) if inclusive else (x < bound):
            return label
    return top


def frame(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", typ, True)]))


@SETTINGS
@given(st.lists(doubles, min_size=1, max_size=60))
def test_classes_match_definition(spark, values):
    rows = frame(spark, values, T.DoubleType()).select(
        "x", features.magnitude_category("x").alias("m"), features.depth_category("x").alias("d")
    ).collect()
    for r in rows:
        assert r.m == classify(r.x, fixed.MAGNITUDE_CLASSES, fixed.MAGNITUDE_TOP_CLASS, False)
        assert r.d == classify(r.x, fixed.DEPTH_CLASSES, fixed.DEPTH_TOP_CLASS, True)


epoch_ms = st.integers(min_value=-2_208_988_800_000, max_value=4_102_444_800_000)  # 1900 .. 2100


@SETTINGS
@given(st.lists(epoch_ms, min_size=1, max_size=60))
def test_epoch_ms_round_trip_and_date_key(spark, values):
    ts = casts.epoch_ms_to_ts("x")
    rows = frame(spark, values, T.LongType()).select(
        "x", ts.alias("t"), casts.ts_to_epoch_ms(ts).alias("back"), casts.date_key(ts).alias("k"),
        F.dayofweek(ts).alias("dow"),
    ).collect()
    epoch = dt.datetime(1970, 1, 1)
    for r in rows:
        want = epoch + dt.timedelta(milliseconds=r.x)
        assert r.t == want and r.back == r.x
        assert r.k == int(want.strftime("%Y%m%d"))
        assert r.dow == want.isoweekday() % 7 + 1


places = st.one_of(st.none(), st.text(alphabet="ab ,\tXY1", max_size=14))


def py_detail(place):
    if place is None:
        return None
    m = re.search(r",\s*(.*)$", place)
    return (m.group(1) if m else "").strip(" ")


@SETTINGS
@given(st.lists(places, min_size=1, max_size=60))
def test_region_parsing_matches_definition(spark, values):
    df = frame(spark, values, T.StringType()).withColumn("d", features.region_detail("x"))
    rows = df.select("x", "d", features.country("d", "x").alias("c")).collect()
    for r in rows:
        d = py_detail(r.x)
        assert r.d == d
        assert r.c == (None if r.x is None else (d if d != "" else r.x.strip(" ")))


coords = st.one_of(st.none(), st.integers(min_value=-180_000_000, max_value=180_000_000).map(lambda v: v / 1e6))


@SETTINGS
@given(st.lists(st.tuples(coords, coords, places), min_size=2, max_size=60, unique=True))
def test_location_key_is_a_function_of_the_natural_key(spark, values):
    df = spark.createDataFrame(values, "latitude double, longitude double, place string")
    rows = df.select("latitude", "longitude", "place", keys.location_key().alias("k")).collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, set()).add((r.latitude, r.longitude, r.place))
    assert all(len(v) == 1 for v in by_key.values())  # no two natural keys share a surrogate key
    again = {r.k for r in df.repartition(3).select(keys.location_key().alias("k")).collect()}
    assert again == set(by_key)
