"""The event catalogue reproduces the published fixture profile (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.functions import casts
from tremor.operators import quality
from tremor.plans import silver as silver_plan

EXPECTED = {
    SF_SMALL: dict(raw=1000, valid=638, latest=241, months=20, wrong=148, null_keys=60, locations=56,
                   types=5, classes=[224, 6, 4, 1, 2, 0, 4]),
}
CLASSES = ["Micro", "Minor", "Light", "Moderate", "Strong", "Major", "Great"]


@pytest.mark.parametrize("sf", list(EXPECTED))
def test_profile(spark, sf):
    exp = EXPECTED[sf]
    typed = registry.selected(spark, sf)
    assert typed.count() == exp["raw"]
    valid = quality.valid(typed)
    assert valid.count() == exp["valid"]
    silver = registry.silver_rows(spark, sf)
    assert silver.count() == exp["latest"]
    assert silver.select("year", "month").distinct().count() == exp["months"]
    # the traps a plain catalogue lacks: ties and nulls in `updated`, moved events, places equal to six decimals
    assert valid.groupBy("event_id").agg(F.count_distinct("updated_timestamp_utc").alias("n"), F.count("*").alias("m")).filter("m > n").count() > 50
    moved = valid.groupBy("event_id").agg(F.count_distinct(F.date_format("event_timestamp_utc", "yyyy-MM")).alias("n"))
    assert moved.filter("n > 1").count() > 10
    near = silver.select(F.round("latitude", 6).alias("a"), F.round("longitude", 6).alias("b"), "place").distinct().count()
    assert near < exp["locations"]
    wrong = quality.valid(silver_plan.latest(typed))
    assert wrong.count() == exp["wrong"]
    assert silver.filter(F.col("place").isNull() | F.col("magType").isNull()).count() == exp["null_keys"]
    assert silver.select("latitude", "longitude", "place").distinct().count() == exp["locations"]
    assert silver.select("event_type", "magType").distinct().count() == exp["types"]
    counts = {r[0]: r[1] for r in silver.groupBy("magnitude_category").count().collect()}
    assert [counts.get(c, 0) for c in CLASSES] == exp["classes"]
