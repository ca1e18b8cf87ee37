"""Intact features of broken documents."""

import json
import os

from pyspark.sql import functions as F

from testdata_dirs import SF_SMALL
from tremor import registry
from tremor.operators import quality
from tremor.plans import jobs, staging
from tremor.plans import silver as silver_plan
from tremor.sinks import packs, tables
from tremor.sources import bronze, salvage


def feature(k, **props):
    return {"type": "Feature", "id": f"q{k}", "properties": {"mag": 1.0 + k / 1000, "title": 'a {"b": [', **props}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0, k]}}


def envelope(features):
    meta = {"generated": 1_700_000_000_000, "status": 200, "count": len(features)}
    return json.dumps({"type": "FeatureCollection", "metadata": meta, "features": features})


def write(path, *lines):
    os.makedirs(path)
    with open(f"{path}/d.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_truncated_document_of_a_thousand_features(spark, tmp_path):
    whole = envelope([feature(k) for k in range(1000)])
    at = whole.index('"id": "q700"') + 40
    write(f"{tmp_path}/x", whole[:at], envelope([feature(5000)]))
    docs = salvage.read_documents(spark, f"{tmp_path}/x")
    rows = bronze.flatten(docs).orderBy("depth").collect()
    assert [r["id"] for r in rows] == [f"q{k}" for k in range(700)] + ["q5000"]
    assert rows[3]["mag"] == 1.003 and rows[3]["title"] == 'a {"b": ['
    broken = docs.filter("salvage is not null").select("salvage.*", "metadata.generated", "metadata.count").first()
    start = whole.index('{"type": "Feature", "id": "q700"')
    assert tuple(broken) == (701, 700, start, 1_700_000_000_000, 1000)
    assert tuple(salvage.report(docs).first()) == (2, 1, 700, 1)
    # without salvage the document is lost
    assert bronze.flatten(bronze.read_documents(spark, f"{tmp_path}/x")).count() == 1


def test_every_way_to_break():
    f = [feature(k) for k in range(4)]
    whole = envelope(f)
    at = [whole.index(json.dumps(x)) for x in f]
    end = [a + len(json.dumps(x)) for a, x in zip(at, f)]
    ids = lambda got: [json.loads(p)["id"] for p in got[1]]
    cases = [
        (whole[:-2], ["q0", "q1", "q2", "q3"], end[3]),  # the envelope does not close
        (whole[: at[2] + 30] + whole[at[3] :], ["q0", "q1", "q3"], at[2]),  # a feature breaks off in the middle
        (whole.replace('"id": "q1",', '"id": "q1,', 1), ["q0", "q2", "q3"], at[1]),  # a string does not close
        (whole.replace('"id": "q1",', '"id" "q1",', 1), ["q0", "q2", "q3"], at[1]),  # closes, but is no JSON
        (whole[: end[1]] + "}}" + whole[end[1] :], ["q0", "q1", "q2", "q3"], end[1]),  # rubbish between features
        ("x" + whole.replace("features", "feature"), ["q0", "q1", "q2", "q3"], 0),  # the envelope's start
        ("rubbish", [], 0),
        ("", [], 0),
    ]
    for text, expected, offset in cases:
        got = salvage.cut(text)
        assert (ids(got), got[3]) == (expected, offset), text[:80]
    assert salvage.cut(None) is None
    umlauts = json.dumps({"features": [feature(0, place="Köln €"), feature(1)]}, ensure_ascii=False)
    got = salvage.cut(umlauts[:-20])
    assert got[3] == umlauts.encode().index(b'{"type": "Feature", "id": "q1"')  # in bytes


def test_repetitive_rubbish_stays_linear():
    import time

    t = time.monotonic()
    got = salvage.cut('{"type":"Feature",' * 100_000 + "{" * 1_000_000)
    assert got[1:] == ([], 100_000, 0) and time.monotonic() - t < 10


def test_empty_folder_and_blank_lines(spark, tmp_path):
    write(f"{tmp_path}/x", "", envelope([]), "")
    docs = salvage.read_documents(spark, f"{tmp_path}/x")
    assert bronze.flatten(docs).count() == 0 and tuple(salvage.report(docs).first()) == (1, 0, 0, 0)


def test_run_with_salvage_loads_what_a_whole_landing_would(spark, scratch):
    flat = registry.bronze_flat(spark, SF_SMALL)
    packs.land_packed(flat, staging.fetch_hour(flat), f"{scratch}/whole")
    text = spark.read.option("recursiveFileLookup", "true").text(f"{scratch}/whole")
    cut_off = text.select(F.expr("substring(value, 1, length(value) - 2)").alias("value"))  # every document lacks its end
    cut_off.write.text(f"{scratch}/cut/2024/01/01/00")
    r = jobs.run_landed(spark, f"{scratch}/cut", f"{scratch}/lake", database="salvage_run", salvaged=True)
    assert (r["flattened_rows"], r["valid_rows"]) == (1000, 638)
    expected = silver_plan.enrich(silver_plan.latest(quality.valid(silver_plan.select_typed(flat))), with_clock=False)
    got = tables.read_silver(spark, f"{scratch}/lake/silver/earthquakes_cleaned").select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
