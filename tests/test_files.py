"""Files of other shapes: large FeatureCollections read by byte ranges, meter files with different headers, the regression job's output."""

import json
import os
import tempfile

import pytest

from metrolens.plans import jobs
from metrolens.sources import geojson, readers


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def feature(i, **more):
    lines = [[[float(i), 1.0], [float(i), 2.5]], [[9.0, 9.0]]]
    return {"type": "Feature", **more, "properties": {"name": f'street, "Feature" {i} é'}, "geometry": {"type": "MultiLineString", "coordinates": lines}}


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1000"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_collections_are_read_by_byte_ranges(spark, small_ranges):
    folder = tempfile.mkdtemp(prefix="metrolens-geo-")
    for k in range(2):
        doc = {"type": "FeatureCollection", "name": "streets", "features": [feature(k * 800 + i) for i in range(800)]}
        write(folder, f"{k}.geojson", json.dumps(doc, indent=2 * k or None, ensure_ascii=False))
    pieces = spark.read.option("lineSep", '"Feature"').text(folder)
    assert pieces.rdd.getNumPartitions() > 10
    points = sorted(map(tuple, geojson.first_line_points(geojson.read_collection(spark, folder)).collect()))
    assert points == [(i, k, float(i), (1.0, 2.5)[k]) for i in range(1600) for k in range(2)]  # ids go on over the files


def test_collection_ids_and_odd_documents(spark):
    folder = tempfile.mkdtemp(prefix="metrolens-geo-")
    write(folder, "a.json", json.dumps({"type": "FeatureCollection", "features": [feature(5, id=70), {"type": "Feature", "geometry": None, "id": 71}]}))
    write(folder, "b.json", json.dumps({"type": "FeatureCollection", "features": []}))
    got = {r.feature_id: r.geometry for r in geojson.read_collection(spark, folder).collect()}
    assert set(got) == {70, 71} and got[71] is None and got[70].coordinates[0][1] == [5.0, 2.5]
    for name, doc in (("late", {"geometry": feature(1)["geometry"], "type": "Feature"}), ("cut", feature(1) | {"kind": "Feature"})):
        bad = tempfile.mkdtemp(prefix="metrolens-geo-")
        write(bad, "x.json", json.dumps({"type": "FeatureCollection", "features": [doc]}))
        with pytest.raises(Exception):  # noqa: B017, PT011
            geojson.read_collection(spark, bad).collect()


def test_written_collections_are_documents(spark):
    folder = os.path.join(tempfile.mkdtemp(prefix="metrolens-geo-"), "out")
    rows = spark.createDataFrame([(f"p{i}", i) for i in range(7)], "name string, id long").selectExpr("'Feature' type", "id", "named_struct('n', name) properties",
                                                                                                     "named_struct('type', 'MultiLineString', 'coordinates', array(array(array(1.0D, 2.0D)))) geometry")
    geojson.write_collections(rows.repartition(3), folder)
    docs = [json.loads(open(os.path.join(folder, f), encoding="utf-8").read()) for f in os.listdir(folder) if f.startswith("part-")]
    assert sorted(x["id"] for d in docs for x in d["features"]) == list(range(7)) and {d["type"] for d in docs} == {"FeatureCollection"}
    assert geojson.read_collection(spark, folder).count() == 7


def test_meter_files_with_other_headers(spark):
    folder = tempfile.mkdtemp(prefix="metrolens-meters-")
    write(folder, "a.csv", "MeterNo,the_geom,pole\nm1,POINT (1 2),x\n")
    write(folder, "b.csv", "the_geom,MeterNo\nPOINT (3 4),m2\n")
    write(folder, "c d.csv", "MeterNo,the_geom,pole\nm3,POINT (5 6),y\n")
    got = sorted((r.MeterNo, r.the_geom, r.pole) for r in readers.load_parking_meters(spark, folder).collect())
    assert got == [("m1", "POINT (1 2)", "x"), ("m2", "POINT (3 4)", None), ("m3", "POINT (5 6)", "y")]
    bad = tempfile.mkdtemp(prefix="metrolens-meters-")
    write(bad, "a.csv", "MeterNo,other\nm1,2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        readers.load_parking_meters(spark, bad)


def test_regression_job_writes_its_summary(spark):
    folder = tempfile.mkdtemp(prefix="metrolens-fit-")
    rows = ["tpep_pickup_datetime,trip_distance,pickup_latitude,pickup_longitude,dropoff_latitude,dropoff_longitude,fare_amount"]
    rows += [f"2013-01-02 03:04:05,1.5,40.7,-73.95,{40.7 + i / 2000},-73.9,{5 + i / 10}" for i in range(1, 200)]
    write(folder, "trips.csv", "\n".join(rows))
    out = os.path.join(folder, "out")
    jobs.fare_regression_job(spark, os.path.join(folder, "trips.csv"), out)
    r = spark.read.option("header", True).csv(out).first()
    assert float(r["test_rmse"]) >= 0 and "," not in r["coefficients"]
