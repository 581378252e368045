"""End-to-end jobs on reference-shaped CSV files, and the streaming variant."""

import glob
import json
import os

from metrolens.plans import jobs
from metrolens.session import scratch_path
from metrolens.sources import read_csv
from metrolens.streaming import tickets as stream

from . import fixtures as fx


def _write_csv(spark, df, name):
    p = scratch_path(spark, name)
    df.coalesce(1).write.option("header", True).csv(p)
    return p


def _local(p):
    return p.replace("file:", "")


def test_parking_jobs(spark):
    t = _write_csv(spark, fx.tickets(spark), "tickets-csv")
    s = _write_csv(spark, fx.segments(spark), "segments-csv")
    m = _write_csv(spark, fx.meters(spark), "meters-csv")

    out = scratch_path(spark, "seg-out")
    jobs.tickets_per_segment_job(spark, t, s, out)
    rows = read_csv(spark, out, "the_geom string, count long", header=False).collect()
    assert {r.the_geom: r["count"] for r in rows} == {"G2": 2, "G3": 2, "G5": 1, "G6": 6, "G8": 3}

    out = scratch_path(spark, "seg-day-out")
    jobs.tickets_per_segment_by_day_job(spark, t, s, out)
    assert len(glob.glob(_local(out) + "/day_of_week=*")) >= 1

    out = scratch_path(spark, "hour-out")
    jobs.tickets_by_hour_job(spark, t, out)
    rec = [json.loads(x) for f in glob.glob(_local(out) + "/*.json") for x in open(f)]
    assert rec == [{"keys": [0, 6, 12, 21, 23], "values": [1, 1, 1, 1, 1]}]

    out = scratch_path(spark, "meters-out")
    jobs.meters_near_job(spark, t, m, out, longitude=-73.99, latitude=40.75)
    rows = read_csv(spark, out, "MeterNo string, count long, lat double, lon double, txt string", header=False).collect()
    assert {r.MeterNo: r["count"] for r in rows}["1111111"] == 0


def test_stream_counts(spark):
    src = _local(scratch_path(spark, "stream-in"))
    os.makedirs(src)
    header = "Plate Id,Issue Date,Street Name,House Number,Violation Time,Issuer Code,Meter Number\n"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(header + "P1,08/04/2013,A,1,0623A,1,\nP2,08/04/2013,A,1,0630A,1,\n")
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(header + "P3,08/05/2013,A,1,1159P,1,\nP4,08/05/2013,A,1,xx,1,\n")
    out = scratch_path(spark, "stream-out")
    q = stream.start_counts(spark, src, out, by="hour")
    q.awaitTermination(120)
    got = {r.hour: r.tickets for r in spark.read.parquet(out).collect()}
    assert got == {6: 2, 23: 1}


def test_taxi_and_bike_jobs(spark):
    import datetime as dt
    trips = spark.createDataFrame([
        (dt.datetime(2016, 1, 1, 0, 30), 1.5, -73.99, 40.75, -73.95, 40.78, 12.0),
        (dt.datetime(2016, 1, 2, 23, 10), 2.5, -73.98, 40.74, -73.90, 40.80, 20.0),
        (dt.datetime(2016, 2, 1, 0, 5), 3.0, 0.0, 0.0, -73.90, 40.80, 20.0),
        (None, 4.0, -73.97, 40.70, -73.96, 40.71, 8.0),
    ], "tpep_pickup_datetime timestamp, trip_distance double, pickup_longitude double, pickup_latitude double, "
       "dropoff_longitude double, dropoff_latitude double, fare_amount double")
    tp = _write_csv(spark, trips, "trips-csv")
    out = scratch_path(spark, "monthly-out")
    jobs.monthly_trips_job(spark, tp, out)
    rows = read_csv(spark, out, "year int, month int, avg_distance double, trips long", header=False).collect()
    assert sorted(tuple(r) for r in rows) == [(2016, 1, 2.0, 2), (2016, 2, 3.0, 1)]
    out = scratch_path(spark, "midnight-out")
    jobs.midnight_trips_job(spark, tp, out)
    assert read_csv(spark, out, "t string, lon double, lat double", header=False).count() == 2
    out = scratch_path(spark, "clusters-out")
    jobs.pickup_clusters_job(spark, tp, out)
    got = read_csv(spark, out, "pickup_latitude double, pickup_longitude double, predction_pickup int")
    assert got.count() == 3  # the zero-coordinate trip is dropped
    out = scratch_path(spark, "pairs-out")
    jobs.distance_fare_export_job(spark, tp, out)
    assert read_csv(spark, out, "fare_amount double, distance double").count() == 3  # NULL time does not matter here

    bikes = spark.createDataFrame([
        ("01/05/2016 08:00:00", "01/05/2016 08:20:00", 1200, 1, 2, "A", "Main St", "1", "1980", "S"),
        ("07/05/2016 18:00:00", "07/05/2016 18:20:00", 1200, 3, 4, "B", "Elm St", "2", "1990", "C"),
        ("07/05/2016 18:00:00", "07/05/2016 18:20:00", -1, 3, 4, "B", "Elm St", "2", "1990", "C"),
    ], "starttime string, stoptime string, duration int, startId int, endId int, endName string, address string, "
       "gender string, `birth year` string, usertype string")
    bp = _write_csv(spark, bikes, "bikes-csv")
    addr = _write_csv(spark, spark.createDataFrame([("Main St", 40.7, -74.0), ("Elm St", 55.0, -73.0)],
                                                   "address string, latitude double, longtitude double"), "addr-csv")
    out = scratch_path(spark, "geocode-out")
    jobs.geocode_job(spark, bp, addr, out)
    assert read_csv(spark, out, "starttime string", header=False).count() == 1  # latitude 55 is out of bounds
    out = scratch_path(spark, "season-out")
    jobs.season_split_job(spark, bp, out)
    parts = sorted(p.split("/")[-2] + "/" + p.split("/")[-1] for p in glob.glob(_local(out) + "/season=*/time_of_day=*"))
    assert parts == ["season=summer/time_of_day=evening", "season=winter/time_of_day=morning"]


def test_stream_restart_resumes_from_checkpoint(spark):
    src = _local(scratch_path(spark, "stream-in-wd"))
    os.makedirs(src)
    header = "Plate Id,Issue Date,Street Name,House Number,Violation Time,Issuer Code,Meter Number\n"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(header + "P1,08/04/2013,A,1,0623A,1,\nP2,08/05/2013,A,1,0630A,1,\n")
    out = scratch_path(spark, "stream-out-wd")
    ckpt = scratch_path(spark, "stream-ckpt-wd")
    stream.start_counts(spark, src, out, by="weekday", checkpoint=ckpt).awaitTermination(120)
    assert {r.day_of_week: r.tickets for r in spark.read.parquet(out).collect()} == {7: 1, 1: 1}
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(header + "P3,08/04/2013,A,1,1159P,1,\nP4,13/45/2013,A,1,xx,1,\n")
    stream.start_counts(spark, src, out, by="weekday", checkpoint=ckpt).awaitTermination(120)
    assert {r.day_of_week: r.tickets for r in spark.read.parquet(out).collect()} == {7: 2, 1: 1}


def test_export_readers(spark):
    exp = spark.createDataFrame([(40.7, -73.9, 3), (40.6, -73.9, 1), (41.5, -73.9, 2), (40.8, -73.8, 19)],
                                "pickup_latitude double, pickup_longitude double, predction_pickup int")
    p = scratch_path(spark, "cluster-export")
    exp.coalesce(1).write.option("header", True).csv(p)
    got = sorted(tuple(r) for r in jobs.cluster_colors_from_export(spark, p).collect())
    assert got == [(-73.9, 40.7, 0.15), (-73.8, 40.8, 0.95)]  # header skipped, edge and outside points dropped
    pairs = spark.createDataFrame([(10.0, 0.1), (70.0, 0.1), (10.0, 0.3), (0.0, 0.22)], "fare double, dist double")
    p = scratch_path(spark, "pairs-export")
    pairs.coalesce(1).write.option("header", True).csv(p)
    got = sorted(tuple(r) for r in jobs.distance_fare_from_export(spark, p).collect())
    assert got == [(0.0, 0.22), (10.0, 0.1)]


def test_meter_exactly_on_the_box_edge_is_kept(spark):
    from metrolens.operators import proximity
    meters = spark.createDataFrame([("1", "POINT (-73.5 40.75)"), ("2", "POINT (-73.25 40.75)")], "MeterNo string, the_geom string")
    tickets = spark.createDataFrame([("1",), ("2",)], "MeterNo string")
    got = {r.MeterNo: r["count"] for r in proximity.meters_near(tickets, meters, -74.0, 40.75, 0.5).collect()}
    assert got == {"1": 1}  # |x - cx| == 0.5 exactly is inside (inclusive); 0.75 is outside


def test_ticket_csv_with_extra_columns_in_any_order(spark):
    from metrolens.sources import load_parking_tickets
    d = _local(scratch_path(spark, "tickets-wide"))
    os.makedirs(d)
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("Summons Number,Meter Number,Violation Time,Street Name,Issuer Code,House Number,Plate Id,Issue Date,Extra\n")
        f.write("1,123-4567,0623A,MAIN ST,12,40,ABC,08/04/2013,x\n")
        f.write("2,,1159P,MAIN ST,abc,7A,DEF,13/45/2013,y\n")
    rows = sorted(tuple(r) for r in load_parking_tickets(spark, d).collect())
    assert rows == [("ABC", "08/04/2013", "MAIN ST", "40", "0623A", 12, "123-4567"),
                    ("DEF", "13/45/2013", "MAIN ST", "7A", "1159P", None, None)]
