import glob
import json
import math
import os

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from metrolens import sinks
from metrolens.operators import cleaning, ml, temporal
from metrolens.session import scratch_path
from metrolens.sources import read_csv, read_csv_by_position

from .conftest import SF_SMALL


def test_regression_metrics_pinned(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.5), (5.0, 4.0)], "prediction double, label double")
    r = ml.regression_metrics(df).first()
    assert math.isclose(r.rmse, 0.866025, abs_tol=1e-6)
    assert math.isclose(r.explained_variance, 2.694444, abs_tol=1e-6)


def test_linear_fit_matches_lstsq(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 0.2, 500)
    y = 3.0 + 140.0 * x + rng.normal(0, 1, 500)
    df = spark.createDataFrame(pd.DataFrame({"distance": x, "fare_amount": y}))
    m = ml.fit_linear(ml.labeled(df, "fare_amount", ["distance"]), fit_intercept=True)
    b, a = np.polyfit(x, y, 1)
    assert math.isclose(m.coefficients[0], b, rel_tol=1e-9) and math.isclose(m.intercept, a, rel_tol=1e-9)
    m0 = ml.fit_linear(ml.labeled(df, "fare_amount", ["distance"]), fit_intercept=False)
    b0 = float(np.linalg.lstsq(x.reshape(-1, 1), y, rcond=None)[0][0])
    assert math.isclose(m0.coefficients[0], b0, rel_tol=1e-9) and m0.intercept == 0.0


def test_kmeans_labels(spark):
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.normal(c, 0.01, size=(50, 2)) for c in range(6)])
    df = spark.createDataFrame(pd.DataFrame({"pickup_latitude": pts[:, 0], "pickup_longitude": pts[:, 1]}))
    _, out = ml.kmeans_clusters(df.coalesce(1), ["pickup_latitude", "pickup_longitude"], k=6)
    labels = [r.predction_pickup for r in out.collect()]
    assert len(labels) == 300 and set(labels) <= set(range(6))


def test_quantile_splits_exact_vs_duckdb(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    b = ml.quantile_buckets(li, ["l_extendedprice"], num_buckets=10, relative_error=0.0)
    got = b.groupBy("l_extendedprice_bucket").agg(F.min("l_extendedprice").alias("lo")).orderBy("lo").collect()
    lows = [r.lo for r in got][1:]
    con = duckdb.connect()
    qs = con.execute(f"select quantile_disc(l_extendedprice, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) "
                     f"from '{SF_SMALL}/lineitem.parquet'").fetchone()[0]
    assert lows == sorted(lows)
    # each bucket starts at the smallest value >= its split
    assert lows == [con.execute(f"select min(l_extendedprice) from '{SF_SMALL}/lineitem.parquet' "
                                f"where l_extendedprice >= {q}").fetchone()[0] for q in sorted(set(qs))]


def test_fare_regressions_run(spark):
    rng = np.random.default_rng(9)
    n = 600
    pdf = pd.DataFrame({
        "pickup_latitude": rng.uniform(40.61, 40.89, n), "pickup_longitude": rng.uniform(-74.04, -73.76, n),
        "dropoff_latitude": rng.uniform(40.61, 40.89, n), "dropoff_longitude": rng.uniform(-74.04, -73.76, n)})
    pdf["fare_amount"] = 2.5 + 100 * np.hypot(pdf.pickup_latitude - pdf.dropoff_latitude,
                                              pdf.pickup_longitude - pdf.dropoff_longitude)
    df = spark.createDataFrame(pdf)
    for fn in (ml.fare_regression_distance, ml.fare_regression_buckets, ml.fare_regression_clusters):
        kwargs = {"num_buckets": 10} if fn is ml.fare_regression_buckets else {}
        r = fn(df, seed=3, **kwargs)
        m = r.metrics.first()
        assert m.test_n + m.train_n > 0 and m.test_rmse >= 0 and m.train_rmse >= 0
    r = ml.fare_regression_distance(df, seed=3)
    assert r.metrics.first().train_rmse < 1e-6  # exact linear relation inside the window


def test_taxi_filters(spark):
    rows = [
        (40.7, -74.0, 40.75, -73.9, 10.0),     # kept
        (0.0, -74.0, 40.75, -73.9, 10.0),      # zero coordinate
        (40.6, -74.0, 40.75, -73.9, 10.0),     # on the box edge: excluded
        (40.7, -74.0, 40.75, -73.9, 0.0),      # fare 0 excluded
        (40.7, -74.0, 40.75, -73.9, 60.0),     # fare 60 excluded
        (40.7, -74.0, 40.7, -74.0, 10.0),      # distance 0 excluded
        (40.7, -74.0, 40.7, -73.78, 10.0),     # distance 0.22 excluded
    ]
    df = spark.createDataFrame(rows, "pickup_latitude double, pickup_longitude double, dropoff_latitude double, "
                                     "dropoff_longitude double, fare_amount double")
    out = cleaning.fare_distance_window(cleaning.with_trip_distance(cleaning.within_nyc(cleaning.drop_zero_coordinates(df))))
    assert out.count() == 1


def test_bikes_and_seasons(spark):
    rows = [(f"{m:02d}/15/2016 {h:02d}:05:00", f"{m:02d}/15/2016 {h:02d}:35:00", d, 1, 2, n, "a", "M", "1980", "S")
            for m, h, d, n in [(1, 9, 300, "X"), (4, 10, 300, "X"), (7, 17, 300, "X"), (10, 18, 300, "X"),
                               (12, 9, 0, "X"), (6, 9, 300, ""), (6, 9, None, "X")]]
    df = spark.createDataFrame(rows, "starttime string, stoptime string, duration int, startId int, endId int, "
                                     "endName string, address string, gender string, `birth year` string, usertype string")
    out = temporal.with_season_and_time_of_day(cleaning.clean_bike_trips(df))
    got = sorted((r.month, r.startHour, r.season, r.time_of_day) for r in out.collect())
    assert got == [(1, 9, "winter", "morning"), (4, 10, "spring", "midday"), (7, 17, "summer", "midday"),
                   (10, 18, "fall", "evening")]
    assert "gender" not in out.columns and "birth year" not in out.columns


def test_monthly_trips_null_keys(spark):
    import datetime as dt
    rows = [(dt.datetime(2015, 1, 1, 0, 5), 1.0), (dt.datetime(2016, 1, 2, 23, 0), 3.0), (None, 5.0),
            (dt.datetime(2016, 1, 3, 1, 0), None)]
    df = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp, trip_distance double")
    out = [tuple(r) for r in temporal.monthly_trips(df).collect()]
    assert out == [(2015, 1, 1.0, 1), (2016, 1, 3.0, 2)]
    assert temporal.midnight_trips(df).count() == 1


def test_csv_sinks_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", [1.5, 2.0]), (2, "b", [3.0])], "id int, name string, pts array<double>")
    p1 = scratch_path(spark, "k1")
    sinks.write_csv(df, p1)
    back = read_csv(spark, p1, "id int, name string, pts string", header=False).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a", "1.5,2.0"), (2, "b", "3.0")]
    p2 = scratch_path(spark, "k2")
    sinks.write_csv(df.drop("pts"), p2, header=True)
    pos = read_csv_by_position(spark, p2, {0: "id"}).orderBy("id").collect()
    assert [r.id for r in pos] == [1.0, 2.0]
    p3 = scratch_path(spark, "k3")
    days = spark.createDataFrame([(g, d, c) for g in ("G1", "G2") for d, c in ((1, 5), (7, 2))],
                                 "the_geom string, day_of_week int, count long")
    sinks.write_partitioned_csv(days, p3, ["day_of_week"])
    local = p3.replace("file:", "")
    assert sorted(os.path.basename(d) for d in glob.glob(local + "/day_of_week=*")) == ["day_of_week=1", "day_of_week=7"]


def test_series_json(spark):
    df = spark.createDataFrame([(13, 5), (0, 2), (7, 1)], "hour int, tickets long")
    rec = sinks.series_record(df, "hour", "tickets").first()
    assert rec["keys"] == [0, 7, 13] and rec["values"] == [2, 1, 5]
    p = scratch_path(spark, "k5")
    sinks.write_series_json(df, "hour", "tickets", p)
    files = glob.glob(p.replace("file:", "") + "/*.json")
    data = [json.loads(line) for f in files for line in open(f) if line.strip()]
    assert data == [{"keys": [0, 7, 13], "values": [2, 1, 5]}]


def test_sketch_splits_within_the_error_bound(spark):
    from pyspark.ml.feature import QuantileDiscretizer

    from .conftest import SF_CHECK
    path = f"{SF_CHECK}/lineitem.parquet"
    li = spark.read.parquet(path)
    model = QuantileDiscretizer(numBuckets=10, inputCol="l_extendedprice", outputCol="b",
                                relativeError=0.001).fit(li)
    splits = model.getSplits()[1:-1]
    con = duckdb.connect()
    n = con.execute(f"select count(*) from '{path}'").fetchone()[0]
    assert splits == sorted(splits)
    for i, s in enumerate(splits, start=1):
        below = con.execute(f"select count(*) from '{path}' where l_extendedprice < {s!r}").fetchone()[0]
        at_or_below = con.execute(f"select count(*) from '{path}' where l_extendedprice <= {s!r}").fetchone()[0]
        target = i / 10 * n
        # some rank of the split value lies within the sketch's guarantee of the target rank
        assert below - 0.001 * n - 1 <= target <= at_or_below + 0.001 * n + 1
    # the registered query's buckets hold about a tenth of the rows each
    rows = [r.rows for r in __import__("metrolens.plans.registry", fromlist=["x"]).all_queries()["quantile_buckets"](
        spark, SF_CHECK).collect()]
    assert sum(rows) == n and all(abs(r - n / 10) <= 0.002 * n + 2 for r in rows)


def test_pickup_clusters_assign_nearest_centre(spark):
    from metrolens.plans import synthetic as syn

    from .conftest import SF_CHECK
    trips = syn.taxi_trips_from_events(spark, SF_CHECK)
    model, out = ml.kmeans_clusters(trips, ["pickup_latitude", "pickup_longitude"])
    centres = np.array([list(c) for c in model.clusterCenters()])
    pdf = out.select("pickup_latitude", "pickup_longitude", "predction_pickup").toPandas()
    assert len(centres) == 20 and pdf.predction_pickup.between(0, 19).all()
    pts = pdf[["pickup_latitude", "pickup_longitude"]].to_numpy()
    d = ((pts[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    best = d.min(axis=1)
    chosen = d[np.arange(len(pts)), pdf.predction_pickup.to_numpy()]
    assert np.allclose(chosen, best, rtol=0, atol=1e-12)


def test_distance_regression_split_and_least_squares(spark):
    from metrolens.plans import synthetic as syn

    from .conftest import SF_CHECK
    trips = syn.taxi_trips_from_lineitem(spark, SF_CHECK)
    r = ml.fare_regression_distance(trips, seed=7)
    tr = r.train.toPandas()
    te = r.test.toPandas()
    x = np.array([v[0] for v in tr.features])
    y = tr.label.to_numpy()
    b, a = np.polyfit(x, y, 1)
    assert math.isclose(r.model.coefficients[0], b, rel_tol=1e-8) and math.isclose(r.model.intercept, a, rel_tol=1e-8)
    m = r.metrics.first()
    assert m.train_n == len(tr) and m.test_n == len(te)
    window = cleaning.fare_distance_window(cleaning.with_trip_distance(cleaning.within_nyc(trips))).count()
    assert len(tr) + len(te) == window and 0.7 < len(tr) / window < 0.9
    xt = np.array([v[0] for v in te.features])
    rmse = float(np.sqrt(np.mean((a + b * xt - te.label.to_numpy()) ** 2)))
    assert math.isclose(m.test_rmse, rmse, rel_tol=1e-9)


def test_geocode_latitude_bound_is_strict(spark):
    from metrolens.operators import geocode
    trips = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "trip_id int, address string")
    pts = spark.createDataFrame([("A", 49.99, -74.0), ("B", 50.0, -74.0), ("C", 51.0, -74.0)],
                                "address string, latitude double, longtitude double")
    assert sorted(r.trip_id for r in geocode.geocode(trips, pts).collect()) == [1]  # 50 and above, and no match, drop
