"""Exact quantile cuts, key-hash samples and splits, repeatable k-means, counted rejects, number parsing."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metrolens.operators import cleaning, interval_join, ml
from metrolens.operators.quantiles import exact_cuts


def cuts_by_hand(values, buckets):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    return sorted({v[-(-i * len(v) // buckets) - 1] for i in range(1, buckets)}) if v else []


@pytest.mark.parametrize("bins", [2, 16, 512])
def test_exact_cuts(spark, bins):
    rng = np.random.default_rng(0)
    cols = {
        "normal": rng.normal(size=900), "ties": rng.integers(0, 4, 900).astype(float), "hot": np.where(rng.random(900) < 0.4, 7.0, rng.random(900)),
        "wide": rng.choice([-1.7e308, 1.7e308, 5e-324, 0.0, 1.0, math.nan], 900), "ends": np.where(rng.random(900) < 0.3, -math.inf, np.where(rng.random(900) < 0.3, math.inf, rng.random(900))),
        "close": 1.0 + rng.integers(0, 50, 900) * 2.0**-52,
    }
    if bins == 2:
        cols = {k: cols[k] for k in ("ties", "hot")}
    rows = [tuple(None if i % 97 == 0 else float(c[i]) for c in cols.values()) for i in range(900)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = exact_cuts(df, list(cols), 10, bins)
    for k, c in enumerate(cols):
        assert got[c] == cuts_by_hand([r[k] for r in rows], 10), c


def test_exact_cuts_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, math.nan)], "a double, b double")
    assert exact_cuts(df, ["a", "b"], 4) == {"a": [], "b": [1.0]}
    assert exact_cuts(df.limit(0), ["a"], 4) == {"a": []}
    assert [r.a_bucket for r in ml.quantile_buckets(df, ["a"], 4).collect()] == [None, None]
    assert [r.b_bucket for r in ml.quantile_buckets(df.where("isnan(b)"), ["b"], 4).collect()] == [1.0]  # the bucket of NaN


def test_quantile_buckets_count_the_cuts_below(spark):
    rng = np.random.default_rng(2)
    values = [float(v) for v in rng.integers(0, 60, 500)] + [math.nan, None]
    out = ml.quantile_buckets(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], num_buckets=8).collect()
    cuts = cuts_by_hand(values, 8)
    for r in out:
        assert r.v_bucket == (None if r.v is None else len(cuts) + 1 if math.isnan(r.v) else sum(c <= r.v for c in cuts))


def share(seed, *key):
    text = "|".join([str(seed), *[str(k) for k in key if k is not None]])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


def test_samples_and_splits_follow_the_key(spark):
    rows = [(i % 400, i // 400) for i in range(2000)] + [(None, 3)]
    df = spark.createDataFrame(rows, "a long, b int")
    want = sorted((r for r in rows if share(7, *r) < 0.3), key=str)
    for parts in (1, 5):
        assert sorted(map(tuple, ml.maybe_sample(df.repartition(parts), 0.3, 7, ["a", "b"]).collect()), key=str) == want
    first, second = ml.split(df, 5, (0.7, 0.3), ["a", "b"])
    assert sorted(map(tuple, first.collect()), key=str) == sorted((r for r in rows if share(5, *r) < 0.7), key=str)
    assert first.count() + second.count() == len(rows)
    assert ml.maybe_sample(df, None, 7, ["a"]) is df


def lloyd(points, k, rounds=10):
    whole = [tuple(math.floor(c * 1e6 + 0.5) for c in p) for p in points]
    centres = sorted(set(whole), key=lambda p: (hashlib.md5("|".join(["1", *map(str, p)]).encode()).hexdigest(), p))[:k]
    centres = [tuple(map(float, c)) for c in centres]
    near = lambda p: min(range(len(centres)), key=lambda i: (sum((a - b) * (a - b) for a, b in zip(map(float, p), centres[i])), i))
    sizes = [0] * len(centres)
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for p in whole:
            groups[near(p)].append(p)
        sizes = [len(g) for g in groups]
        moved = [tuple(float(sum(c)) / len(g) for c in zip(*g)) if g else centres[i] for i, g in enumerate(groups)]
        if moved == centres:
            break
        centres = moved
    return [(i, *[x / 1e6 for x in c], n) for i, (c, n) in enumerate(zip(centres, sizes))]


def test_a_round_makes_no_struct_for_a_centre(spark):
    """Distances are plain doubles; sums of whole numbers beyond a long's range are exact."""
    far = [(2.0**42 + i, -(2.0**42) - i) for i in range(40)]
    df = spark.createDataFrame(far, "x double, y double")
    (row,) = ml.repeatable_centres(df, ["x", "y"], k=1).collect()
    parts = [sum(int(v[j] * ml.K.COORDINATE_SCALE) for v in far) for j in range(2)]
    assert max(map(abs, parts)) > 2**63
    assert (row.x, row.y, row.rows) == (*(float(p) / 40 / ml.K.COORDINATE_SCALE for p in parts), 40)
    near = ml._with_nearest(df, ["x", "y"], [(0.0, 0.0), (2.0**42, -(2.0**42)), (2.0**42, -(2.0**42))], "c")
    assert {r.c for r in near.collect()} == {1}
    assert "struct" not in near._jdf.queryExecution().toString().lower()


def test_repeatable_centres_equal_lloyds_rounds(spark):
    rng = np.random.default_rng(3)
    points = [tuple(map(float, p)) for p in np.round(rng.normal(size=(300, 2)) + rng.integers(0, 4, 300)[:, None], 2)] + [(1.0, 1.0)] * 40
    df = spark.createDataFrame([*points, (None, 1.0), (math.nan, 2.0)], "x double, y double")
    for parts in (1, 4):
        centres = ml.repeatable_centres(df.repartition(parts), ["x", "y"], k=6)
        got = sorted(map(tuple, centres.collect()))
        assert got == lloyd(points, 6)
    out = ml.nearest_centre(df, ["x", "y"], centres, "c").collect()
    for r in out:
        if r.x is None or math.isnan(r.x):
            assert r.c is None
        else:
            d = [(r.x - c[1]) ** 2 + (r.y - c[2]) ** 2 for c in got]
            assert d[r.c] <= min(d) + 1e-9
    few = ml.repeatable_centres(spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "x double, y double"), ["x", "y"], k=3)
    assert list(map(tuple, few.collect())) == [(0, 1.0, 2.0, 2)]
    assert ml.nearest_centre(df.limit(0), ["x", "y"], ml.repeatable_centres(df.limit(0), ["x", "y"])).collect() == []


def test_least_squares_metrics_hold_for_large_values(spark):
    p = [1e8 + x for x in (1.0, 3.0, 5.0)]
    y = [1e8 + x for x in (2.0, 3.5, 4.0)]
    m = ml.regression_metrics(spark.createDataFrame(list(zip(p, y)), "prediction double, label double")).first()
    assert m.rmse == pytest.approx(0.866025, abs=1e-6) and m.explained_variance == pytest.approx(2.694444, abs=1e-6)


RIDES = [
    (1, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 30, 3, 4, "A"), (2, "2013-13-45", "01/02/2013 09:30:00", 30, 3, 4, "A"),
    (3, "01/02/2013 09:00:00", None, 30, 3, 4, "A"), (4, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 0, 3, 4, "A"),
    (5, None, None, None, 3, 4, "A"), (6, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 30, -1, 4, "A"),
    (7, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 30, 3, None, "A"), (8, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 30, 3, 4, "  "),
    (9, "01/02/2013 09:00:00", "01/02/2013 09:30:00", 30, 3, 4, None),
]


def test_bike_rejects_are_the_rides_that_cleaning_drops(spark):
    df = spark.createDataFrame(RIDES, "id int, starttime string, stoptime string, duration int, startId int, endId int, endName string")
    reasons = {r.id: r.reject_reason for r in cleaning.with_bike_reject_reason(df).collect()}
    assert reasons == {1: None, 2: "start time", 3: "stop time", 4: "duration", 5: "duration", 6: "start station", 7: "end station", 8: "end name", 9: "end name"}
    assert {r.id for r in cleaning.clean_bike_trips(df).collect()} == {i for i, r in reasons.items() if r is None}
    counts = dict(map(tuple, cleaning.reject_counts(cleaning.with_bike_reject_reason(df)).collect()))
    assert counts["kept"] == 1 and sum(counts.values()) == len(RIDES)


def test_fit_rejects_are_the_rows_that_labeled_drops(spark):
    df = spark.createDataFrame([(1, 5.0, 0.1), (2, None, 0.1), (3, math.nan, None), (4, 5.0, math.nan), (5, 6.0, None)], "id int, fare double, distance double")
    reasons = {r.id: r.why for r in df.withColumn("why", ml.fit_reject_reason("fare", ["distance"])).collect()}
    assert reasons == {1: None, 2: "unusable fare", 3: "unusable fare", 4: "unusable distance", 5: "unusable distance"}
    assert [r.id for r in ml.labeled(df, "fare", ["distance"], ["id"]).collect()] == [1]


def test_whole_numbers_from_text(spark):
    df = spark.createDataFrame([("100.0",), ("7D",), ("12",), (" 12 ",), ("7A",), (None,), ("12.9",), ("99999999999",), ("1e2",)], "v string")
    got = [r.n for r in df.select(interval_join.whole_number("v").alias("n")).collect()]
    assert got[:3] == [100, None, 12] and got[4:8] == [None, None, 12, None]
    tickets = spark.createDataFrame([("X", "100.0"), ("X", "7D"), ("X", "150")], "StreetName string, HouseNumber string")
    segment = [(1, "90", "110", None, None, "X", "g")]
    segments = spark.createDataFrame(segment, "PHYSICALID int, L_LOW_HN string, L_HIGH_HN string, R_LOW_HN string, R_HIGH_HN string, ST_LABEL string, the_geom string")
    assert [r["count"] for r in interval_join.tickets_per_segment(tickets, segments).collect()] == [1]


def test_null_longitude_passes_a_latitude_bound(spark):
    df = spark.createDataFrame([(1, 40.0, None), (2, 50.0, -74.0), (3, None, -74.0)], "id int, latitude double, longtitude double")
    assert [r.id for r in cleaning.coordinate_bounds(df).collect()] == [1]
    assert cleaning.coordinate_bounds(df, lon_min=-80.0).where(F.col("id") == 1).count() == 0
