import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from metrolens import constants as K
from metrolens.functions import geometry
from metrolens.operators import density, hull, mapping, ranks
from metrolens.session import scratch_path
from metrolens.sources import geojson


def np_pixel(lat, lon):
    siny = np.clip(np.sin(np.asarray(lat) * np.pi / 180), -K.MAX_SIN_LAT, K.MAX_SIN_LAT)
    return (K.TILE_SIZE * (0.5 + np.asarray(lon) / 360),
            K.TILE_SIZE * (0.5 - np.log((1 + siny) / (1 - siny)) / (4 * np.pi)))


def np_zoom(lats, lons, size=K.MAX_SIZE):
    x0, y0 = np_pixel(min(lats), min(lons))
    x1, y1 = np_pixel(max(lats), max(lons))
    amp = max(abs(x1 - x0) * 2.0, abs(y1 - y0))
    if amp == 0 or np.isnan(amp):
        return K.DEFAULT_ZOOM
    return int(np.log2(2 * size / amp))


POINTS = [(40.70, -74.00), (40.80, -73.90), (40.75, -73.95), (40.72, -73.99), (40.78, -73.91)]


def _pts(spark, rows=POINTS):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "point_id int, latitude double, longitude double")


def test_mercator_matches_numpy(spark):
    rows = [(0.0, 0.0), (89.99, 179.0), (-90.0, -180.0), (40.7, -74.0)]
    df = geometry.mercator_pixels(_pts(spark, rows)).orderBy("point_id").collect()
    ex, ey = np_pixel([r[0] for r in rows], [r[1] for r in rows])
    assert np.allclose([r.x_pixel for r in df], ex, rtol=0, atol=1e-9)
    assert np.allclose([r.y_pixel for r in df], ey, rtol=0, atol=1e-9)


def test_zoom_and_tile_pixels(spark):
    out = mapping.fit_to_map(_pts(spark)).orderBy("point_id").collect()
    lats, lons = [p[0] for p in POINTS], [p[1] for p in POINTS]
    z = np_zoom(lats, lons)
    assert all(r.zoom == z for r in out)
    clat, clon = (max(lats) + min(lats)) / 2, (max(lons) + min(lons)) / 2
    cx, cy = np_pixel(clat, clon)
    px, py = np_pixel(lats, lons)
    ex = K.SCALE * ((px - cx) * 2 ** z + K.MAX_SIZE / 2)
    ey = K.SCALE * ((py - cy) * 2 ** z + K.MAX_SIZE / 2)
    assert np.allclose([r.x_pixel for r in out], ex, atol=1e-6)
    assert np.allclose([r.y_pixel for r in out], ey, atol=1e-6)


def test_single_point_zoom_falls_back(spark):
    out = mapping.fit_to_map(_pts(spark, [(40.7, -74.0)])).first()
    assert out.zoom == K.DEFAULT_ZOOM
    assert out.x_pixel == K.SCALE * K.MAX_SIZE / 2


def test_nan_points_dropped_and_center_appended(spark):
    rows = POINTS + [(float("nan"), -74.0)]
    s = mapping.scatter_data(_pts(spark, rows), center=(40.9, -74.1)).collect()
    assert len(s) == len(POINTS) + 1
    center = [r for r in s if r.is_center]
    assert len(center) == 1 and center[0].latitude == 40.9
    lats = [p[0] for p in POINTS] + [40.9]
    lons = [p[1] for p in POINTS] + [-74.1]
    assert s[0].zoom == np_zoom(lats, lons)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=2000)
    y = rng.uniform(-3, 7, size=2000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    out = density.histogram_2d(df, "x", "y", bins=16).collect()
    got = np.zeros((16, 16), dtype=int)
    for r in out:
        got[r.x_bin, r.y_bin] = r["count"]
    exp, _, _ = np.histogram2d(x, y, bins=(16, 16))
    assert (got == exp.astype(int)).all()
    imax = int(np.argmax(x))
    assert got[15].sum() >= 1 and exp[15].sum() >= 1 and x[imax] == x.max()


def dense_reflect_gaussian(img, sigma, truncate=K.GAUSS_TRUNCATE):
    r = int(truncate * sigma + 0.5)
    offs = np.arange(-r, r + 1)
    w = np.exp(-0.5 / sigma ** 2 * offs ** 2)
    w /= w.sum()
    out = img.astype(float)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r, r)
        p = np.pad(out, pad, mode="symmetric")
        acc = np.zeros_like(out)
        n = out.shape[axis]
        for j, wj in zip(offs, w):
            sl = [slice(None), slice(None)]
            sl[axis] = slice(r + j, r + j + n)
            acc += wj * p[tuple(sl)]
        out = acc
    return out


def test_gaussian_smooth_equals_dense(spark):
    rng = np.random.default_rng(1)
    n = 12
    img = np.zeros((n, n))
    for _ in range(40):
        img[rng.integers(0, n), rng.integers(0, n)] += rng.uniform(0.5, 3)
    cells = [(int(i), int(j), float(img[i, j])) for i, j in zip(*np.nonzero(img))]
    df = spark.createDataFrame(cells, "iy int, ix int, z double")
    for sigma in (1.0, 2.0, 4.0):  # sigma 4 -> radius 16 > n: several mirror folds
        out = density.gaussian_smooth(df, n, sigma).collect()
        got = np.zeros((n, n))
        for r in out:
            got[r.iy, r.ix] = r.z
        assert np.allclose(got, dense_reflect_gaussian(img, sigma), atol=1e-12)


def test_grid_and_smoothed_density(spark):
    px = spark.createDataFrame([(10.0, 10.0), (10.4, 10.2), (600.0, 300.0), (-0.5, 5.0), (5000.0, 1.0)],
                               "x_pixel double, y_pixel double")
    cells = density.grid_cells(px, resolution=64).collect()
    k, w = 63 / 1280, 1
    exp = {}
    for x, y in [(10.0, 10.0), (10.4, 10.2), (600.0, 300.0), (-0.5, 5.0)]:
        key = (int(y * k) + w, int(x * k) + w)
        exp[key] = exp.get(key, 0) + 1.0
    assert {(r.iy, r.ix): r.z for r in cells} == exp
    sm = density.smoothed_density(px, resolution=64).collect()
    assert all(r.z > K.BLANK_THRESH and 0 <= r.iy < 64 and 0 <= r.ix < 64 for r in sm)


def _inside_or_on(poly, p):
    n = len(poly)
    for i in range(n):
        a, b = poly[i], poly[(i + 1) % n]
        if (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) < -1e-9:
            return False
    return True


def chain(points):
    """Andrew's monotone chain, point by point."""
    pts = sorted(set(map(tuple, points)))

    def half(seq):
        out = []
        for p in seq:
            while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out
    return pts if len(pts) < 3 else half(pts)[:-1] + half(pts[::-1])[:-1]


def test_hull_vertices_of_many_clusters_at_once():
    rng = np.random.default_rng(8)
    cluster = rng.integers(0, 300, 4000)
    x, y = rng.integers(0, 12, 4000).astype(float), rng.integers(0, 12, 4000).astype(float)  # many ties and collinear points
    n = rng.integers(1, 5, 4000)
    c, hx, hy, hn = hull.hull_vertices(cluster, x, y, n)
    for k in range(300):
        own = cluster == k
        assert list(zip(hx[c == k], hy[c == k])) == chain(zip(x[own], y[own]))
        assert hn[c == k].sum() == n[own].sum()


def test_hull_of_a_chain_that_thins_one_point_a_round():
    x = np.arange(400.0)
    y = x * x
    x, y = np.append(x, 400.0), np.append(y, -1.0)
    zero = np.zeros(len(x), np.int64)
    _, hx, hy, hn = hull.hull_vertices(zero, x, y, zero + 1)
    assert list(zip(hx, hy)) == chain(zip(x, y)) and hn[0] == 401


def test_hulls_with_full_buffers(spark):
    rng = np.random.default_rng(9)
    rows = [(int(c), float(x), float(y)) for c, (x, y) in zip(rng.integers(0, 40, 6000), rng.normal(size=(6000, 2)))]
    rows += [(99, float(np.cos(a)), float(np.sin(a))) for a in np.linspace(0, 6, 700)]  # all are vertices: state is passed on
    df = spark.createDataFrame(rows, "cluster int, x_pixel double, y_pixel double").repartition(3)
    size, hull.BUFFER_ROWS = hull.BUFFER_ROWS, 256
    try:
        got = {}
        for r in hull.cluster_hulls(df, fan_in=3).collect():
            got.setdefault(r.cluster, []).append((r.vertex, r.x, r.y, r.n_points))
    finally:
        hull.BUFFER_ROWS = size
    for k in {r[0] for r in rows}:
        own = [(x, y) for c, x, y in rows if c == k]
        assert [v[1:3] for v in sorted(got[k])] == chain(own) and {v[3] for v in got[k]} == {len(own)}


def test_hulls_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(5):
        pts = rng.normal(loc=c * 10, scale=3, size=(400, 2))
        rows += [(c, float(x), float(y)) for x, y in pts]
    rows += [(7, 0.0, 0.0)]                                   # 1 point
    rows += [(8, 0.0, 0.0), (8, 1.0, 1.0)]                    # 2 points
    rows += [(9, 0.0, 0.0), (9, 1.0, 1.0), (9, 2.0, 2.0)]     # collinear
    rows += [(10, 0.0, 0.0), (10, 1.0, 0.0), (10, 0.0, 1.0)]  # triangle
    df = spark.createDataFrame(rows, "cluster int, x_pixel double, y_pixel double").repartition(6)
    out = hull.cluster_hulls(df, fan_in=4).collect()
    by_c = {}
    for r in out:
        by_c.setdefault(r.cluster, []).append((r.vertex, r.x, r.y))
    assert set(by_c) == {0, 1, 2, 3, 4, 10}
    for c, verts in by_c.items():
        poly = [(x, y) for _, x, y in sorted(verts)]
        pts = [(x, y) for cc, x, y in rows if cc == c]
        assert all(_inside_or_on(poly, p) for p in pts)
        assert all(v in set(pts) for v in poly)
        for i in range(len(poly)):  # strictly convex: no collinear vertex
            a, b, d = poly[i - 1], poly[i], poly[(i + 1) % len(poly)]
            assert (b[0] - a[0]) * (d[1] - a[1]) - (b[1] - a[1]) * (d[0] - a[0]) > 0
        # same hull as one pass over all points of the cluster
        ref = chain(pts)
        assert sorted(map(tuple, ref)) == sorted(poly)


def test_positions_are_global_and_total(spark):
    rng = np.random.default_rng(6)
    rows = [(int(v), i) for i, v in enumerate(rng.integers(0, 50, 3000))]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = {(r.a, r.b): r.position for r in ranks.with_position(df, [F.col("a").desc(), F.col("b")]).collect()}
    assert [got[k] for k in sorted(rows, key=lambda r: (-r[0], r[1]))] == list(range(3000))
    plan = hull.cluster_ranks(df.withColumnRenamed("a", "cluster"))._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_cluster_ranks(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (7,)], "cluster int")
    got = {r.cluster: r.color_rank for r in hull.cluster_ranks(df).collect()}
    assert got == {1: 2, 3: 1, 7: 0}


def test_line_chunks_hold_all_points_in_order(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(q), 40.0 + float(v), -74.0) for k, q, v in zip(rng.integers(0, 9, 900), rng.integers(0, 200, 900), rng.random(900))]
    rows += [(50, i, 40.5, -74.0 + i / 1e4) for i in range(600)] + [(None, 1, 40.1, -74.0), (None, 0, 40.2, -74.0)]
    df = spark.createDataFrame(rows, "line_id int, seq int, latitude double, longitude double").repartition(4)
    overlay = mapping.line_overlay(df)
    want = {}
    for r in overlay.collect():
        want.setdefault(r.line_id, []).append((r.seq, r.x_pixel, r.y_pixel))
    got = {}
    for r in mapping.line_chunks(overlay, chunk_points=7).collect():
        got.setdefault(r.line_id, {})[r.chunk] = [tuple(p) for p in r.points]
    for k, points in want.items():
        chunks = [got[k][i] for i in range(len(got[k]))]
        assert [len(c) for c in chunks[:-1]] == [7] * (len(chunks) - 1)
        assert sum(chunks, []) == sorted(points)
    assert mapping.line_chunks(overlay.limit(0)).collect() == []


def test_density_sums_do_not_depend_on_order(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(y), float(v)) for x, y, v in zip(rng.integers(0, 40, 3000), rng.integers(0, 40, 3000), rng.normal(size=3000) * 10.0 ** rng.integers(-3, 6, 3000))]
    rows += [(1.0, 1.0, math.nan), (1.0, 1.0, None), (1.0, 1.0, math.inf)]
    df = spark.createDataFrame(rows, "x_pixel double, y_pixel double, v double")
    runs = [sorted(map(tuple, density.grid_cells(df.repartition(n), value_col="v", size=40, resolution=16).collect())) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2]
    assert sum(z for _, _, z in runs[0]) == pytest.approx(sum(round(v, 6) for _, _, v in rows[:-3]), rel=1e-9)


def test_line_overlay_order(spark):
    rows = [(1, 2, 40.71, -74.0), (1, 1, 40.70, -74.01), (1, 3, 40.72, -73.99), (2, 1, 40.80, -73.9), (2, 2, 40.81, -73.95)]
    df = spark.createDataFrame(rows, "line_id int, seq int, latitude double, longitude double")
    lines = mapping.line_overlay(df)
    arrays = {r.line_id: r.points for r in mapping.line_arrays(lines).collect()}
    assert [p.seq for p in arrays[1]] == [1, 2, 3] and [p.seq for p in arrays[2]] == [1, 2]
    px = {(r.line_id, r.seq): (r.x_pixel, r.y_pixel) for r in mapping.fit_to_map(df).collect()}
    ends = {r.line_id: r for r in mapping.line_endpoints(lines).collect()}
    assert ends[1].n_points == 3 and (ends[1].first.x, ends[1].first.y) == px[(1, 1)]
    assert (ends[2].last.x, ends[2].last.y) == px[(2, 2)]
    flat = [(r.line_id, r.seq) for r in lines.collect()]
    assert flat == sorted(flat)


def test_geojson_feature_collection(spark):
    path = scratch_path(spark, "geojson-test")
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "MultiLineString", "coordinates": [[[-74.0, 40.7], [-73.9, 40.8]]]}},
        {"type": "Feature", "geometry": {"type": "MultiLineString",
                                         "coordinates": [[[-73.0, 41.0]], [[-72.0, 42.0], [-71.0, 43.0]]]}},
    ]}
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "streets.geojson"), "w") as f:
        json.dump(doc, f, indent=2)
    pts = geojson.read_street_points(spark, path, multiline=True).orderBy("feature_id", "point_index").collect()
    assert [(r.feature_id, r.point_index, r.x, r.y) for r in pts] == [
        (0, 0, -74.0, 40.7), (0, 1, -73.9, 40.8), (1, 0, -73.0, 41.0)]  # only the first line counts


def test_marker_check(spark):
    from metrolens.operators import cleaning
    df = spark.createDataFrame([(1, 40.0, -74.0), (2, float("nan"), -74.0), (3, None, -73.0), (4, 41.0, None)],
                               "id int, latitude double, longitude double")
    out = cleaning.check_markers(df).collect()
    assert [(r.id, r.dropped) for r in out] == [(1, 3)]
    try:
        cleaning.valid_markers(df.drop("latitude"))
        raise AssertionError("expected KeyError")
    except KeyError:
        pass


def test_degree_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 3.0, 4.0)], "a double, b double, c double, d double")
    assert math.isclose(df.select(geometry.degree_distance("a", "b", "c", "d").alias("x")).first().x, 5.0)
    assert F is not None


def test_smoothing_keeps_the_total_on_the_padded_grid(spark):
    rng = np.random.default_rng(7)
    px = spark.createDataFrame([(float(x), float(y)) for x, y in rng.uniform(0, 1280, size=(3000, 2))],
                               "x_pixel double, y_pixel double")
    cells = density.grid_cells(px, resolution=96)
    n = 96 + 2 * density.default_window(96)
    total = cells.agg(F.sum("z")).first()[0]
    smoothed = density.gaussian_smooth(cells, n, float(density.default_window(96))).agg(F.sum("z")).first()[0]
    assert total == 3000.0 and math.isclose(smoothed, total, rel_tol=1e-12)
