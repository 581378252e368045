"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads whole synthetic tables through ``synthetic`` and runs the
library operators on them. Column names match the SQL in ``oracles.py``.
Doubles that pass through transcendental functions or floating sums are
rounded in the query (not in the operators) so both engines compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import geometry
from ..operators import cleaning, density, geocode, hull, mapping, ml, proximity, temporal
from ..operators import interval_join as ij
from ..session import scratch_path
from ..sources import geojson, readers, schemas
from ..streaming import tickets as ticket_stream
from . import synthetic as syn

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- parking


@register("tickets_per_segment")
def q_tickets_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A3: tickets per street segment (the flagship interval join)."""
    out = ij.tickets_per_segment(syn.tickets_from_lineitem(spark, sf_dir), syn.segments_from_supplier(spark, sf_dir))
    return out.select(F.col("PHYSICALID").alias("physical_id"), "the_geom", F.col("count").alias("tickets"))


@register("tickets_per_segment_day")
def q_tickets_per_segment_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A4: tickets per segment and ISO weekday, one job for all seven days."""
    tickets = temporal.with_ticket_weekday(syn.tickets_from_lineitem(spark, sf_dir), drop_invalid=False)
    out = ij.tickets_per_segment(tickets, syn.segments_from_supplier(spark, sf_dir), by=["day_of_week"])
    return out.select(F.col("PHYSICALID").alias("physical_id"), "the_geom", "day_of_week",
                      F.col("count").alias("tickets"))


@register("tickets_per_segment_hour")
def q_tickets_per_segment_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + A5: tickets per segment, hour (1-12) and AM/PM."""
    tickets = temporal.with_ticket_hour(syn.tickets_from_events(spark, sf_dir), drop_invalid=False)
    out = ij.tickets_per_segment(tickets, syn.segments_from_supplier(spark, sf_dir), by=["Hour", "AMPM"])
    return out.select(F.col("PHYSICALID").alias("physical_id"), "the_geom",
                      F.col("Hour").alias("hour12"), F.col("AMPM").alias("ampm"), F.col("count").alias("tickets"))


@register("tickets_by_hour")
def q_tickets_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets per hour of day, parsed from 'hhmmA' text."""
    return temporal.tickets_by_hour(syn.tickets_from_events(spark, sf_dir))


@register("tickets_by_weekday")
def q_tickets_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets per ISO weekday, parsed from MM/dd/yyyy text."""
    return temporal.tickets_by_weekday(syn.tickets_from_orders(spark, sf_dir))


@register("meters_near_point")
def q_meters_near_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets per meter in a box around a point."""
    out = proximity.meters_near(syn.meter_tickets_from_lineitem(spark, sf_dir), syn.meters_from_supplier(spark, sf_dir),
                                longitude=syn.METER_CENTER_X, latitude=syn.METER_CENTER_Y, min_range=syn.METER_RANGE)
    return out.select(F.col("MeterNo").alias("meter_no"), F.col("count").alias("tickets"),
                      F.col("Center_Lat").alias("center_lat"), F.col("Center_Long").alias("center_long"),
                      F.col("StringLatLon").alias("lat_lon_text"))


@register("wkt_points")
def q_wkt_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WKT point text to coordinates; malformed text gives NULL."""
    m = proximity.parse_meters(syn.meters_from_supplier(spark, sf_dir))
    return m.select(F.col("MeterNo").alias("meter_no"), "x", "y")


# ---------------------------------------------------------------- taxi


@register("monthly_trips")
def q_monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and mean distance per month, through the SQL view."""
    readers.register_trips(spark, syn.taxi_trips_from_lineitem(spark, sf_dir), view="trips")
    trips = readers.trips_projection(spark, ["tpep_pickup_datetime", "trip_distance"], view="trips")
    out = temporal.monthly_trips(trips)
    return out.select("year", "month", F.round("avg_distance", 6).alias("avg_distance"), "trips")


@register("midnight_trips")
def q_midnight_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: pickups in hour 0."""
    out = temporal.midnight_trips(syn.taxi_trips_from_events(spark, sf_dir))
    return out.select("event_id", "tpep_pickup_datetime", "pickup_longitude", "pickup_latitude")


@register("bbox_trips")
def q_bbox_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips inside the NYC box with fare and distance inside the regression window."""
    t = cleaning.drop_zero_coordinates(syn.taxi_trips_from_lineitem(spark, sf_dir))
    t = cleaning.fare_distance_window(cleaning.with_trip_distance(cleaning.within_nyc(t)))
    return t.select("l_orderkey", "l_linenumber", F.round("fare_amount", 6).alias("fare_amount"),
                    F.round("distance", 9).alias("distance"))


@register("plot_window")
def q_plot_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 + F18: (fare, distance) pairs of in-box trips cropped to the plot axes."""
    t = cleaning.with_trip_distance(cleaning.within_nyc(syn.taxi_trips_from_lineitem(spark, sf_dir)))
    t = cleaning.plot_window(ml.distance_fare_pairs(t))
    return t.select("l_orderkey", "l_linenumber", F.round("fare_amount", 6).alias("fare_amount"),
                    F.round("distance", 9).alias("distance"))


# ---------------------------------------------------------------- bikes


@register("geocode_join")
def q_geocode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + F16: rides joined to address points, latitude below 50."""
    out = geocode.geocode(syn.rides_from_customer(spark, sf_dir), syn.addresses_from_nation(spark, sf_dir))
    return out.select("trip_id", "routes", "address", "latitude", "longtitude")


def _clean_bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_bike_trips(syn.bike_trips_from_orders(spark, sf_dir))


@register("bike_clean")
def q_bike_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rides with month, year and start hour from the parsed start time."""
    b = _clean_bikes(spark, sf_dir)
    return b.select("trip_id", "duration", F.col("startId").alias("start_id"), F.col("endId").alias("end_id"),
                    F.col("endName").alias("end_name"), "month", "year", F.col("startHour").alias("start_hour"))


@register("bike_rejects")
def q_bike_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20 + F15: rides kept and dropped, by the reason they are dropped for."""
    b = syn.bike_trips_from_orders(spark, sf_dir)
    bad_time = F.when(F.col("trip_id") % 11 == 0, F.lit("2013-13-45")).otherwise(F.col("starttime"))
    return cleaning.reject_counts(cleaning.with_bike_reject_reason(b.withColumn("starttime", bad_time)))


@register("season_split")
def q_season_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides per season."""
    b = temporal.with_season_and_time_of_day(_clean_bikes(spark, sf_dir))
    return temporal.label_counts(b, "season", "rides")


@register("time_of_day_split")
def q_time_of_day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rides per time of day (morning < 10, evening > 17, midday otherwise)."""
    b = temporal.with_season_and_time_of_day(_clean_bikes(spark, sf_dir))
    return temporal.label_counts(b, "time_of_day", "rides")


@register("partitioned_csv")
def q_partitioned_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/K4 + S1: rides written as CSV partitioned by season in one job, read back and counted."""
    b = temporal.with_season_and_time_of_day(_clean_bikes(spark, sf_dir))
    path = scratch_path(spark, "season-csv")
    sinks.write_partitioned_csv(b.select("trip_id", "duration", "season"), path, ["season"], header=True)
    back = readers.read_csv(spark, path, "trip_id long, duration int, season string")
    return back.groupBy("season").agg(F.count(F.lit(1)).alias("rides"), F.sum("duration").alias("total_duration"))


# ---------------------------------------------------------------- map data

_R6 = 6


def _round(cols, digits=_R6):
    return [F.round(c, digits).alias(c) for c in cols]


@register("mercator_pixels")
def q_mercator_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World Web-Mercator pixels at zoom 0."""
    p = geometry.mercator_pixels(syn.world_points_from_events(spark, sf_dir))
    return p.select("event_id", *_round(["x_pixel", "y_pixel"]))


@register("tile_pixels")
def q_tile_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points fitted to one map tile (centre, auto zoom, pixels)."""
    p = mapping.fit_to_map(syn.map_points_from_events(spark, sf_dir))
    return p.select("point_id", *_round(["x_pixel", "y_pixel"]), "zoom")


@register("auto_zoom")
def q_auto_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + G4: bounds, centre and zoom of the point set (one row)."""
    f = mapping.map_frame(mapping.map_bounds(syn.map_points_from_events(spark, sf_dir)))
    return f.select(*_round(["lat_min", "lat_max", "lon_min", "lon_max", "center_lat", "center_long"]), "zoom")


@register("scatter_points")
def q_scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scatter data with colour = cluster / 20 and the centre marker appended."""
    pts = syn.map_points_from_events(spark, sf_dir).withColumn("cluster", (F.col("point_id") % 20).cast("int"))
    s = mapping.scatter_data(pts.drop("label"), cluster_col="cluster", k=20, center=(40.7, -73.95))
    return s.select("point_id", *_round(["x_pixel", "y_pixel", "color"]), "is_center", "zoom")


@register("histogram_2d")
def q_histogram_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: 64 x 64 equal-width 2-D histogram of price x quantity."""
    h = density.histogram_2d(syn.table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", bins=64)
    return h.select("x_bin", "y_bin", "x_lo", "y_lo", "count")


@register("density_grid")
def q_density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per cell of the padded 128-px density grid."""
    px = mapping.fit_to_map(syn.map_points_from_events(spark, sf_dir))
    g = density.grid_cells(px, resolution=128)
    return g.select(F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"), "z")


@register("density_values")
def q_density_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed value per cell of the padded 128-px density grid."""
    ev = syn.map_points_from_events(spark, sf_dir).join(
        syn.table(spark, sf_dir, "events").select(F.col("event_id").alias("point_id"), "value"), "point_id")
    g = density.grid_cells(mapping.fit_to_map(ev), value_col="value", resolution=128)
    return g.select(F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"), "z")


@register("density_smooth")
def q_density_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaussian-smoothed density, blank threshold and crop, 128-px grid."""
    px = mapping.fit_to_map(syn.map_points_from_events(spark, sf_dir))
    s = density.smoothed_density(px, resolution=128)
    return s.select("iy", "ix", F.round("z", 6).alias("z"))


@register("line_overlay")
def q_line_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poly-lines projected to tile pixels; count, first and last point per line in (seq, x, y) order.

    The endpoints are order-insensitive min/max aggregates of (seq, x, y), so
    the projected points feed them directly (no range shuffle needed here).
    """
    lines = mapping.line_endpoints(mapping.fit_to_map(syn.line_points_from_lineitem(spark, sf_dir)))
    return lines.select("line_id", "n_points",
                        F.round("first.x", _R6).alias("first_x"), F.round("first.y", _R6).alias("first_y"),
                        F.round("last.x", _R6).alias("last_x"), F.round("last.y", _R6).alias("last_y"))


@register("line_points")
def q_line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of every line, in order, from chunks of three points."""
    chunks = mapping.line_chunks(mapping.line_overlay(syn.line_points_from_lineitem(spark, sf_dir)), chunk_points=3)
    return chunks.select("line_id", "chunk", F.posexplode("points").alias("place", "p")).select(
        "line_id", "chunk", "place", F.col("p.seq").alias("seq"), F.round("p.x", _R6).alias("x"), F.round("p.y", _R6).alias("y"))


@register("cluster_hulls_many")
def q_cluster_hulls_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 + A14 with thousands of clusters: a hull per part."""
    pts = syn.cluster_points_from_lineitem(spark, sf_dir, cluster="l_partkey")
    return hull.cluster_hulls(pts)


@register("cluster_hulls")
def q_cluster_hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 + A14: convex hull vertices per cluster, in order (SQL oracle: monotone chain over lists)."""
    return hull.cluster_hulls(syn.cluster_points_from_lineitem(spark, sf_dir))


@register("cluster_ranks")
def q_cluster_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 + G10: distinct cluster ids and their colour rank."""
    return hull.cluster_ranks(syn.cluster_points_from_lineitem(spark, sf_dir))


@register("street_points")
def q_street_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features written by Spark (one per line), read back, first line flattened to points."""
    path = scratch_path(spark, "streets-geojson")
    syn.street_features_from_lineitem(spark, sf_dir).write.json(path)
    pts = geojson.read_street_points(spark, path, multiline=False)
    return pts.select("feature_id", "point_index", *_round(["x", "y"]))


@register("street_collection")
def q_street_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FeatureCollection documents written by Spark and read back by byte ranges, first line flattened to points."""
    path = scratch_path(spark, "streets-collection")
    geojson.write_collections(syn.street_features_from_lineitem(spark, sf_dir), path)
    pts = geojson.first_line_points(geojson.read_collection(spark, path))
    return pts.select("feature_id", "point_index", *_round(["x", "y"]))


@register("meters_mixed_headers")
def q_meters_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + K1: meter files whose columns stand in another order (and one more column) in half of them, read as one table by name."""
    path = scratch_path(spark, "meter-files")
    m = syn.meters_from_supplier(spark, sf_dir).withColumn("pole", F.concat(F.lit("p"), F.col("MeterNo")))
    odd = F.col("MeterNo").cast("long") % 2 == 1
    sinks.write_csv(m.where(odd).select("the_geom", "pole", "MeterNo"), f"{path}/a", header=True)
    sinks.write_csv(m.where(~odd).select("MeterNo", "the_geom"), f"{path}/b", header=True)
    return readers.load_parking_meters(spark, f"{path}/*").select(F.col("MeterNo").alias("meter_no"), F.col("the_geom").alias("wkt"), "pole")


# ---------------------------------------------------------------- ML


@register("fare_distance_fit")
def q_fare_distance_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + A16 on the whole filtered set: least-squares fare ~ distance, RMSE, explained variance."""
    t = cleaning.drop_zero_coordinates(syn.taxi_trips_from_lineitem(spark, sf_dir))
    t = cleaning.fare_distance_window(cleaning.with_trip_distance(cleaning.within_nyc(t)))
    data = ml.labeled(t, "fare_amount", ["distance"])
    model = ml.fit_linear(data, fit_intercept=True)
    s = ml.fit_summary(model, ml.regression_metrics(model.transform(data)))
    return s.select(F.round(F.col("coefficients")[0], 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("rmse", 6).alias("rmse"), F.round("explained_variance", 6).alias("explained_variance"),
                    F.col("n"))


_TRIP_KEY = ["l_orderkey", "l_linenumber"]


def _fit_row(r: ml.FitResult, coefficients: int, intercept: bool) -> DataFrame:
    s = ml.fit_summary(r.model, r.metrics)
    cols = [F.round(F.col("coefficients")[i], 5).alias(f"coefficient_{i}") for i in range(coefficients)]
    cols += [F.round("intercept", 5).alias("intercept")] if intercept else []
    return s.select(*cols, *[F.round(f"{p}_{m}", 6).alias(f"{p}_{m}") for p in ("train", "test") for m in ("rmse", "explained_variance")],
                    "train_n", "test_n")


@register("fare_regression_distance")
def q_fare_regression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare on distance, rows split 80/20 by the hash of their key; test and train metrics."""
    return _fit_row(ml.fare_regression_distance(syn.taxi_trips_from_lineitem(spark, sf_dir), seed=7, key_cols=_TRIP_KEY), 1, True)


@register("fare_regression_buckets")
def q_fare_regression_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare on 100 exact quantile buckets of the four coordinates, no intercept."""
    return _fit_row(ml.fare_regression_buckets(syn.taxi_trips_from_lineitem(spark, sf_dir), seed=7, key_cols=_TRIP_KEY), 4, False)


@register("fare_regression_clusters")
def q_fare_regression_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare on pickup (k=20) and dropoff (k=5) cluster numbers, no intercept."""
    return _fit_row(ml.fare_regression_clusters(syn.taxi_trips_from_lineitem(spark, sf_dir), seed=7, key_cols=_TRIP_KEY), 2, False)


@register("fare_regression_sample")
def q_fare_regression_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + M11: the same fit on half of the trips, chosen by the hash of their key."""
    return _fit_row(ml.fare_regression_distance(syn.taxi_trips_from_lineitem(spark, sf_dir), seed=7, sample_fraction=0.5, key_cols=_TRIP_KEY), 1, True)


@register("fit_rejects")
def q_fit_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: trips that a fit of fare on distance uses, and those it leaves out, by reason."""
    t = cleaning.with_trip_distance(syn.taxi_trips_from_lineitem(spark, sf_dir))
    t = t.withColumn("fare_amount", F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("fare_amount"))) \
         .withColumn("distance", F.when(F.col("l_linenumber") == 4, F.lit(float("nan"))).otherwise(F.col("distance")))
    return cleaning.reject_counts(t.withColumn("reject_reason", ml.fit_reject_reason("fare_amount", ["distance"])))


_PICKUP = ["pickup_latitude", "pickup_longitude"]


@register("pickup_clusters")
def q_pickup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3: repeatable k-means (k=20, seed 1) on pickup points; the cluster export rows."""
    t = syn.taxi_trips_from_events(spark, sf_dir)
    out = ml.nearest_centre(t, _PICKUP, ml.repeatable_centres(t, _PICKUP))
    return out.select("event_id", *ml.cluster_export(out).columns)


@register("pickup_centres")
def q_pickup_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the fitted centres and the points behind each."""
    c = ml.repeatable_centres(syn.taxi_trips_from_events(spark, sf_dir), _PICKUP)
    return c.select("cluster", *_round(_PICKUP), "rows")


@register("pickup_clusters_ml")
def q_pickup_clusters_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 by Spark ML's k-means (k=20, seed 1): points per cluster (rows-only: the result follows the partitioning)."""
    _, out = ml.kmeans_clusters(syn.taxi_trips_from_events(spark, sf_dir), _PICKUP)
    return out.groupBy("predction_pickup").agg(F.count(F.lit(1)).alias("rows"))


@register("quantile_buckets")
def q_quantile_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: 10 exact quantile buckets of price; rows, least and greatest price per bucket."""
    b = ml.quantile_buckets(syn.table(spark, sf_dir, "lineitem"), ["l_extendedprice"], num_buckets=10)
    return b.groupBy("l_extendedprice_bucket").agg(F.count(F.lit(1)).alias("rows"),
                                                   F.min("l_extendedprice").alias("lo"),
                                                   F.max("l_extendedprice").alias("hi"))


@register("marker_check")
def q_marker_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17 + A15: points with NULL/NaN coordinates dropped; dropped count carried as a column."""
    ev = syn.table(spark, sf_dir, "events")
    pts = ev.select(
        F.col("event_id").alias("point_id"),
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
         .otherwise(F.col("user_id") / 1000.0 + 40.6).alias("latitude"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
         .otherwise(F.col("value") / 5000.0 - 74.0).alias("longitude"))
    return cleaning.check_markers(pts).select("point_id", *_round(["latitude", "longitude"]), "dropped")


# ---------------------------------------------------------------- sinks and row caps


@register("csv_roundtrip")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K2 + S1/S9: monthly trips written as CSV without and with a header, read back by position and name."""
    readers.register_trips(spark, syn.taxi_trips_from_lineitem(spark, sf_dir), view="trips")
    out = temporal.monthly_trips(readers.trips_projection(spark, ["tpep_pickup_datetime", "trip_distance"]))
    plain, headed = scratch_path(spark, "monthly-csv"), scratch_path(spark, "monthly-csv-header")
    sinks.write_csv(out, plain)
    sinks.write_csv(out, headed, header=True)
    a = readers.read_csv(spark, plain, "year int, month int, avg_distance double, trips long", header=False)
    b = readers.read_csv_by_position(spark, headed, {0: "year_h", 1: "month_h", 3: "trips_h"})
    j = a.join(b, (a.year == b.year_h.cast("int")) & (a.month == b.month_h.cast("int")))
    return j.select("year", "month", F.round("avg_distance", 6).alias("avg_distance"), "trips",
                    F.col("trips_h").cast("long").alias("trips_from_header_file"))


# ---------------------------------------------------------------- streaming


@register("stream_tickets_by_hour")
def q_stream_tickets_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over a file stream: tickets written by Spark as CSV files, counted by a Structured Streaming query.

    The query runs to completion (available-now trigger) with its state and
    progress in the shared checkpoint folder; the result table is returned.
    """
    src = scratch_path(spark, "ticket-stream-in")
    raw = syn.tickets_from_events(spark, sf_dir).select(
        *[F.col(dst).alias(src_name) for src_name, dst in schemas.TICKET_RENAMES.items()])
    raw.write.option("header", True).csv(src)
    out = scratch_path(spark, "ticket-stream-out")
    q = ticket_stream.start_counts(spark, src, out, by="hour", checkpoint=scratch_path(spark, "ticket-stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).select("hour", "tickets")
