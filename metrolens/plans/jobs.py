"""End-to-end jobs: file inputs -> operators -> file outputs (the reference's script entry points).

Each job is one lazy plan ending in one write, so Spark runs it as a single
job graph. Inputs are CSV files in the reference layouts (see
``sources.schemas``); output paths are always explicit (decision D14, D20).

    python -m metrolens.plans.jobs tickets-per-segment --tickets T.csv --segments C.csv --out OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import cleaning, geocode, interval_join as ij, ml, proximity, temporal
from ..sources import readers, schemas


# ---------------------------------------------------------------- parking


def tickets_by_hour_job(spark: SparkSession, tickets_path: str, out_path: str) -> None:
    """A1 + K5: hours 0-23 and their ticket counts as one JSON record."""
    t = readers.load_parking_tickets(spark, tickets_path)
    sinks.write_series_json(temporal.tickets_by_hour(t), "hour", "tickets", out_path)


def tickets_by_weekday_job(spark: SparkSession, tickets_path: str, out_path: str) -> None:
    """A2 + K5: ISO weekdays 1-7 and their ticket counts as one JSON record."""
    t = readers.load_parking_tickets(spark, tickets_path)
    sinks.write_series_json(temporal.tickets_by_weekday(t), "day_of_week", "tickets", out_path)


def tickets_per_segment_job(spark: SparkSession, tickets_path: str, segments_path: str, out_path: str) -> None:
    """A3 + K1: (the_geom, count) per street segment."""
    t = readers.load_parking_tickets(spark, tickets_path)
    s = readers.load_street_segments(spark, segments_path)
    sinks.write_csv(ij.tickets_per_segment(t, s).select("the_geom", "count"), out_path)


def tickets_per_segment_by_day_job(spark: SparkSession, tickets_path: str, segments_path: str, out_path: str) -> None:
    """A4 + K3: one job, output partitioned by ``day_of_week`` (instead of seven jobs)."""
    t = temporal.with_ticket_weekday(readers.load_parking_tickets(spark, tickets_path), drop_invalid=False)
    s = readers.load_street_segments(spark, segments_path)
    out = ij.tickets_per_segment(t, s, by=["day_of_week"]).select("the_geom", "count", "day_of_week")
    sinks.write_partitioned_csv(out, out_path, ["day_of_week"])


def tickets_per_segment_by_hour_job(spark: SparkSession, tickets_path: str, segments_path: str, out_path: str) -> None:
    """A5 + K1: (the_geom, count, Hour, AMPM)."""
    t = temporal.with_ticket_hour(readers.load_parking_tickets(spark, tickets_path), drop_invalid=False)
    s = readers.load_street_segments(spark, segments_path)
    out = ij.tickets_per_segment(t, s, by=["Hour", "AMPM"]).select("the_geom", "count", "Hour", "AMPM")
    sinks.write_csv(out, out_path)


def meters_near_job(spark: SparkSession, tickets_path: str, meters_path: str, out_path: str,
                    longitude: float, latitude: float, min_range: float = 0.1) -> None:
    """A6 + K1/K6: MeterNo, count, Center_Lat, Center_Long, StringLatLon."""
    t = readers.load_parking_tickets(spark, tickets_path)
    m = readers.load_parking_meters(spark, meters_path)
    sinks.write_csv(proximity.meters_near(t, m, longitude, latitude, min_range), out_path)


# ---------------------------------------------------------------- taxi


def monthly_trips_job(spark: SparkSession, trips_path: str, out_path: str) -> DataFrame:
    """S6-S7 + A7-A8 + K1."""
    readers.register_trips(spark, trips_path)
    out = temporal.monthly_trips(readers.trips_projection(spark, ["tpep_pickup_datetime", "trip_distance"]))
    sinks.write_csv(out, out_path)
    return out


def midnight_trips_job(spark: SparkSession, trips_path: str, out_path: str) -> None:
    """F8 + K1."""
    readers.register_trips(spark, trips_path)
    trips = readers.trips_projection(spark, ["tpep_pickup_datetime", "pickup_longitude", "pickup_latitude"])
    sinks.write_csv(temporal.midnight_trips(trips), out_path)


def pickup_clusters_job(spark: SparkSession, trips_path: str, out_path: str, sample_fraction: float | None = None,
                        seed: int = 1) -> None:
    """F9 + L4 + M2-M3 + K2: (pickup_latitude, pickup_longitude, predction_pickup) with a header."""
    t = cleaning.drop_zero_coordinates(readers.read_csv(spark, trips_path, schemas.TAXI_TRIPS))
    t = ml.maybe_sample(t, sample_fraction, seed)
    _, out = ml.kmeans_clusters(t, ["pickup_latitude", "pickup_longitude"], seed=seed)
    sinks.write_csv(ml.cluster_export(out), out_path, header=True)


def fare_regression_job(spark: SparkSession, trips_path: str, out_path: str | None = None, kind: str = "distance", seed: int = 7,
                        sample_fraction: float | None = None) -> DataFrame:
    """The one-row metrics frame (coefficients, test and train RMSE / explained variance), also written as CSV
    to ``out_path`` if given (coefficients joined by commas)."""
    t = readers.read_csv(spark, trips_path, schemas.TAXI_TRIPS)
    fn = {"distance": ml.fare_regression_distance, "buckets": ml.fare_regression_buckets,
          "clusters": ml.fare_regression_clusters}[kind]
    r = fn(t, seed=seed, sample_fraction=sample_fraction)
    summary = ml.fit_summary(r.model, r.metrics)
    if out_path:
        joined = F.array_join(F.transform("coefficients", lambda c: c.cast("string")), ",")
        sinks.write_csv(summary.withColumn("coefficients", joined), out_path, header=True)
    return summary


def distance_fare_export_job(spark: SparkSession, trips_path: str, out_path: str) -> None:
    """M12 + K2: (fare, distance) pairs inside the regression window, with a header."""
    t = cleaning.within_nyc(readers.read_csv(spark, trips_path, schemas.TAXI_TRIPS))
    t = cleaning.fare_distance_window(cleaning.with_trip_distance(t))
    sinks.write_csv(t.select("fare_amount", "distance"), out_path, header=True)


def cluster_colors_from_export(spark: SparkSession, export_path: str, k: int = 20) -> DataFrame:
    """S9 + F11 + P22: the cluster export read by position (lat, lon, cluster; header skipped),
    points strictly inside the NYC box, colour value cluster / k."""
    df = readers.read_csv_by_position(spark, export_path, {0: "latitude", 1: "longitude", 2: "cluster"})
    df = df.where(cleaning.in_open_box("latitude", "longitude"))
    return df.select("longitude", "latitude", (F.col("cluster") / F.lit(float(k))).alias("color"))


def distance_fare_from_export(spark: SparkSession, export_path: str) -> DataFrame:
    """S9 + F18: the (fare, distance) export read by position, cropped to the plot window."""
    df = readers.read_csv_by_position(spark, export_path, {0: "fare_amount", 1: "distance"})
    return cleaning.plot_window(df)


# ---------------------------------------------------------------- bikes


def bike_clean_job(spark: SparkSession, bikes_path: str, out_path: str) -> None:
    """P3, P20, F15 + K1."""
    b = readers.read_csv(spark, bikes_path, schemas.BIKE_TRIPS)
    sinks.write_csv(cleaning.clean_bike_trips(b), out_path)


def geocode_job(spark: SparkSession, bikes_path: str, addresses_path: str, out_path: str,
                lat_max: float | None = 50.0) -> None:
    """J5 + F16 + K1."""
    b = readers.read_csv(spark, bikes_path, schemas.BIKE_TRIPS)
    a = readers.read_csv(spark, addresses_path, schemas.ADDRESS_POINTS)
    sinks.write_csv(geocode.geocode(b, a, lat_max=lat_max), out_path)


def season_split_job(spark: SparkSession, bikes_path: str, out_path: str) -> None:
    """F13-F14 + K4: cleaned rides partitioned by season and time of day in one job."""
    b = temporal.with_season_and_time_of_day(cleaning.clean_bike_trips(readers.read_csv(spark, bikes_path,
                                                                                        schemas.BIKE_TRIPS)))
    b = b.withColumn("time_of_day", F.coalesce("time_of_day", F.lit("unknown")))
    sinks.write_partitioned_csv(b.where(F.col("season").isNotNull()), out_path, ["season", "time_of_day"], header=True)


JOBS = {
    "tickets-by-hour": (tickets_by_hour_job, ["tickets", "out"]),
    "tickets-by-weekday": (tickets_by_weekday_job, ["tickets", "out"]),
    "tickets-per-segment": (tickets_per_segment_job, ["tickets", "segments", "out"]),
    "tickets-per-segment-by-day": (tickets_per_segment_by_day_job, ["tickets", "segments", "out"]),
    "tickets-per-segment-by-hour": (tickets_per_segment_by_hour_job, ["tickets", "segments", "out"]),
    "monthly-trips": (monthly_trips_job, ["trips", "out"]),
    "midnight-trips": (midnight_trips_job, ["trips", "out"]),
    "pickup-clusters": (pickup_clusters_job, ["trips", "out"]),
    "fare-regression": (fare_regression_job, ["trips", "out"]),
    "distance-fare-export": (distance_fare_export_job, ["trips", "out"]),
    "bike-clean": (bike_clean_job, ["bikes", "out"]),
    "geocode": (geocode_job, ["bikes", "addresses", "out"]),
    "season-split": (season_split_job, ["bikes", "out"]),
}


def main(argv=None) -> None:
    from ..session import build_session

    p = argparse.ArgumentParser(description="metrolens batch jobs")
    p.add_argument("job", choices=sorted(JOBS) + ["meters-near"])
    for name in ("tickets", "segments", "meters", "trips", "bikes", "addresses", "out"):
        p.add_argument(f"--{name}")
    p.add_argument("--longitude", type=float)
    p.add_argument("--latitude", type=float)
    p.add_argument("--min-range", type=float, default=0.1)
    a = p.parse_args(argv)
    spark = build_session()
    if a.job == "meters-near":
        meters_near_job(spark, a.tickets, a.meters, a.out, a.longitude, a.latitude, a.min_range)
        return
    fn, args = JOBS[a.job]
    fn(spark, *[getattr(a, x) for x in args])


if __name__ == "__main__":
    main()
