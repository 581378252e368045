"""Row filters and checks: taxi box and ranges, bike validity, coordinate bounds, marker input.

F9-F12, F15-F18, P3, P20-P21, A15.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import geometry as geo
from ..functions import timeparts as tp

PICKUP = ("pickup_latitude", "pickup_longitude")
DROPOFF = ("dropoff_latitude", "dropoff_longitude")


def drop_zero_coordinates(df: DataFrame, cols=PICKUP + DROPOFF) -> DataFrame:
    """drop rows where any of the coordinate columns is exactly 0."""
    cond = None
    for c in cols:
        part = F.col(c) != 0.0
        cond = part if cond is None else cond & part
    return df.where(cond)


def in_open_box(lat_col: str, lon_col: str, lat_min=K.NYC_LAT_MIN, lat_max=K.NYC_LAT_MAX,
                lon_min=K.NYC_LON_MIN, lon_max=K.NYC_LON_MAX):
    """F10/F11 predicate: strictly inside the box (edges excluded)."""
    return ((F.col(lon_col) < lon_max) & (F.col(lon_col) > lon_min)
            & (F.col(lat_col) < lat_max) & (F.col(lat_col) > lat_min))


def within_nyc(df: DataFrame, points=(PICKUP, DROPOFF)) -> DataFrame:
    """pickup and dropoff strictly inside the NYC box."""
    cond = None
    for lat, lon in points:
        part = in_open_box(lat, lon)
        cond = part if cond is None else cond & part
    return df.where(cond)


def with_trip_distance(df: DataFrame, out_col: str = "distance") -> DataFrame:
    """Straight-line pickup-dropoff distance in degrees."""
    return df.withColumn(out_col, geo.degree_distance(*PICKUP, *DROPOFF))


def fare_distance_window(df: DataFrame, fare_col: str = "fare_amount", dist_col: str = "distance",
                         fare_min=K.FARE_MIN, fare_max=K.FARE_MAX, dist_min=K.DIST_MIN,
                         dist_max=K.DIST_MAX) -> DataFrame:
    """fare in (0, 60) and distance in (0, 0.21), open intervals."""
    return df.where((F.col(fare_col) > fare_min) & (F.col(fare_col) < fare_max)
                    & (F.col(dist_col) < dist_max) & (F.col(dist_col) > dist_min))


def plot_window(df: DataFrame, x_col: str = "distance", y_col: str = "fare_amount",
                x_max=K.PLOT_DIST_MAX, y_max=K.PLOT_FARE_MAX) -> DataFrame:
    """points inside the plot axes x 0..0.22, y 0..60 (closed)."""
    return df.where(F.col(x_col).between(0.0, x_max) & F.col(y_col).between(0.0, y_max))


#: Reject reasons of a bike ride, in the order in which they are looked for.
BIKE_REJECTS = ("duration", "start time", "stop time", "start station", "end station", "end name")


def with_bike_reject_reason(df: DataFrame, time_col: str = "starttime", stop_col: str = "stoptime",
                            pattern: str = tp.BIKE_TIME_PATTERN, reason_col: str = "reject_reason") -> DataFrame:
    """Rides with the first of BIKE_REJECTS that makes them unusable, NULL for usable ones. One column serves the
    clean rides and the rejects beside them, so dropped rides are counted, not lost."""
    good = (F.col("duration") > 0, tp.parse_timestamp(time_col, pattern).isNotNull(), tp.parse_timestamp(stop_col, pattern).isNotNull(),
            F.col("startId") > 0, F.col("endId") > 0, F.trim(F.col("endName")) != "")
    return df.withColumn(reason_col, F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in zip(good, BIKE_REJECTS)]))


def reject_counts(df: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """``(reason, rows)``, reason ``kept`` for the rows without a reject reason."""
    return df.groupBy(F.coalesce(reason_col, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def clean_bike_trips(df: DataFrame, time_col: str = "starttime", stop_col: str = "stoptime",
                     pattern: str = tp.BIKE_TIME_PATTERN,
                     drop_cols=("gender", "birth year", "usertype")) -> DataFrame:
    """P3, P20, F15 (decisions D6, D7): parse start time once and keep valid rides.

    Adds ``month``, ``year`` and ``startHour`` from the parsed start time;
    keeps rows with positive duration, parseable start and stop, positive
    start and end station ids and a non-empty end station name; drops the
    rider columns. ``with_bike_reject_reason`` tells the others' reasons.
    """
    start = tp.parse_timestamp(time_col, pattern)
    stop = tp.parse_timestamp(stop_col, pattern)
    out = df.withColumns({
        "_start": start, "_stop": stop,
    })
    out = out.where((F.col("duration") > 0) & F.col("_start").isNotNull() & F.col("_stop").isNotNull()
                    & (F.col("startId") > 0) & (F.col("endId") > 0)
                    & F.col("endName").isNotNull() & (F.trim(F.col("endName")) != ""))
    out = out.withColumns({
        "month": tp.month_of("_start"),
        "year": tp.year_of("_start"),
        "startHour": tp.hour_of("_start"),
    }).drop("_start", "_stop")
    return out.drop(*[c for c in drop_cols if c in df.columns])


def coordinate_bounds(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longtitude",
                      lat_max: float | None = 50.0, lat_min: float | None = None,
                      lon_max: float | None = None, lon_min: float | None = None) -> DataFrame:
    """F16 (D8): keep rows inside the given coordinate bounds (strict); a NULL coordinate fails its own bounds only."""
    cond = F.lit(True)
    if lat_max is not None:
        cond = cond & (F.col(lat_col) < lat_max)
    if lat_min is not None:
        cond = cond & (F.col(lat_col) > lat_min)
    if lon_max is not None:
        cond = cond & (F.col(lon_col) < lon_max)
    if lon_min is not None:
        cond = cond & (F.col(lon_col) > lon_min)
    return df.where(cond)


def require_columns(df: DataFrame, required=("latitude", "longitude")) -> None:
    """schema check (driver-side, on the schema only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"input frame must contain columns {list(required)}; missing {missing}")


def usable_coordinate(col: str):
    return F.col(col).isNotNull() & ~F.isnan(F.col(col))


def valid_markers(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """rows with both coordinates present and not NaN."""
    require_columns(df, (lat_col, lon_col))
    return df.where(usable_coordinate(lat_col) & usable_coordinate(lon_col))


def invalid_marker_count(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """One-row frame with the number of rows dropped by ``valid_markers``."""
    bad = ~(usable_coordinate(lat_col) & usable_coordinate(lon_col))
    return df.agg(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias("dropped"))


def check_markers(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """F17 + A15: kept rows, each with the dropped-row count attached (one-row broadcast)."""
    kept = valid_markers(df, lat_col, lon_col)
    return kept.crossJoin(F.broadcast(invalid_marker_count(df, lat_col, lon_col)))
