"""Map-ready data: bounds, auto zoom, tile pixels, scatter data, poly-lines.

The map frame (centre, zoom, centre pixel) is one row computed by a
global aggregate; it is joined back to the points as a broadcast of that
single row (size bound: one row), so fitting points to a map is two scans
and no shuffle of the points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_ZOOM, MAX_SIZE, SCALE
from ..functions.geometry import mercator_x, mercator_y
from .cleaning import valid_markers
from .ranks import with_position


def map_bounds(points: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """One row with the min/max of latitude and longitude."""
    return points.agg(F.min(lat_col).alias("lat_min"), F.max(lat_col).alias("lat_max"),
                      F.min(lon_col).alias("lon_min"), F.max(lon_col).alias("lon_max"))


def zoom_expr(size: int = MAX_SIZE):
    """G4 on a bounds row: int(log2(2*size / amplitude)); x amplitude doubled; 10 if 0 or NaN."""
    dx = F.abs(mercator_x("lon_max") - mercator_x("lon_min")) * 2.0
    dy = F.abs(mercator_y("lat_max") - mercator_y("lat_min"))
    amp = F.greatest(dx, dy)
    z = F.log2(F.lit(2.0 * size) / amp).cast("int")
    return F.when(amp.isNull() | F.isnan(amp) | (amp == 0), F.lit(DEFAULT_ZOOM)).otherwise(z)


def map_frame(bounds: DataFrame, size: int = MAX_SIZE) -> DataFrame:
    """Centre (midpoint of bounds), zoom and the centre's world pixel, one row."""
    b = bounds.withColumns({
        "center_lat": (F.col("lat_max") + F.col("lat_min")) / 2,
        "center_long": (F.col("lon_max") + F.col("lon_min")) / 2,
        "zoom": zoom_expr(size),
    })
    return b.withColumns({"_cx": mercator_x("center_long"), "_cy": mercator_y("center_lat")})


def to_tile_pixels(points: DataFrame, frame: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude",
                   size: int = MAX_SIZE, scale: int = SCALE) -> DataFrame:
    """Scale * ((world pixel - centre pixel) * 2^zoom + size / 2), for every point."""
    f = frame.select("center_lat", "center_long", "zoom", "_cx", "_cy")
    j = points.crossJoin(F.broadcast(f))
    factor = F.pow(F.lit(2.0), F.col("zoom"))
    return j.withColumns({
        "x_pixel": F.lit(float(scale)) * ((mercator_x(lon_col) - F.col("_cx")) * factor + F.lit(size / 2.0)),
        "y_pixel": F.lit(float(scale)) * ((mercator_y(lat_col) - F.col("_cy")) * factor + F.lit(size / 2.0)),
    }).drop("_cx", "_cy")


def fit_to_map(points: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude",
               size: int = MAX_SIZE, scale: int = SCALE) -> DataFrame:
    """Drop unusable coordinates (F17), then centre, zoom and tile pixels together.

    Adds ``x_pixel``, ``y_pixel``, ``zoom``, ``center_lat``, ``center_long``.
    """
    pts = valid_markers(points, lat_col, lon_col)
    frame = map_frame(map_bounds(pts, lat_col, lon_col), size)
    return to_tile_pixels(pts, frame, lat_col, lon_col, size, scale)


def with_center(points: DataFrame, center_lat: float, center_long: float,
                lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """Append the centre point (``is_center`` true) so it takes part in bounds and pixels."""
    spark = points.sparkSession
    others = [f for f in points.schema.fields if f.name not in (lat_col, lon_col)]
    row = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in others],
        F.lit(float(center_lat)).alias(lat_col), F.lit(float(center_long)).alias(lon_col),
    )
    return (points.withColumn("is_center", F.lit(False))
                  .unionByName(row.withColumn("is_center", F.lit(True))))


def color_value(cluster_col: str, k: int = 20):
    """Cluster id scaled to a 0-1 colour value."""
    return F.col(cluster_col) / F.lit(float(k))


def scatter_data(points: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude",
                 cluster_col: str | None = None, k: int = 20, center: tuple[float, float] | None = None,
                 size: int = MAX_SIZE, scale: int = SCALE) -> DataFrame:
    """Tile pixels and a colour value per point, with the optional centre (lat, long) marker row."""
    pts = points.withColumn("color", color_value(cluster_col, k) if cluster_col else F.lit(0.0))
    if center is not None:
        pts = with_center(pts, center[0], center[1], lat_col, lon_col)
        pts = pts.withColumn("color", F.coalesce(F.col("color"), F.lit(0.0)))
    else:
        pts = pts.withColumn("is_center", F.lit(False))
    return fit_to_map(pts, lat_col, lon_col, size, scale)


def line_overlay(points: DataFrame, line_col: str = "line_id", seq_col: str = "seq",
                 lat_col: str = "latitude", lon_col: str = "longitude",
                 size: int = MAX_SIZE, scale: int = SCALE) -> DataFrame:
    """G8 (decision D15): every input line's points as tile pixels, regrouped per line in order.

    Output rows ``(line_id, seq, x_pixel, y_pixel)`` range-partitioned and
    sorted by (line, seq): each line's points are contiguous and ordered,
    and a very long line spreads over several partitions instead of being
    collected into one task or one row. The map frame is fitted over all
    points of all lines.
    """
    px = fit_to_map(points, lat_col, lon_col, size, scale)
    out = px.select(line_col, seq_col, "x_pixel", "y_pixel")
    return out.repartitionByRange(line_col, seq_col, "x_pixel", "y_pixel") \
              .sortWithinPartitions(line_col, seq_col, "x_pixel", "y_pixel")


def line_endpoints(lines: DataFrame, line_col: str = "line_id", seq_col: str = "seq") -> DataFrame:
    """Per line: point count, first and last point in (seq, x, y) order (partial aggregates, no collect)."""
    pt = F.struct(F.col(seq_col).alias("seq"), F.col("x_pixel").alias("x"), F.col("y_pixel").alias("y"))
    return lines.groupBy(line_col).agg(F.count(F.lit(1)).cast("int").alias("n_points"),
                                       F.min(pt).alias("first"), F.max(pt).alias("last"))


def line_arrays(lines: DataFrame, line_col: str = "line_id") -> DataFrame:
    """Lines as one row each with an ordered point array, for consumers that need arrays.

    Use only for lines of bounded length (a street line has hundreds of
    points); the array of a line is built in one task.
    """
    pts = F.sort_array(F.collect_list(F.struct(F.col("seq"), F.col("x_pixel").alias("x"), F.col("y_pixel").alias("y"))))
    return lines.groupBy(line_col).agg(pts.alias("points"))


def line_chunks(lines: DataFrame, line_col: str = "line_id", seq_col: str = "seq", chunk_points: int = 1000) -> DataFrame:
    """Whole lines as ordered arrays of at most ``chunk_points`` points: ``(line, chunk, points array<struct<seq, x, y>>)``.

    Points get their place in (line, seq, x, y) order from range partitions (see ``ranks``); a line's chunks are
    numbered by the distance from its first point, so they come together chunk by chunk and a long line meets in no
    task. The chunks of a line in order hold all its points in order.
    """
    keys = [line_col, seq_col, "x_pixel", "y_pixel"]
    placed = with_position(lines.select(*keys), [F.col(c) for c in keys], "_place")
    start = placed.groupBy(F.col(line_col).alias("_line")).agg(F.min("_place").alias("_start"))
    in_line = placed.join(start, F.col(line_col).eqNullSafe(F.col("_line"))).withColumn("_at", F.col("_place") - F.col("_start"))
    pts = F.array_sort(F.collect_list(F.struct("_at", F.col(seq_col).alias("seq"), F.col("x_pixel").alias("x"), F.col("y_pixel").alias("y"))))
    chunks = in_line.groupBy(line_col, F.floor(F.col("_at") / chunk_points).alias("chunk")).agg(pts.alias("p"))
    return chunks.select(line_col, "chunk", F.transform("p", lambda q: F.struct(q["seq"].alias("seq"), q["x"].alias("x"), q["y"].alias("y"))).alias("points"))
