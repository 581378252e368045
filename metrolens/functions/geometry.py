"""Coordinate expressions: WKT points, straight-line distance, Web-Mercator pixels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MAX_SIN_LAT, TILE_SIZE

_NUM = r"([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"
_POINT_RE = r"^\s*POINT\s*\(\s*" + _NUM + r"\s+" + _NUM + r"\s*\)\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wkt_point_tokens(wkt) -> Column:
    """The two coordinate tokens of ``POINT (x y)`` as an array of text.

    Malformed text gives NULL (not an array of garbage).
    """
    x = F.nullif(F.regexp_extract(_c(wkt), _POINT_RE, 1), F.lit(""))
    y = F.nullif(F.regexp_extract(_c(wkt), _POINT_RE, 2), F.lit(""))
    return F.when(x.isNotNull() & y.isNotNull(), F.array(x, y))


def wkt_point_x(wkt) -> Column:
    """First coordinate (longitude) as double."""
    return F.nullif(F.regexp_extract(_c(wkt), _POINT_RE, 1), F.lit("")).try_cast("double")


def wkt_point_y(wkt) -> Column:
    """Second coordinate (latitude) as double."""
    return F.nullif(F.regexp_extract(_c(wkt), _POINT_RE, 2), F.lit("")).try_cast("double")


def degree_distance(lat1, lon1, lat2, lon2) -> Column:
    """Straight-line distance in degrees."""
    dlat = _c(lat1) - _c(lat2)
    dlon = _c(lon1) - _c(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon)


def mercator_x(lon) -> Column:
    """G1: world pixel x at zoom 0."""
    return F.lit(float(TILE_SIZE)) * (F.lit(0.5) + _c(lon) / F.lit(360.0))


def mercator_y(lat) -> Column:
    """G1: world pixel y at zoom 0, sine of latitude clipped to +/- MAX_SIN_LAT."""
    siny = F.least(F.greatest(F.sin(_c(lat) * F.lit(math.pi / 180.0)), F.lit(-MAX_SIN_LAT)), F.lit(MAX_SIN_LAT))
    return F.lit(float(TILE_SIZE)) * (F.lit(0.5) - F.ln((F.lit(1.0) + siny) / (F.lit(1.0) - siny)) / F.lit(4 * math.pi))


def mercator_pixels(df, lat_col: str = "latitude", lon_col: str = "longitude",
                    x_col: str = "x_pixel", y_col: str = "y_pixel"):
    """World pixels for every row of a frame."""
    return df.withColumns({x_col: mercator_x(lon_col), y_col: mercator_y(lat_col)})
