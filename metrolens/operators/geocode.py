"""J5 + F16: bike trips geocoded by joining their address to an address-point table.

Decision D8: the join key is the address on both sides; coordinate bounds
are parameters (the reference keeps latitude < 50 only). The address
table is a dimension; AQE broadcasts it when its runtime size is under
the threshold, otherwise the plan is a shuffle join on the address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import coordinate_bounds


def geocode(trips: DataFrame, addresses: DataFrame, on: str = "address",
            lat_col: str = "latitude", lon_col: str = "longtitude",
            lat_max: float | None = 50.0, lat_min: float | None = None,
            lon_max: float | None = None, lon_min: float | None = None) -> DataFrame:
    """Trips with the coordinates of their address; unmatched trips and out-of-bounds points are dropped."""
    pts = addresses.select(on, lat_col, lon_col).where(F.col(on).isNotNull())
    pts = coordinate_bounds(pts, lat_col, lon_col, lat_max=lat_max, lat_min=lat_min,
                            lon_max=lon_max, lon_min=lon_min)
    return trips.join(pts, on, "inner")
