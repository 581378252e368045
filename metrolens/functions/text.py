"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_dashes(meter_no) -> Column:
    """P9: '123-4567' -> '1234567'."""
    return F.regexp_replace(_c(meter_no), "-", "")


def array_to_text(arr, sep: str = ",") -> Column:
    """Array of values joined to one text cell (CSV cannot hold arrays)."""
    return F.concat_ws(sep, _c(arr))
