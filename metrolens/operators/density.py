"""2-D histogram, grid density and Gaussian-smoothed density as sparse Spark cell tables.

A10-A12, G6. A grid is a table of non-empty cells ``(iy, ix, z)``; its
size is bounded by the grid resolution, not by the number of points.
Binning is a ``groupBy`` with map-side partial aggregation.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BLANK_THRESH, GAUSS_TRUNCATE, HIST_BINS, MAX_SIZE, SCALE


def _bin_index(v, lo, step, n):
    """Index of the half-open bin [lo + i*step, lo + (i+1)*step) holding v; the top edge goes to bin n-1.

    The floor estimate is corrected against the edges as computed
    (lo + i*step), so values on an edge fall where an edge search would put them.
    """
    b = F.floor((v - lo) / step)
    b = F.when(v < lo + b * step, b - 1).when(v >= lo + (b + 1) * step, b + 1).otherwise(b)
    return F.least(F.greatest(b, F.lit(0)), F.lit(n - 1)).cast("int")


def histogram_2d(df: DataFrame, x_col: str, y_col: str, bins: int = HIST_BINS) -> DataFrame:
    """A10: counts on ``bins`` x ``bins`` equal-width bins from min to max (last bin closed).

    Output ``(x_bin, y_bin, x_lo, y_lo, count)`` for non-empty bins. A constant
    axis spans (v - 0.5, v + 0.5). Rows with a NULL or NaN coordinate are ignored.
    """
    pts = df.select(F.col(x_col).alias("_x"), F.col(y_col).alias("_y")) \
            .where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    r = pts.agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"))
    r = r.select(
        F.when(F.col("x0") == F.col("x1"), F.col("x0") - 0.5).otherwise(F.col("x0")).alias("x0"),
        F.when(F.col("x0") == F.col("x1"), F.col("x1") + 0.5).otherwise(F.col("x1")).alias("x1"),
        F.when(F.col("y0") == F.col("y1"), F.col("y0") - 0.5).otherwise(F.col("y0")).alias("y0"),
        F.when(F.col("y0") == F.col("y1"), F.col("y1") + 0.5).otherwise(F.col("y1")).alias("y1"),
    ).select("x0", "y0", ((F.col("x1") - F.col("x0")) / bins).alias("sx"),
             ((F.col("y1") - F.col("y0")) / bins).alias("sy"))
    j = pts.crossJoin(F.broadcast(r))
    j = j.select(_bin_index(F.col("_x"), F.col("x0"), F.col("sx"), bins).alias("x_bin"),
                 _bin_index(F.col("_y"), F.col("y0"), F.col("sy"), bins).alias("y_bin"), "x0", "y0", "sx", "sy")
    out = j.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"), F.first("x0").alias("x0"),
                                    F.first("y0").alias("y0"), F.first("sx").alias("sx"), F.first("sy").alias("sy"))
    return out.select("x_bin", "y_bin", (F.col("x0") + F.col("x_bin") * F.col("sx")).alias("x_lo"),
                      (F.col("y0") + F.col("y_bin") * F.col("sy")).alias("y_lo"), "count")


VALUE_DIGITS = 6  # decimal places of summed values


def default_window(resolution: int) -> int:
    """Smoothing window: 1 % of the resolution, at least 1 (decision D16)."""
    return max(1, int(0.01 * resolution))


def grid_cells(pixels: DataFrame, x_col: str = "x_pixel", y_col: str = "y_pixel", value_col: str | None = None,
               size: int = MAX_SIZE * SCALE, resolution: int | None = None,
               window: int | None = None) -> DataFrame:
    """A11 (A12 when ``value_col`` is None: value 1 per point): summed value per cell of the padded grid.

    Cell = (int(y * k) + w, int(x * k) + w) with k = (resolution - 1) / size,
    truncation toward zero; cells outside [0, resolution + 2w) are dropped.
    Values are added as decimals of VALUE_DIGITS places, so a cell's sum does
    not depend on the order of its points; NULL, NaN and infinite values count as 0.
    """
    res = resolution or size
    w = window or default_window(res)  # 0 means the default too
    k = (res - 1) / size
    imgw = res + 2 * w
    z = F.lit(1)
    if value_col:
        value = F.col(value_col).cast("double")
        z = F.when(F.abs(value) < math.inf, value).otherwise(0.0).cast(f"decimal(28,{VALUE_DIGITS})")
    cells = pixels.select((F.col(x_col) * k).try_cast("long").alias("_ix"),
                          (F.col(y_col) * k).try_cast("long").alias("_iy"), z.alias("_z"))
    cells = cells.select((F.col("_iy") + w).alias("iy"), (F.col("_ix") + w).alias("ix"), "_z")
    cells = cells.where((F.col("ix") >= 0) & (F.col("ix") < imgw) & (F.col("iy") >= 0) & (F.col("iy") < imgw))
    return cells.groupBy("iy", "ix").agg(F.sum("_z").cast("double").alias("z"))


def gaussian_kernel(sigma: float, truncate: float = GAUSS_TRUNCATE) -> list[tuple[int, float]]:
    """Normalised 1-D Gaussian weights for offsets -r..r, r = int(truncate * sigma + 0.5)."""
    r = int(truncate * float(sigma) + 0.5)
    offs = np.arange(-r, r + 1)
    phi = np.exp(-0.5 / (float(sigma) ** 2) * offs.astype(float) ** 2)
    phi = phi / phi.sum()
    return [(int(o), float(p)) for o, p in zip(offs, phi)]


def _blur_axis(cells: DataFrame, axis: str, other: str, n: int, kernel: DataFrame, r: int) -> DataFrame:
    """One separable pass with half-sample mirror borders (d c b a | a b c d | d c b a).

    Each cell also acts at its mirror images e = p + 2n*m and e = 2n*m - 1 - p;
    only images within [-r, n - 1 + r] can reach a target. Target t = e - j
    for kernel offset j, kept when 0 <= t < n; values are summed per target.
    """
    m = int(math.ceil((r + 1) / (2.0 * n))) + 1
    reps = F.sequence(F.lit(-m), F.lit(m))
    p = F.col(axis)
    images = F.flatten(F.transform(reps, lambda q: F.array(p + q * (2 * n), q * (2 * n) - 1 - p)))
    images = F.filter(images, lambda e: (e >= -r) & (e <= n - 1 + r))
    ex = cells.select(other, F.explode(images).alias("_e"), "z")
    j = ex.crossJoin(F.broadcast(kernel))
    j = j.select(other, (F.col("_e") - F.col("_j")).alias(axis), (F.col("z") * F.col("_w")).alias("z"))
    j = j.where((F.col(axis) >= 0) & (F.col(axis) < n))
    return j.groupBy(other, axis).agg(F.sum("z").alias("z"))


def gaussian_smooth(cells: DataFrame, n: int, sigma: float, truncate: float = GAUSS_TRUNCATE) -> DataFrame:
    """G6 core: 2-D Gaussian filter of a sparse n x n grid (rows ``iy``, columns ``ix``), exact for any radius.

    The kernel table has 2r + 1 rows (bounded by ``sigma``), broadcast to
    each pass; the grid is aggregated between passes.
    """
    spark = cells.sparkSession
    kern = gaussian_kernel(sigma, truncate)
    r = kern[-1][0]
    kernel = spark.createDataFrame(kern, "_j int, _w double")
    c = cells.select(F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"),
                     F.col("z").cast("double").alias("z"))
    c = _blur_axis(c, "iy", "ix", n, kernel, r)
    c = _blur_axis(c, "ix", "iy", n, kernel, r)
    return c.select("iy", "ix", "z")


def smoothed_density(pixels: DataFrame, x_col: str = "x_pixel", y_col: str = "y_pixel",
                     value_col: str | None = None, size: int = MAX_SIZE * SCALE, resolution: int | None = None,
                     window: int | None = None, blank_thresh: float = BLANK_THRESH) -> DataFrame:
    """Bin, blur with sigma = window, blank cells <= threshold, crop the padding.

    Returns ``(iy, ix, z)`` in the cropped grid (0 .. resolution-1); blank
    cells are absent.
    """
    res = resolution or size
    w = window or default_window(res)  # 0 means the default too
    imgw = res + 2 * w
    cells = grid_cells(pixels, x_col, y_col, value_col, size, res, w)
    z = gaussian_smooth(cells, imgw, float(w))
    z = z.where((F.col("z") > blank_thresh) & F.col("iy").between(w, w + res - 1) & F.col("ix").between(w, w + res - 1))
    return z.select((F.col("iy") - w).alias("iy"), (F.col("ix") - w).alias("ix"), "z")
