"""Cluster hulls and colour ranks.

The convex hull of a cluster is computed in rounds so no task ever holds a
whole cluster, and many clusters are merged in one call:

1. per input partition: the Arrow batches of all clusters are gathered to
   BUFFER_ROWS rows and replaced by the hull vertices of each cluster;
2. vertices dealt by (cluster, salt), salt = hash of the point modulo
   ``fan_in``: hulls of the partial hulls, in the same way;
3. vertices dealt by cluster and sorted: the final hulls, a stretch of whole
   clusters at a time.

The hull of a union equals the hull of the union of hulls, so every round
is exact; in rounds 1 and 2 a full buffer may be passed on as it is, which
bounds the state. One call of numpy takes out points of all clusters at
once, so its cost follows the points, not the number of clusters.

Vertices are listed counter-clockwise from the lowest (x, y); points on an
edge are not vertices. Clusters with fewer than ``min_points`` points, or
whose points are all collinear, get no polygon.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import with_position

# The Arrow functions below run in Python workers. Ship this module's code
# with them (by value) so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUFFER_ROWS = 1 << 18
#: Rounds in which all clusters are thinned at once; what is left then is finished point by point.
THIN_ROUNDS = 24

_PARTIAL = "cluster long, x double, y double, n long"
_FINAL = "cluster long, vertex int, x double, y double, n_points long"


def _turn(x: np.ndarray, y: np.ndarray, o, a, p):
    """Positive where the way o, a, p turns left at a."""
    return (x[a] - x[o]) * (y[p] - y[o]) - (y[a] - y[o]) * (x[p] - x[o])


def _half(cluster: np.ndarray, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The points ``at`` (indexes, by cluster and along x) that make the left-turning half hull of their cluster.

    A point that does not turn left between its neighbours lies on the inner side of their segment, so it is no
    vertex; all such points go at once, until there are none.
    """
    for _ in range(THIN_ROUNDS):
        o, a, p = at[:-2], at[1:-1], at[2:]
        out = (cluster[o] == cluster[p]) & (_turn(x, y, o, a, p) <= 0)
        if not out.any():
            return at
        at = np.delete(at, np.flatnonzero(out) + 1)
    kept: list[int] = []
    start = 0  # of the current cluster in kept
    for p in at.tolist():
        if kept and cluster[kept[-1]] != cluster[p]:
            start = len(kept)
        while len(kept) - start >= 2 and _turn(x, y, kept[-2], kept[-1], p) <= 0:
            kept.pop()
        kept.append(p)
    return np.array(kept, np.int64)


def hull_vertices(cluster: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cluster, x, y, n) of the hull vertices of every cluster, in order; the sum of a cluster's ``n`` stands at its first vertex."""
    order = np.lexsort((y, x, cluster))
    cluster, x, y, n = cluster[order], x[order], y[order], n[order]
    new = np.append(True, cluster[1:] != cluster[:-1])[:len(cluster)]
    total = np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n
    at = np.flatnonzero(new | np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[:len(cluster)])  # repeated points once
    lower, upper = _half(cluster, x, y, at), _half(cluster, x, y, at[::-1])[::-1]
    ends = np.append(True, cluster[upper[1:]] != cluster[upper[:-1]])[:len(upper)]
    inner = upper[~(ends | np.append(ends[1:], True)[:len(upper)])]  # of the upper half without its end points
    way = np.concatenate((lower, inner))
    place = np.concatenate((lower, 2 * len(cluster) - inner))
    way = way[np.lexsort((place, cluster[way]))]
    first = np.append(True, cluster[way][1:] != cluster[way][:-1])[:len(way)]
    counts = np.zeros(len(way), np.int64)
    counts[first] = total
    return cluster[way], x[way], y[way], counts


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))


def _joined(parts: list) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(c) for c in zip(*parts))


def _partial_batch(columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "x", "y", "n"])


def _partial_hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rounds 1 and 2: hull vertices of all clusters in a partition, or of each full buffer that does not shrink."""
    parts, rows = [], 0
    for batch in batches:
        parts.append(_columns(batch))
        rows += batch.num_rows
        if rows >= BUFFER_ROWS:
            parts = [hull_vertices(*_joined(parts))]
            rows = len(parts[0][0])
            if rows > BUFFER_ROWS // 2:
                yield _partial_batch(parts[0])
                parts, rows = [], 0
    if rows:
        yield _partial_batch(hull_vertices(*_joined(parts)))


def _final_hulls(min_points: int):
    """Round 3: the clusters of a sorted partition, each whole."""
    def polygons(columns) -> pa.RecordBatch:
        cluster, x, y, n = hull_vertices(*columns)
        start = np.flatnonzero(np.append(True, cluster[1:] != cluster[:-1])[:len(cluster)])
        size = np.diff(np.append(start, len(cluster)))
        vertex = np.arange(len(cluster)) - np.repeat(start, size)
        points = np.repeat(n[start], size)
        keep = (np.repeat(size, size) >= 3) & (points >= min_points)
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (cluster, vertex.astype(np.int32), x, y, points)],
                                          ["cluster", "vertex", "x", "y", "n_points"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(_columns(batch))
                rows += batch.num_rows
            if rows >= BUFFER_ROWS:
                held = _joined(parts)
                cut = np.searchsorted(held[0], held[0][-1])  # the last cluster may go on in the next batch
                if cut:
                    yield polygons(tuple(c[:cut] for c in held))
                parts = [hull_vertices(*(c[cut:] for c in held))]
                rows = len(parts[0][0])
        if rows:
            yield polygons(_joined(parts))
    return run


def cluster_sizes(points: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Points per cluster."""
    return points.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n_points"))


def cluster_hulls(points: DataFrame, cluster_col: str = "cluster", x_col: str = "x_pixel", y_col: str = "y_pixel",
                  min_points: int = 3, fan_in: int = 64) -> DataFrame:
    """G7 + A14: ``(cluster, vertex, x, y, n_points)`` hull vertices per cluster, in order.

    Point counts travel with the partial hulls, so the points are scanned
    once and clusters under ``min_points`` are dropped in the final round.
    """
    pts = points.select(F.col(cluster_col).cast("long").alias("cluster"), F.col(x_col).cast("double").alias("x"),
                        F.col(y_col).cast("double").alias("y"), F.lit(1).cast("long").alias("n")) \
                .where(F.col("cluster").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
                       & ~F.isnan("x") & ~F.isnan("y"))
    partial = pts.mapInArrow(_partial_hulls, _PARTIAL)
    salted = partial.repartition("cluster", F.pmod(F.xxhash64("x", "y"), F.lit(fan_in)))
    merged = salted.mapInArrow(_partial_hulls, _PARTIAL)
    final = merged.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(_final_hulls(min_points), _FINAL)
    return final.withColumnRenamed("cluster", cluster_col) if cluster_col != "cluster" else final


def cluster_ranks(points: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """A13 + G10: distinct cluster ids with a colour rank n-1 .. 0 in id order, ranked in two steps (see ``ranks``)."""
    ids = points.select(cluster_col).where(F.col(cluster_col).isNotNull()).distinct()
    ranked = with_position(ids, [F.col(cluster_col).desc()], "color_rank")
    return ranked.withColumn("color_rank", F.col("color_rank").cast("int"))
