"""Positions of rows in a global order, without a window over all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

_IN_PARTITION = (1 << 33) - 1  # the bits of monotonically_increasing_id below the partition number


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with its 0-based place in ``order``; give columns that make the order total.

    Two steps: rows are range-partitioned and sorted, and written once with their place in the partition; the
    partitions' sizes (a row each) then give the offset of each. No task sees more than its range.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright("_at", 33)
    offsets, before = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((r["part"], before))
        before += r["count"]
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_at")
    by_part = spark.createDataFrame(offsets, "_part long, _offset long")
    return (placed.join(F.broadcast(by_part), part == F.col("_part"))
            .withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND(F.lit(_IN_PARTITION))).drop("_at", "_part", "_offset"))
