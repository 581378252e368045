"""Exact quantile cuts by distributed rank selection (M4)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 512


@dataclass
class _Bin:
    """``n`` values from ``lo`` to ``hi`` with ``below`` smaller ones in the column."""

    lo: float
    hi: float
    below: int
    n: int


def exact_cuts(df: DataFrame, cols: list[str], num_buckets: int, bins: int = BINS) -> dict[str, list[float]]:
    """Per column the distinct values of rank ceil(i * n / num_buckets), i = 1 .. num_buckets - 1, of its n values
    (NULL and NaN apart).

    Each pass counts the values of all columns in equal-width bins by a partial aggregate, so nothing is sorted and
    only counts are shuffled. Bins that hold a wanted rank are divided anew in the next pass, from their least to their
    greatest value, until they hold a single value: a handful of passes for any doubles. The driver gets at most
    len(cols) * num_buckets * bins counts a pass.
    """
    spark = df.sparkSession
    tall = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v"))
                                         for i, c in enumerate(cols)])).alias("e"))
    tall = tall.select("e.c", "e.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    finite = F.when(F.abs("v") < math.inf, F.col("v"))
    cuts: list[set[float]] = [set() for _ in cols]
    open_ranks: dict[int, set[int]] = {}
    found: dict[tuple, _Bin] = {}  # by (column, bin of the first pass, bin of the second, ...)
    for r in tall.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.count(finite).alias("m"),
                                   F.count(F.when(F.col("v") == -math.inf, 1)).alias("under"),
                                   F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect():
        ranks = {-(-i * r["n"] // num_buckets) for i in range(1, num_buckets)}
        inner = {k for k in ranks if r["under"] < k <= r["under"] + r["m"]}
        cuts[r["c"]] |= {-math.inf if k <= r["under"] else math.inf for k in ranks - inner}
        open_ranks[r["c"]] = inner
        if r["m"]:
            found[(r["c"],)] = _Bin(r["lo"], r["hi"], r["under"], r["m"])
    passes: list[list[tuple]] = []
    while True:
        active: dict[tuple, _Bin] = {}
        for key, b in found.items():
            if held := {k for k in open_ranks[key[0]] if b.below < k <= b.below + b.n}:
                if b.lo == b.hi:
                    cuts[key[0]].add(b.lo)
                    open_ranks[key[0]] -= held
                else:
                    active[key] = b
        if not active:
            return {c: sorted(cuts[i]) for i, c in enumerate(cols)}
        passes.append([(*key, b.lo, b.hi, 0.5 if math.isinf(b.hi - b.lo) else 1.0) for key, b in active.items()])
        rows, keys = tall.where(F.abs("v") < math.inf), ["c"]
        for depth, ranges in enumerate(passes):  # a row for each open rank of a column at most
            table = spark.createDataFrame(ranges, ", ".join(f"{k} int" for k in keys) + ", lo double, hi double, f double")
            share = (F.col("v") * F.col("f") - F.col("lo") * F.col("f")) / (F.col("hi") * F.col("f") - F.col("lo") * F.col("f"))
            rows = rows.join(F.broadcast(table), keys).withColumn(
                f"b{depth}", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")).drop("lo", "hi", "f")
            keys.append(f"b{depth}")
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        below = {key: b.below for key, b in active.items()}
        found = {}
        for r in sorted(counts, key=lambda r: tuple(r[k] for k in keys)):
            key = tuple(r[k] for k in keys)
            found[key] = _Bin(r["lo"], r["hi"], below[key[:-1]], r["n"])
            below[key[:-1]] += r["n"]
