"""Sinks K1-K6: CSV directories, partitioned CSV, small ordered series as JSON.

Writers run on the executors (one file per task); nothing passes through
the driver. Partitioned output replaces the reference's loop of seven
filtered jobs with one job (K3, K4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flatten_arrays(df: DataFrame, sep: str = ",") -> DataFrame:
    """K6: CSV cannot hold arrays; join array cells to text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(sep, F.col(f"`{f.name}`").cast("array<string>")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(cols)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """K1 (header=False) / K2 (header=True): a directory of CSV parts."""
    _flatten_arrays(df).write.mode(mode).option("header", header).csv(path)


def write_partitioned_csv(df: DataFrame, path: str, partition_cols: list[str], header: bool = False,
                          mode: str = "errorifexists", max_records_per_file: int | None = None) -> None:
    """K3/K4: one sub-directory per value of ``partition_cols`` written by a single job.

    No shuffle by the partition value: a hot value (say one weekday holding
    a third of all rows) stays spread over the tasks that produced it, each
    writing its own file per value. ``max_records_per_file`` bounds file size.
    """
    w = _flatten_arrays(df).write.mode(mode).option("header", header)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.partitionBy(*partition_cols).csv(path)


def series_record(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """K5: a bounded result (e.g. 24 hours, 7 days) as one row of two ordered arrays."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key_col).alias("k"), F.col(value_col).alias("v"))))
    return df.agg(pairs.alias("_p")).select(F.col("_p.k").alias("keys"), F.col("_p.v").alias("values"))


def write_series_json(df: DataFrame, key_col: str, value_col: str, path: str, mode: str = "errorifexists") -> None:
    """K5: write ``series_record`` as a single JSON file (the input must be bounded, e.g. <= 24 rows)."""
    series_record(df, key_col, value_col).coalesce(1).write.mode(mode).json(path)
