"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metrolens.session import checkpoint_root, scratch_path

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ship(module: str) -> None:
    """Send the code of ``module`` with each task, so that workers need no installed copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker (shipped code itself is loaded anew for each task)."""
    holder = sys.modules.setdefault("_metrolens_process_cache", types.ModuleType("_metrolens_process_cache"))
    return holder.__dict__.setdefault(name, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """doc_id long, text string, null text as empty."""
    return [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), null text as empty; all other columns are left behind, so no name can clash."""
    return docs.select(*text_columns(id_col, text_col))


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: lineage ends here and lost executors lose nothing."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, files: int | None = None, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, in at most ``files`` files if given. For frames made again and
    again from themselves: a checkpoint keeps the planner's size estimate, a product over all joins so far whose digits
    grow exponentially with the rounds, while a table has its real size."""
    path, conf = path or scratch_path(df.sparkSession, "written"), df.sparkSession.conf
    # The shuffles behind a table go as soon as it is written, not when the driver happens to collect its garbage.
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        (df if files is None else df.coalesce(files)).write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(df: DataFrame, path: str) -> None:
    """Gives up the rows of a table ``written`` to ``path`` that nothing reads any more."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def written_count(df: DataFrame, files: int | None = None) -> tuple[DataFrame, int]:
    """``written`` and its number of rows, counted while it is written."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("n")), files)
    return out, seen.get["n"]


def numbered(df: DataFrame, name: str = "uid") -> DataFrame:
    """``df`` with a row id ``name``, written once to the shared checkpoint folder and read from there. An id made anew in
    a second scan names other rows if the files are split anew, as they are when the number of cores changes."""
    path = scratch_path(df.sparkSession, "numbered")
    df.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """``df`` marked for broadcast if its counted rows times ``row_bytes`` stay below ``limit``; else left to a
    shuffled join. Call it on settled frames: the count is a job."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def as_pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i + 1, n)]


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
