"""Vectors in blocks: what the two searches over ``embeddings`` share.

Rows lie in blocks of bounded size; probes (queries, anchors) are sent to the blocks they need and stream past the
block that a task holds. So a task keeps one block and one batch of probes, whatever the size of the table, and no
frame is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from metrolens.llm.common import numbered, ship

ship(__name__)

#: Rows of the largest block; smaller tables have blocks of BLOCK_ROOTS * sqrt(rows), so that the copies of the probes
#: (one for each block) and the blocks grow alike.
BLOCK_ROWS, BLOCK_ROOTS = 262_144, 8
MAX_PARTITIONS = 16_384
NO_ID = (1 << 63) - 1  # stands for a null vec_id: behind all others in ties


def vector_rows(table: DataFrame, zeros: bool, *more: str) -> DataFrame:
    """uid, id (vec_id, NO_ID if null), vector array<double> and the columns ``more`` of the rows that take part: the vector not null,
    all its components finite, as long as most vectors are (ties: the shorter), and, unless ``zeros``, not all zero.

    The rows are written once, so that uid names the same row in all later scans.
    """
    kind = table.schema["embedding"].dataType
    vector = F.col("embedding") if isinstance(kind, ArrayType) and isinstance(kind.elementType, DoubleType) else F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    rows = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"), vector.alias("vector"), *more)
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite))
    rows = numbered(rows if zeros else rows.filter(F.exists("vector", lambda x: x != 0)))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == common["n"]) if common else rows


def block_count(rows: int) -> int:
    return max(1, math.ceil(rows / BLOCK_ROWS), math.ceil(math.sqrt(rows) / BLOCK_ROOTS))


def binaries(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary values of one length as rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


PACKED = "uid long, id long, tag long, data binary, more binary"


def meet(rows: DataFrame, probes: DataFrame, blocks: int, hold: Callable, probe: Callable, names: list[str]) -> DataFrame:
    """``probe(hold(rows of a block), batch of probes)`` for each block; both frames have ``block int`` and the columns of PACKED.

    ``hold`` gets a table of one block's rows; ``probe`` yields record batches of long columns ``names``.
    """
    both = rows.select("block", F.lit(0).alias("kind"), "uid", "id", "tag", "data", "more").union(
        probes.select("block", F.lit(1).alias("kind"), "uid", "id", "tag", "data", "more"))
    dealt = both.repartition(min(blocks, MAX_PARTITIONS), "block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held = None, [], None
        for batch in batches:
            block, kind = (np.asarray(batch.column(i)) for i in range(2))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip((0, *cuts), (*cuts, len(block))):
                piece = batch.slice(lo, hi - lo).select(["uid", "id", "tag", "data", "more"])
                if block[lo] != at:
                    at, parts, held = block[lo], [], None
                if kind[lo] == 0:
                    parts.append(piece)
                elif parts:
                    held = hold(pa.Table.from_batches(parts).combine_chunks()) if held is None else held
                    yield from probe(held, piece)

    return dealt.mapInArrow(run, ", ".join(f"{n} long" if n != "score" else "score double" for n in names))
