"""Approximate nearest neighbours by an inverted multi-index.

Method: vectors are cut into two halves, each half is quantised by centroids of its own, and a row lies in the cell of
its pair of centroids. A query sorts the centroids of each half by distance and takes pairs in order of the summed
squared distance from a heap (a pair is pushed once both pairs before it were taken), until its cells hold the share of all rows that the
fit found sufficient. All rows of these cells are reranked by their exact distance in double precision.

Fit: CENTROIDS per half by k-means on a sample of about SAMPLE rows (a hash of the row decides). The share of rows is
the least with which queries of the sample find RECALL of their true neighbours in the sample; nearer neighbours of the
whole table need no more. Vectors without structure need near a half of all rows, clustered ones few. Every row is indexed.

Layout: cells are packed into blocks (see ``vectors``), a cell beyond a block's size is dealt to several. A query goes
to each block once, with the list of its cells there; each block returns its k nearest, and the k best of these stay.

Nulls: rows with a null, empty, or all-zero vector, or with a null or non-finite component, take no part, nor do vectors of another length than
most. A null vec_id is no query; as a neighbour it has rank behind equal distances. Ties go to the smaller vec_id, and
rows repeating a vec_id are rows of their own (only the query's own row is no candidate), each a query of its own. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import settled, ship
from metrolens.llm.vectors import NO_ID, PACKED, binaries, block_count, meet, vector_rows

ship(__name__)

CENTROIDS, SAMPLE, ROUNDS = 64, 16_000, 12
FIT_QUERIES, RECALL = 256, 0.96


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to the rows of c."""
    return np.maximum(0, (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from k distinct rows; a centre left without rows stays."""
    if not x.shape[1]:  # a half without components
        return np.zeros((1, 0))
    distinct = np.unique(x, axis=0)
    c = distinct[np.random.default_rng(7).choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        near = squared(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = x.shape[1] // 2
    return x[:, :h], x[:, h:]


class Codebooks:
    """The centroids of both halves and the share of rows that a query visits."""

    def __init__(self, first: np.ndarray, second: np.ndarray, share: float = 1.0):
        self.centres, self.share = (first, second), share

    def cells(self, x: np.ndarray) -> np.ndarray:
        i, j = (squared(h, c).argmin(1) for h, c in zip(halves(x), self.centres))
        return i * len(self.centres[1]) + j

    def traverse(self, q: np.ndarray) -> Iterator[int]:
        """Cells in ascending order of the summed squared distance of their centroids."""
        d1, d2 = (squared(h, c)[0] for h, c in zip(halves(q[None, :]), self.centres))
        o1, o2 = d1.argsort(kind="stable").tolist(), d2.argsort(kind="stable").tolist()
        d1, d2, width = np.sort(d1).tolist(), np.sort(d2).tolist(), len(o2)
        taken = [0] * len(o1)  # of each row of pairs, so many were taken
        heap = [(d1[0] + d2[0], 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield o1[i] * width + o2[j]
            taken[i] = j + 1
            if i + 1 < len(o1) and (j == 0 or taken[i + 1] >= j):
                heapq.heappush(heap, (d1[i + 1] + d2[j], i + 1, j))
            if j + 1 < width and (i == 0 or taken[i - 1] > j + 1):
                heapq.heappush(heap, (d1[i] + d2[j + 1], i, j + 1))


def fit(sample: np.ndarray, k: int, centroids: int = CENTROIDS, recall: float = RECALL) -> Codebooks:
    """Codebooks of a sample (rows of doubles), with the share of rows that finds ``recall`` of its k nearest."""
    books = Codebooks(*(k_means(h, centroids) for h in halves(sample)))
    cells = books.cells(sample)
    size = np.bincount(cells, minlength=len(books.centres[0]) * len(books.centres[1]))
    needs = []
    for at in np.random.default_rng(11).permutation(len(sample))[:FIT_QUERIES]:
        d = squared(sample[at][None, :], sample)[0]
        d[at] = np.inf
        near = d.argsort(kind="stable")[:min(k, len(sample) - 1)]
        order = np.fromiter(books.traverse(sample[at]), np.int64)
        visited = np.empty(len(size))
        visited[order] = np.cumsum(size[order])
        needs += (visited[cells[near]] / len(sample)).tolist()
    books.share = float(np.quantile(needs, recall, method="higher")) if needs else 1.0
    return books


def codebooks(rows: DataFrame, n: int, k: int) -> Codebooks:
    """``fit`` on about SAMPLE rows, in one task; the driver gets the centroids."""
    part = min(1.0, SAMPLE / n)
    chosen = rows.filter(F.pmod(F.xxhash64("id", "uid"), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))).select("vector")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [list(v) for b in batches for v in b.column(0).to_pylist()]
        if x:
            books = fit(np.array(sorted(x)), k)
            yield pa.RecordBatch.from_pylist([{"first": books.centres[0].tobytes(), "second": books.centres[1].tobytes(), "n": len(books.centres[0]),
                                               "m": len(books.centres[1]), "share": books.share}])

    got = chosen.repartition(1).mapInArrow(train, "first binary, second binary, n long, m long, share double").first()
    if got is None:  # a table so small that the hash chose no row
        return codebooks(rows, 1, k)
    return Codebooks(np.frombuffer(got["first"]).reshape(got["n"], -1), np.frombuffer(got["second"]).reshape(got["m"], -1), got["share"])


def place_cells(sizes: dict[int, int], blocks: int) -> dict[int, tuple[int, int]]:
    """cell -> (first block, number of blocks), cells of like number together; a cell beyond a block's share gets blocks of its own."""
    room = -(-sum(sizes.values()) // blocks)
    out, at, used = {}, 0, 0
    for cell in sorted(sizes):
        several = -(-sizes[cell] // room)
        if used and used + sizes[cell] > room:
            at, used = at + 1, 0
        out[cell] = (at, several)
        used += sizes[cell]
        if several > 1:
            at, used = at + several, 0
    return out


def nearest(table: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``table`` (vec_id, embedding) whose vec_id is divisible by ``every``:
    query_id long, rank int, vec_id long, score double (Euclidean distance)."""
    spark = table.sparkSession
    rows = vector_rows(table, zeros=False)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = codebooks(rows, n, k)

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(2).to_pylist(), float)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(books.cells(x)), pa.array([v.tobytes() for v in x], pa.binary())],
                                                 ["uid", "id", "tag", "data"])

    index = settled(rows.select("uid", "id", "vector").mapInArrow(quantise, "uid long, id long, tag long, data binary"))
    sizes = {r["tag"]: r["count"] for r in index.groupBy("tag").count().collect()}  # at most CENTROIDS ** 2 rows
    placed = place_cells(sizes, block_count(n))
    blocks = max(first + several for first, several in placed.values())
    by_cell = spark.createDataFrame([(c, *p) for c, p in placed.items()], "tag long, first int, several int")
    entries = index.join(F.broadcast(by_cell), "tag").select(  # a row for each cell in use
        (F.col("first") + F.pmod(F.xxhash64("uid"), "several")).cast("int").alias("block"), "uid", "id", "tag", "data", F.lit(None).cast("binary").alias("more"))
    wanted = books.share * n

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for uid, vec_id, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lists: dict[int, list[int]] = {}
                seen = 0
                for cell in books.traverse(np.frombuffer(data)):
                    if seen >= wanted and seen > k:
                        break
                    if cell in placed:
                        seen += sizes[cell]
                        for block in range(placed[cell][0], sum(placed[cell])):
                            lists.setdefault(block, []).append(cell)
                out += [(block, uid, vec_id, 0, data, np.array(cells, "<i8").tobytes()) for block, cells in lists.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names, kinds = ["block", "uid", "id", "tag", "data", "more"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    probes = index.filter((F.col("id") != NO_ID) & (F.col("id") % every == 0)).select("uid", "id", "data").mapInArrow(route, "block int, " + PACKED)

    def hold(block: pa.Table):
        cell = np.asarray(block["tag"])
        order = np.argsort(cell, kind="stable")
        x = binaries(block["data"], "<f8", len(block["data"][0].as_py()) // 8)
        return cell[order], x[order], np.asarray(block["id"])[order], np.asarray(block["uid"])[order]

    def rerank(held, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cell, x, ids, uids = held
        out = []
        for uid, vec_id, data, more in zip(*(batch.column(c).to_pylist() for c in ("uid", "id", "data", "more"))):
            lists = np.frombuffer(more, "<i8")
            lo, hi = np.searchsorted(cell, lists), np.searchsorted(cell, lists, "right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
            at = at[uids[at] != uid]
            away = x[at] - np.frombuffer(data)
            d = np.sqrt((away * away).sum(1))
            if len(d) > k:
                near = d <= np.partition(d, k - 1)[k - 1]
                at, d = at[near], d[near]
            best = np.lexsort((uids[at], ids[at], d))[:k]
            out.append((np.full(len(best), uid), np.full(len(best), vec_id), ids[at][best], uids[at][best], d[best]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], found)

    found = ["query_uid", "query_id", "vec_id", "uid", "score"]
    near = meet(entries, probes, blocks, hold, rerank, found)
    order = Window.partitionBy("query_uid").orderBy("score", "vec_id", "uid")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")
