"""Hard negatives by rotated one-bit codes.

Method: a row's vector of integers is rotated by a fixed random orthogonal matrix. Its code is the sign of each
component, and beside it stands the code's alignment with the vector (the mean magnitude, by which the signs are
multiplied); what is left is coded in the same way, LEVELS times. Of the last remainder only the length is kept. An
anchor's rotated vector is rounded to PLANES bits a component, so that its product with a code is a sum of popcounts. The
product of the two vectors then lies in an interval around the estimate by the Cauchy-Schwarz inequality: remainder length
times anchor length, and length of the decoded row times length of the anchor's rounding error. The interval is certain, so a row
whose interval cannot reach the best found so far is out, and the rest are scored by integers: the result is exact.

Layout: rows in blocks of bounded size, anchors stream past each (see ``vectors``). A block first scores the rows with the highest
estimates; the last place among these is the bar for the intervals of all others. Positives come first: 5 of a block
at most for an anchor, 5 in all. The second pass takes the anchors with their positives' scores and returns at most 10 rows
of a block for each anchor and positive.

Integers: floor(256 * x); beyond sqrt(2^62 / components) they saturate, so that a score fits a long.

Nulls: rows with a null label, a null or empty vector, a null or non-finite component take no part, nor do vectors of
another length than most. All-zero vectors take part. A null vec_id is no anchor, keeps its label, and comes last in ties. Rows that repeat
a vec_id are rows of their own: each an anchor of its own, and a candidate for the others. Ties of score go to the smaller vec_id. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import settled, ship
from metrolens.llm.vectors import NO_ID, binaries, block_count, meet, vector_rows

ship(__name__)

LEVELS, PLANES = 3, 6
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
FIRST = 32  # rows scored for a bar at first
SLACK = 1e-9  # for rounding, as a share of both lengths


def rotation(d: int) -> np.ndarray:
    """A fixed orthogonal matrix: the first factor of a Gaussian matrix, signs by the second's diagonal."""
    q, r = np.linalg.qr(np.random.default_rng(20_241).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def integers(x: np.ndarray) -> np.ndarray:
    most = int((2**62 / x.shape[1]) ** 0.5)
    return np.clip(np.floor(256 * x), -most, most).astype(np.int64)


def as_words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


class Codes:
    """Of rows of integers, per level: signs as words, their number of ones, alignments; lengths of the row, of its decoded
    vector and of the remainder."""

    def __init__(self, v: np.ndarray, turn: np.ndarray):
        u = v @ turn.T
        rest = u.copy()
        signs, ones, align = [], [], []
        for _ in range(LEVELS):
            bits = rest > 0
            c = np.abs(rest).mean(1)
            rest -= np.where(bits, 1.0, -1.0) * c[:, None]
            signs.append(as_words(bits))
            ones.append(bits.sum(1))
            align.append(c)
        self.signs = np.ascontiguousarray(np.stack(signs).transpose(2, 0, 1))  # word, level, row
        self.ones, self.align = np.stack(ones), np.stack(align)
        self.length, self.decoded, self.remainder = (np.sqrt((x * x).sum(1)) for x in (u, u - rest, rest))

    def take(self, at: np.ndarray) -> Codes:
        out = object.__new__(Codes)
        out.signs, out.ones, out.align = self.signs[:, :, at], self.ones[:, at], self.align[:, at]
        out.length, out.decoded, out.remainder = self.length[at], self.decoded[at], self.remainder[at]
        return out

    def interval(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimate, half width) of the product of each row with a rotated anchor."""
        low = anchor.min()
        step = (anchor.max() - low) / ((1 << PLANES) - 1) or 1.0
        levels = np.rint((anchor - low) / step).astype(np.int64)
        rounded = low + step * levels
        planes = as_words((levels[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool))
        count = np.zeros(self.ones.shape, np.int32)  # sum of the anchor's levels where the sign is one
        for plane in planes[::-1]:
            count <<= 1
            for signs, word in zip(self.signs, plane):
                count += np.bitwise_count(signs & word)
        product = 2 * (low * self.ones + step * count) - rounded.sum()
        size, off = np.sqrt((anchor * anchor).sum()), anchor - rounded
        width = self.remainder * size + self.decoded * np.sqrt((off * off).sum()) + SLACK * self.length * size
        return (self.align * product).sum(0), width


class Block:
    """Rows of one block and their codes."""

    def __init__(self, rows: pa.Table):
        self.label, self.ids, self.uids = (np.asarray(rows[c]) for c in ("tag", "id", "uid"))
        self.v = binaries(rows["data"], "<i8", len(rows["data"][0].as_py()) // 8)
        self.turn = rotation(self.v.shape[1])
        self.codes = Codes(self.v.astype(float), self.turn)

    def best(self, at: np.ndarray, anchor: np.ndarray, estimate: np.ndarray, width: np.ndarray, k: int, low=None, high=None):
        """The first ``k`` of the rows ``at`` by integer score (then id), with ``low`` <= 100 * score <= ``high`` if given:
        (rows, scores). ``estimate`` and ``width`` are of these rows."""
        upper, lower = estimate + width, estimate - width
        may = np.ones(len(at), bool) if low is None else (100 * upper >= low) & (100 * lower <= high)
        at, estimate, upper = at[may], estimate[may], upper[may]

        def scored(rows):
            score = self.v[rows] @ anchor
            fits = np.ones(len(rows), bool) if low is None else (100 * score >= low) & (100 * score <= high)
            return rows[fits], score[fits]

        bar = -np.inf
        if len(at) > FIRST:
            likely = estimate if low is None else np.where(100 * estimate <= high, estimate, -np.inf)
            _, first = scored(at[np.argpartition(likely, len(at) - FIRST)[-FIRST:]])
            if len(first) >= k:
                bar = np.partition(first, len(first) - k)[-k]
        rows, score = scored(at[upper >= bar])
        order = np.lexsort((self.uids[rows], self.ids[rows], -score))[:k]
        return rows[order], score[order]


def anchors_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(uid, id, label, integers, scores of the positives) of each anchor in a batch."""
    for uid, vec_id, label, data, more in zip(*(batch.column(c).to_pylist() for c in ("uid", "id", "tag", "data", "more"))):
        yield uid, vec_id, label, np.frombuffer(data, "<i8"), np.frombuffer(more or b"", "<i8")


def joined(parts: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)


def find_positives(block: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Of each anchor the block's first POSITIVES rows of its label."""
    out, of_label = [], {}
    for uid, vec_id, label, v, _ in anchors_of(batch):
        if label not in of_label:
            at = np.flatnonzero(block.label == label)
            of_label[label] = at, block.codes.take(at)
        at, codes = of_label[label]
        estimate, width = codes.interval(block.turn @ v)
        other = block.uids[at] != uid
        rows, score = block.best(at[other], v, estimate[other], width[other], POSITIVES)
        n = len(rows)
        out.append((np.full(n, uid), np.full(n, vec_id), block.uids[rows], block.ids[rows], score))
    yield from joined(out, POSITIVE_COLUMNS)


def find_negatives(block: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Of each anchor and positive (by place) the block's first NEGATIVES rows of other labels within the bounds."""
    out = []
    for uid, vec_id, label, v, positives in anchors_of(batch):
        at = np.flatnonzero(block.label != label)
        estimate, width = (x[at] for x in block.codes.interval(block.turn @ v))
        for place, positive in enumerate(positives.tolist()):
            rows, score = block.best(at, v, estimate, width, NEGATIVES, LOW * positive, HIGH * positive)
            n = len(rows)
            out.append((np.full(n, uid), np.full(n, place), block.uids[rows], block.ids[rows], score))
    yield from joined(out, NEGATIVE_COLUMNS)


POSITIVE_COLUMNS = ["anchor_uid", "anchor_id", "positive_uid", "positive_id", "positive_score"]
NEGATIVE_COLUMNS = ["anchor_uid", "place", "negative_uid", "negative_id", "negative_score"]


def hard_negatives(table: DataFrame, every: int = 100, relabel: int = 7, labels: int = 10) -> DataFrame:
    """anchor_id, positive_id long, rank int, negative_id, positive_score, negative_score long, for the rows of ``table``
    (vec_id, embedding, label) whose vec_id is divisible by ``every``; where it is divisible by ``relabel`` the label first
    becomes (label + 1) % ``labels``."""
    spark = table.sparkSession
    label = F.col("label").cast("long")
    given = table.withColumn("label", F.when(F.col("vec_id") % relabel == 0, (label + 1) % labels).otherwise(label))
    rows = vector_rows(given, True, "label").filter("label is not null")
    n = rows.count()
    blocks = block_count(n)

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = integers(np.array(batch.column(3).to_pylist(), float))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([x.tobytes() for x in v], pa.binary())], ["uid", "id", "tag", "data"])

    scaled = settled(rows.select("uid", "id", F.col("label").alias("tag"), "vector").mapInArrow(scale, "uid long, id long, tag long, data binary"))
    own = scaled.select(F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"), "*", F.lit(None).cast("binary").alias("more"))
    to_each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    anchors = scaled.filter((F.col("id") != NO_ID) & (F.col("id") % every == 0))

    found = meet(own, anchors.select(to_each, "*", F.lit(None).cast("binary").alias("more")), blocks, Block, find_positives, POSITIVE_COLUMNS)
    order = Window.partitionBy("anchor_uid").orderBy(F.desc("positive_score"), "positive_id", "positive_uid")
    positives = settled(found.withColumn("place", F.row_number().over(order).cast("long") - 1).filter(F.col("place") < POSITIVES))

    listed = positives.groupBy("anchor_uid").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))  # POSITIVES at most
    probes = anchors.join(listed, F.col("uid") == F.col("anchor_uid")).select(to_each, "uid", "id", "tag", "data", as_binary(F.col("p.positive_score")).alias("more"))
    near = meet(own, probes, blocks, Block, find_negatives, NEGATIVE_COLUMNS)
    order = Window.partitionBy("anchor_uid", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_uid")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES)
    named = lambda c: F.nullif(c, F.lit(NO_ID)).alias(c)
    return ranked.join(positives, ["anchor_uid", "place"]).select("anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")


def as_binary(longs):
    """array<long> as little-endian bytes."""
    hexed = F.transform(longs, lambda x: F.lpad(F.hex(x), 16, "0"))
    turned = F.transform(hexed, lambda h: F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(8)]))
    return F.unhex(F.array_join(turned, ""))
