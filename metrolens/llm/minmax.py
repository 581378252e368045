"""Near-duplicate documents by min-max hashing.

Method: a document's set of 5-word shingles is hashed under PERMUTATIONS functions, of which each gives two
signature values, its minimum and its maximum: half the hash evaluations for the same length, unbiased, and of
lower variance since the two move against each other. ROWS values make a band; documents that agree in a band are
candidates (at similarity 0.75 a link is missed with probability 0.00008 between large sets; minimum and maximum of one
permutation agree together with chance i (i - 1) / (u (u - 1)) for i common of u shingles, so short texts miss more:
0.0016 at 3 of 4 shingles, 0.00033 at 6 of 8). Pairs whose signatures agree in fewer
values than a similarity of 0.75 gives, less four standard deviations, are left out unread (four bits a value are
compared; a link at 0.75 is missed with probability 0.00003). So are pairs that a bitmap of hashed shingles rules out:
a bit that only one of them has stands for a shingle that the other lacks, which bounds the intersection from above
without error. Documents of the same word sequence are first joined in one class. Candidates are confirmed on their full sets of shingles: 100 * intersection >=
75 * union. Buckets are linked by hubs (see ``linking``), so groups of thousands of copies cost no pairs.

Words: A-Z lower-cased, runs outside ``[\\x20\\x09-\\x0D]``. With fewer than five words the whole sequence is the only
shingle. Without words (or with a null text) the set is empty and linked with nothing.

A row with a null doc_id has no name in a group: it is linked with nothing and kept. Rows that repeat a doc_id are
one document in the links. An empty table gives an empty result. Other columns are ignored. Rows get their id
in a copy of ``docs`` that is written once and read by all later scans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import broadcast_if_small, numbered, settled, ship, text_columns, text_rows
from metrolens.llm.linking import link, shared_buckets

ship(__name__)

SHINGLE = 5
BANDS, ROWS = 48, 6
PERMUTATIONS = BANDS * ROWS // 2
THRESHOLD = 75  # per cent
SKETCH = (2 * PERMUTATIONS + 15) // 16  # longs of four-bit values
#: Least agreeing four-bit values: J + (1 - J) / 16 agree on average.
_SHARE = THRESHOLD / 100 + (1 - THRESHOLD / 100) / 16
AGREE = int(2 * PERMUTATIONS * _SHARE - 4 * (2 * PERMUTATIONS * _SHARE * (1 - _SHARE)) ** 0.5)
BITMAP = 16  # longs of a document's bitmap of shingles
SEED = 20_240_917


def word_list(text: str) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII letters and the six ASCII white-space characters only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes]) -> set:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE))))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinMax:
    """Shingle hashes, signatures and bands of texts."""

    def __init__(self, permutations: int = PERMUTATIONS, bands: int = BANDS):
        rng = np.random.default_rng(SEED)
        draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base, self.places = draw(1)[0], draw(SHINGLE)
        self.mult, self.flip = draw(permutations), draw(permutations)
        self.bands, self.salts = bands, draw(bands)
        self.inverse = self.power(self.base, (1 << 62) - 1)  # the odd residues form a group of exponent 2^62
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def power(base: np.uint64, n: int) -> np.uint64:
        return np.uint64(pow(int(base), n, 1 << 64))

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        """A 64-bit polynomial hash per word, computed over the joined bytes."""
        data = np.frombuffer(b" ".join(words), np.uint8)
        self.powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=total[1:])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        return mixed((total[ends] - total[starts]) * self.down[starts])

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Distinct 64-bit hashes of the shingle set."""
        if not words:
            return np.empty(0, np.uint64)
        h = self.word_hashes(words)
        n = max(1, len(h) - SHINGLE + 1)
        s = np.full(n, np.uint64(min(len(h), SHINGLE)), np.uint64)
        for i in range(min(SHINGLE, len(h))):
            s += h[i:i + n] * self.places[i]
        return np.unique(mixed(s))

    def signature(self, s: np.ndarray) -> np.ndarray:
        """(minimum, maximum) under each permutation, as rows."""
        out = np.empty((len(self.mult), 2), np.uint64)
        step = max(1, (1 << 17) // len(s))
        for i in range(0, len(self.mult), step):
            x = (s[None, :] ^ self.flip[i:i + step, None]) * self.mult[i:i + step, None]
            x ^= x >> np.uint64(32)
            out[i:i + step, 0], out[i:i + step, 1] = x.min(axis=1), x.max(axis=1)
        return out

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        values = signature.reshape(self.bands, -1)
        key = self.salts.copy()
        for i in range(values.shape[1]):
            key = mixed(key ^ values[:, i])
        return key.view(np.int64)

    @staticmethod
    def sketch(signature: np.ndarray) -> np.ndarray:
        """Four bits of each value, 16 values to a long."""
        four = np.zeros(-(-signature.size // 16) * 16, np.uint64)
        four[:signature.size] = (signature.reshape(-1) >> np.uint64(20)) & np.uint64(15)
        return np.bitwise_or.reduce(four.reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1).view(np.int64)

    @staticmethod
    def bitmap(s: np.ndarray) -> np.ndarray:
        """One bit for each shingle hash, in BITMAP longs."""
        bits = np.zeros(64 * BITMAP, np.uint8)
        bits[(s % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
        return np.packbits(bits).view(np.int64)


def signatures(rows: DataFrame) -> DataFrame:
    """Of rows with a uid, doc_id and text: uid, doc_id, n_shingles long, sequence binary (digest of the words), bands, sketch and bitmap array<long>; the
    last four are null without words."""
    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sequence", pa.binary()),
              ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("bitmap", pa.list_(pa.int64()))]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = MinMax()
        for batch in batches:
            sizes, digests, bands, sketches, bitmaps = [], [], [], [], []
            for text in batch.column(2):
                words = word_list(text.as_py())
                s = kernel.shingles(words)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                signature = kernel.signature(s) if words else None
                bands.append(kernel.band_keys(signature) if words else None)
                sketches.append(kernel.sketch(signature) if words else None)
                bitmaps.append(kernel.bitmap(s) if words else None)
            columns = [batch.column(0), batch.column(1), *(pa.array(c, t) for c, (_, t) in zip((sizes, digests, bands, sketches, bitmaps), fields[2:]))]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    return rows.select("uid", "doc_id", "text").mapInArrow(sign, "uid long, doc_id long, n_shingles long, sequence binary, bands array<long>, sketch array<long>, bitmap array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of which the full shingle sets meet the threshold; ``texts`` has (node, text)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, of = None, None
        for batch in batches:
            a, b = [], []
            for x, y, s, t in zip(*(batch.column(i) for i in range(4))):
                if kept != x.as_py():
                    kept, of = x.as_py(), shingle_set(word_list(s.as_py()))
                other = shingle_set(word_list(t.as_py()))
                both = len(of & other)
                if 100 * both >= THRESHOLD * (len(of) + len(other) - both):
                    a.append(kept)
                    b.append(y.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    left, right = (texts.select(F.col("node").alias(c), F.col("text").alias(t)) for c, t in (("a", "s"), ("b", "t")))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "s", "t")
    return joined.mapInArrow(compare, "a long, b long").distinct()


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: uid, doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    return groups_of_rows(numbered(text_rows(docs)))


def groups_of_rows(rows: DataFrame) -> DataFrame:
    """``near_groups`` of rows with a written uid, doc_id and text."""
    signed = settled(signatures(rows))
    named = signed.filter("sequence is not null and doc_id is not null")
    first = F.min_by(F.struct("uid", "bands", "sketch", "bitmap"), F.struct("doc_id", "uid")).alias("first")
    classes = settled(named.groupBy("sequence").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), first)
                      .select("sequence", "node", "size", "first.*"))
    live = shared_buckets(classes.select(F.explode("bands").alias("k"), "node"))
    who = settled(live.select("node").distinct())
    known = settled(classes.join(broadcast_if_small(who, 24), "node", "left_semi")
                    .select("uid", "node", "size", "sketch", "bitmap", "bands",
                            sum(F.bit_count(F.col("bitmap")[i]) for i in range(BITMAP)).alias("bits")))
    texts = settled(rows.select("uid", "text").join(broadcast_if_small(known.select("uid", "node"), 40), "uid").select("node", "text"))

    def may(x: str, y: str) -> Column:
        return 100 * F.least(f"{x}.size", f"{y}.size") >= THRESHOLD * F.greatest(f"{x}.size", f"{y}.size")

    def alike(x: str, y: str) -> Column:
        differ = 0
        for i in range(SKETCH):
            d = F.get(f"{x}.sketch", F.lit(i)).bitwiseXOR(F.get(f"{y}.sketch", F.lit(i)))
            d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
            differ += F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111)))
        common = sum(F.bit_count(F.get(f"{x}.bitmap", F.lit(i)).bitwiseAND(F.get(f"{y}.bitmap", F.lit(i)))) for i in range(BITMAP))
        most = common + F.least(F.col(f"{x}.size") - F.col(f"{x}.bits"), F.col(f"{y}.size") - F.col(f"{y}.bits"))
        may_link = 100 * most >= THRESHOLD * (F.col(f"{x}.size") + F.col(f"{y}.size") - most)
        # A pair is given in one of its buckets: rows of different groups never share a bucket that is left behind.
        once = F.col(f"{x}.k") == F.array_min(F.array_intersect(f"{x}.bands", f"{y}.bands"))
        return may_link & (differ <= 2 * PERMUTATIONS - AGREE) & once

    labels = link(live, known.select("node", "size"), lambda pairs: confirmed(pairs, texts), may,
                  known.drop("uid", "size"), alike)
    final = classes.select("sequence", "node")
    if labels is not None:
        final = final.join(labels, "node", "left").select("sequence", F.coalesce("component", "node").alias("node"))
    final = settled(final)
    # Both sides are shuffled for this join alone, so adaptive execution can split a class of many copies.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))
    return signed.select("uid", "doc_id", "n_shingles", "sequence").join(final, "sequence", "left").select(
        "uid", "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group; all columns as they were."""
    rows = numbered(docs, "__uid")
    groups = groups_of_rows(rows.select(F.col("__uid").alias("uid"), *text_columns()))
    stays = groups.filter("kept").select(F.col("uid").alias("__uid"))
    return rows.join(stays, "__uid", "left_semi").drop("__uid")
