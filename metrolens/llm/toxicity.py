"""Toxicity by non-negative positive-unlabelled learning.

Method: a linear classifier in numpy learns from confirmed toxic texts (P) and texts of unknown class (U) only; clean
labels serve for the class prior alone. With prior pi and logistic loss l the risk is
pi * E_P[l(+)] + max(0, E_U[l(-)] - pi * E_P[l(-)]): the second part estimates the risk on clean texts by correcting U
for its toxic share, and is kept from falling below zero (when it does, the step goes the other way).

Features of a text: its distinct words (runs of letters, lower case) and their beginnings of 4 to 6 letters, so that
inflected forms share a stem. Features are screened by their document counts in P against U.

Training data are bounded, documented samples: MAX_POSITIVE and MAX_UNLABELLED texts, chosen by the smallest hash of
doc_id among rows of the training folds (crc32(doc_id) mod 3 is not 1); equal texts count once. The class prior is
the toxic share of all training labels. Features of the sample are found, counted and screened by Spark; training runs in
one task over the numbers of the screened ones, without texts; scoring reads every whole text.

Nulls: a null text is empty; empty texts get the score of a text without features. A null doc_id isn't held out and
never matches a label; null labels teach nothing. Repeated rows are scored each. Without toxic training texts every
score is 0. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrolens.llm.common import settled, ship, text_rows, written

ship(__name__)

MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
MAX_FEATURES = 8192
SAMPLE_TASKS = 24  # that find the features of the sample
PORTION = 1 << 17  # features of a batch, so that no task holds those of many texts
STEMS = (4, 5, 6)
CLEAR, TIMES = 8, 5  # standard errors and ratio by which a feature must be more frequent in P than in clean text
THRESHOLD = 0.7
LETTERS = re.compile(r"[^\W\d_]+")
BIAS = ""  # the name under which a model keeps its bias


def features(text: str) -> set[str]:
    words = set(LETTERS.findall(text.lower()))
    return words.union(*({w[:n] for w in words if len(w) > n} for n in STEMS))


def hits_batch(rows: list[tuple[int, bool, bool, pa.Array]]) -> pa.RecordBatch:
    """Rows (id, p, u, features), one for each feature."""
    times = [len(r[3]) for r in rows]
    ids, p, u = (np.repeat(np.array(c, t), times) for c, t in zip(zip(*(r[:3] for r in rows)), (np.int64, bool, bool)))
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(p), pa.array(u), pa.concat_arrays([r[3] for r in rows])],
                                      names=["row", "p", "u", "feature"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def screened(counts: DataFrame, n_p: int, n_u: int, prior: float) -> list[str]:
    """Of ``counts`` (feature, in_p, in_u): features more frequent in P than in U by a clear margin, the clearest first."""
    least = 2 if n_p < 100 else max(3, n_p // 500)
    p, u = F.col("in_p") / n_p, F.col("in_u") / n_u
    shares = counts.filter((F.col("feature") != BIAS) & (F.col("in_p") >= least)).select("feature", p.alias("p"), u.alias("u"))
    clean = F.greatest(F.lit(0.0), (F.col("u") - prior * F.col("p")) / (1 - prior))  # U corrected for its toxic share
    shares = shares.withColumn("clean", clean)
    spread = (F.col("clean") * (1 - F.col("clean")) + 1 / (n_u + 2)) / n_p + (F.col("u") * (1 - F.col("u")) + 1e-9) / n_u
    clear = shares.select("feature", ((F.col("p") - F.col("clean")) / F.sqrt(spread)).alias("z"), (F.col("p") > TIMES * F.col("clean")).alias("often"))
    best = clear.filter((F.col("z") > CLEAR) & F.col("often")).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    return [r["feature"] for r in best.select("feature").collect()]  # at most MAX_FEATURES


class Sparse:
    """``n`` binary rows over ``m`` features from their hits (row id, feature); rows without a hit come last. Products in numpy."""

    def __init__(self, ids: np.ndarray, cols: np.ndarray, n: int, m: int):
        order = np.lexsort((cols, ids))
        self.n, self.m, self.col = n, m, cols[order].astype(np.int64)
        self.row = np.unique(ids[order], return_inverse=True)[1]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.m)


def train(p: Sparse, u: Sparse, names: list[str], prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-5) -> dict[str, float]:
    """Feature weights, the bias under BIAS."""
    w, b = np.zeros(len(names)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    softplus = lambda x: np.logaddexp(0, x)
    for t in range(1, steps + 1):
        sp, su = p.dot(w) + b, u.dot(w) + b
        gp_plus, gp_minus, gu_minus = -sigmoid(-sp) / p.n * prior, sigmoid(sp) / p.n * prior, sigmoid(su) / u.n
        clean_risk = softplus(su).mean() - prior * softplus(sp).mean()
        if clean_risk >= 0:
            on_p, on_u = gp_plus - gp_minus, gu_minus
        else:
            on_p, on_u = gp_minus, -gu_minus
        g = np.append(p.back(on_p) + u.back(on_u) + decay * w, on_p.sum() + on_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return {BIAS: float(b)} | {f: float(x) for f, x in zip(names, w)}


def score_text(text: str, model: dict[str, float]) -> float:
    if not model:
        return 0.0
    get = model.get
    total = get(BIAS, 0.0)
    words = set(LETTERS.findall(text.lower()))
    stems = set()
    for w in words:
        total += get(w, 0.0)
        for n in STEMS:
            if len(w) > n:
                stems.add(w[:n])
    total += sum(get(s, 0.0) for s in stems - words)
    return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> dict[str, float]:
    """A model from the training folds of ``docs`` and ``labels`` (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    totals = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    if not totals["t"]:
        return {}
    prior = min(0.5, max(0.001, totals["t"] / totals["n"]))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = text_rows(docs).select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    p = known.filter("toxic = 1").select("doc_id").distinct().orderBy(*order).limit(max_positive).withColumn("p", F.lit(True))
    u = ids.distinct().orderBy(*order).limit(max_unlabelled).withColumn("u", F.lit(True))
    chosen = settled(p.join(u, "doc_id", "full"))  # at most max_positive + max_unlabelled rows
    kinds = [F.coalesce(c, F.lit(False)).alias(c) for c in ("p", "u")]
    sample = settled(text_rows(docs).join(F.broadcast(chosen), "doc_id").select(*kinds, "text"))
    # In the order of the sample, a row that is of one kind with the row before it of the same text does not count.
    sample = sample.withColumn("row", F.monotonically_increasing_id()).repartition(SAMPLE_TASKS, "text")
    before = F.lag(F.struct("p", "u")).over(Window.partitionBy("text").orderBy("row"))
    sample = sample.withColumn("before", before).filter(~F.col("before").eqNullSafe(F.struct("p", "u")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row, is_p, is_u, text in zip(*batch.columns):
                found = [BIAS, *features(text.as_py())]  # BIAS stands for the row itself
                held.append((row.as_py(), is_p.as_py(), is_u.as_py(), pa.array(found, pa.string())))
                size += len(found)
                if size >= PORTION:
                    yield hits_batch(held)
                    held, size = [], 0
            if held:
                yield hits_batch(held)

    hits = written(sample.select("row", "p", "u", "text").mapInArrow(spread, "row long, p boolean, u boolean, feature string"))
    counts = hits.groupBy("feature").agg(F.count_if("p").alias("in_p"), F.count_if("u").alias("in_u"))
    rows = counts.filter(F.col("feature") == BIAS).first()
    n_p, n_u = (rows["in_p"], rows["in_u"]) if rows else (0, 0)
    if not n_p or not n_u:
        return {}
    names = screened(counts, n_p, n_u, prior)
    if not names:
        nothing = np.zeros(0, np.int64)
        return train(Sparse(nothing, nothing, n_p, 0), Sparse(nothing, nothing, n_u, 0), names, prior)
    index = docs.sparkSession.createDataFrame(list(enumerate(names)), "col int, feature string")
    places = hits.join(F.broadcast(index), "feature").select("row", "p", "u", "col").repartition(1)  # numbers alone, of the sample

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, is_p, is_u, cols = map(np.concatenate, zip(*([c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches)))
        model = train(*(Sparse(ids[k], cols[k], n, len(names)) for k, n in ((is_p, n_p), (is_u, n_u))), names, prior)
        yield pa.RecordBatch.from_arrays([pa.array(list(model), pa.string()), pa.array(list(model.values()), pa.float64())],
                                         names=["feature", "weight"])

    found = places.mapInArrow(learn, "feature string, weight double")  # one bounded task
    return {r["feature"]: r["weight"] for r in settled(found).collect()}  # at most MAX_FEATURES + 1 rows


def scores(docs: DataFrame, model: dict[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold`` on)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array([score_text(t.as_py(), model) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), got], names=["doc_id", "score"])

    return text_rows(docs).mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict[str, float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they were."""
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([score_text(t.as_py() or "", model) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
