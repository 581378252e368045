"""Taxi ML on Spark ML DataFrames: k-means pickups, quantile buckets, fare regressions, metrics.

M1-M12, A16, L4-L5. Everything stays in DataFrames (no RDD of Python
rows). The SGD solver of the reference is re-aimed (D11) to
``LinearRegression(solver="normal")``: exact least squares from one
distributed pass that builds the small Gram matrix, instead of 100 passes
with weights shipped from the driver each time. Randomness (sample,
split, k-means init) always takes a seed; with the columns of a row key it
is a hash of the key, which SQL repeats.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Bucketizer, QuantileDiscretizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import checkpoint_root, scratch_path
from . import cleaning
from .quantiles import exact_cuts


def assemble(df: DataFrame, input_cols: list[str], output_col: str = "features") -> DataFrame:
    """M1: feature vector from numeric columns."""
    return VectorAssembler(inputCols=input_cols, outputCol=output_col, handleInvalid="skip").transform(df)


def key_share(key_cols: list[str], seed: int):
    """A number in [0, 1) that depends on the row's key alone: the first 32 bits of MD5('seed|key|...') over 2^32.

    Plain SQL repeats it, and it is the same in every run and for every partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def maybe_sample(df: DataFrame, fraction: float | None, seed: int, key_cols: list[str] | None = None) -> DataFrame:
    """L4: Bernoulli sample without replacement; ``None`` keeps every row. With ``key_cols`` the row's key decides."""
    if fraction is None:
        return df
    return df.where(key_share(key_cols, seed) < fraction) if key_cols else df.sample(withReplacement=False, fraction=fraction, seed=seed)


def kmeans_clusters(df: DataFrame, input_cols: list[str], k: int = K.PICKUP_CLUSTERS, seed: int = K.KMEANS_SEED,
                    prediction_col: str = "predction_pickup", features_col: str = "features1"):
    """M2 by Spark ML's k-means on the given coordinates; returns (model, frame with the cluster column).

    Seed *and* input partitioning fix the result; see ``repeatable_centres`` for a fit that SQL can repeat.
    """
    vec = assemble(df, input_cols, features_col)
    km = KMeans(k=k, seed=seed, predictionCol=prediction_col, featuresCol=features_col)
    model = km.fit(vec.select(features_col))
    return model, model.transform(vec).drop(features_col)


def _fixed_point(col: str):
    """A coordinate as a whole number of COORDINATE_SCALE parts, so that sums do not depend on their order."""
    return F.floor(F.col(col).cast("double") * K.COORDINATE_SCALE + 0.5)


_LIMB = 22  # bits


def _limbs(whole) -> list:
    """The three parts of a whole number, lowest first: their sums fit a long for 2^41 rows, where its own may not."""
    low = F.lit((1 << _LIMB) - 1)
    return [whole.bitwiseAND(low), F.shiftright(whole, _LIMB).bitwiseAND(low), F.shiftright(whole, 2 * _LIMB)]


def _away(parts: list, centre: tuple):
    """Squared distance, in doubles."""
    terms = [(p.cast("double") - F.lit(float(c))) * (p.cast("double") - F.lit(float(c))) for p, c in zip(parts, centre)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _with_nearest(df: DataFrame, cols: list[str], centres: list[tuple], name: str) -> DataFrame:
    """``df`` with the index of the nearest centre (squared distance; ties: the smaller index).

    Distances, their least and the first that equals it are projections of plain doubles, with no struct a centre and
    row. A filter on the outcome would be pushed below them and repeat them all: write the rows before it."""
    ds = [f"{name}_d{i}" for i in range(len(centres))]
    near = df.select("*", *[_away([F.col(c) for c in cols], centre).alias(d) for centre, d in zip(centres, ds)])
    near = near.select("*", (F.least(*ds) if len(ds) > 1 else F.col(ds[0])).alias(f"{name}_least"))
    first = F.lit(len(ds) - 1)
    for i in range(len(ds) - 2, -1, -1):
        first = F.when(F.col(ds[i]) == F.col(f"{name}_least"), i).otherwise(first)
    return near.select(*[c for c in df.columns if c != name], first.alias(name))


def repeatable_centres(df: DataFrame, input_cols: list[str], k: int = K.PICKUP_CLUSTERS, seed: int = K.KMEANS_SEED,
                       rounds: int = K.KMEANS_ROUNDS) -> DataFrame:
    """M2: the centres of k-means that gives the same result in every run, as a table (cluster, input columns, rows).

    Coordinates are fixed-point whole numbers (see ``_fixed_point``), so the sums of a round are exact whatever the
    partitioning. First centres: the k distinct points least by MD5('seed|x|...'). Then Lloyd's rounds, each a
    partial aggregate of k rows, until no centre moves or ``rounds`` are done; a centre without points stays. Rows with a NULL or NaN
    coordinate take no part. ``rows`` counts the points that made the centre in the last round.
    """
    spark, names = df.sparkSession, [f"p{i}" for i in range(len(input_cols))]
    pts = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), _fixed_point(c)).alias(n) for n, c in zip(names, input_cols)]).dropna()
    pts = pts.persist(StorageLevel.MEMORY_AND_DISK)  # read once a round
    try:
        name = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(n).cast("string") for n in names]).cast("binary"))
        first = pts.distinct().orderBy(name, *names).limit(k).collect()  # k rows
        centres = [tuple(float(r[n]) for n in names) for r in first]
        rows = [0] * len(centres)
        for _ in range(rounds if centres else 0):
            near = _with_nearest(pts, names, centres, "i")
            sums = near.groupBy("i").agg(F.count(F.lit(1)).alias("n"), *[F.sum(limb).alias(f"{n}_{j}") for n in names
                                                                         for j, limb in enumerate(_limbs(F.col(n)))]).collect()
            moved, rows = list(centres), [0] * len(centres)
            for r in sums:
                whole = (sum(r[f"{n}_{j}"] << (_LIMB * j) for j in range(3)) for n in names)
                moved[r["i"]], rows[r["i"]] = tuple(float(x) / r["n"] for x in whole), r["n"]
            if moved == centres:
                break
            centres = moved
    finally:
        pts.unpersist()
    schema = "cluster int, " + ", ".join(f"{c} double" for c in input_cols) + ", rows long"
    return spark.createDataFrame([(i, *[x / K.COORDINATE_SCALE for x in c], n) for i, (c, n) in enumerate(zip(centres, rows))], schema)


def nearest_centre(df: DataFrame, input_cols: list[str], centres: DataFrame, prediction_col: str = "predction_pickup") -> DataFrame:
    """M2: rows with the number of their nearest centre, ties by number; NULL where a coordinate is NULL or NaN.

    The k centres (a table of ``repeatable_centres``) become literals, so this is a projection without join or shuffle.
    """
    parts = [f"{prediction_col}_{i}" for i in range(len(input_cols))]
    places = [tuple(r[c] * K.COORDINATE_SCALE for c in input_cols) for r in centres.orderBy("cluster").collect()]  # k rows
    if not places:
        return df.withColumn(prediction_col, F.lit(None).cast("int"))
    usable = F.lit(True)
    for c in input_cols:
        usable = usable & _usable(c)
    near = _with_nearest(df.select("*", *[_fixed_point(c).alias(p) for c, p in zip(input_cols, parts)]), parts, places, prediction_col)
    return near.withColumn(prediction_col, F.when(usable, F.col(prediction_col))).drop(*parts)


def cluster_export(df: DataFrame, lat_col: str = "pickup_latitude", lon_col: str = "pickup_longitude",
                   cluster_col: str = "predction_pickup") -> DataFrame:
    """M3: (latitude, longitude, cluster) for the cluster CSV (write with ``sinks.write_csv(header=True)``)."""
    return df.select(lat_col, lon_col, cluster_col)


def quantile_buckets(df: DataFrame, input_cols: list[str], num_buckets: int = K.QUANTILE_BUCKETS,
                     relative_error: float | None = None, suffix: str = "_bucket") -> DataFrame:
    """M4: the number of distinct quantile cuts not above the value; NaN gets a bucket of its own, NULL stays NULL.

    Cuts are exact (see ``quantiles.exact_cuts``); with a ``relative_error`` they come from Spark's quantile sketch.
    """
    outputs = [c + suffix for c in input_cols]
    if relative_error is not None:
        qd = QuantileDiscretizer(numBuckets=num_buckets, inputCols=input_cols, outputCols=outputs, relativeError=relative_error,
                                 handleInvalid="keep")
        return qd.fit(df).transform(df)
    cuts = exact_cuts(df, input_cols, num_buckets)
    splits = [[-math.inf, *[x for x in cuts[c] if abs(x) < math.inf], math.inf] for c in input_cols]
    whole = [c for c, s in zip(input_cols, splits) if len(s) == 2]  # one bucket: Bucketizer asks for two
    for c in whole:
        df = df.withColumn(c + suffix, F.when(F.isnan(F.col(c).cast("double")), 1.0).when(F.col(c).isNotNull(), 0.0))
    cut = [(c, o, s) for c, o, s in zip(input_cols, outputs, splits) if c not in whole]
    if not cut:
        return df
    return Bucketizer(inputCols=[c for c, _, _ in cut], outputCols=[o for _, o, _ in cut], splitsArray=[s for _, _, s in cut],
                      handleInvalid="keep").transform(df)


def _usable(col: str):
    value = F.col(col).cast("double")
    return value.isNotNull() & ~F.isnan(value)


def fit_reject_reason(label_col: str, feature_cols: list[str]):
    """M5: why a fit leaves a row out (its first unusable column, NULL or NaN); NULL for the rows of ``labeled``."""
    return F.coalesce(*[F.when(~_usable(c), F.lit(f"unusable {c}")) for c in (label_col, *feature_cols)])


def labeled(df: DataFrame, label_col: str, feature_cols: list[str], key_cols: list[str] | None = None) -> DataFrame:
    """M5: (label, features) rows, no RDD; rows without a usable label or feature can't be fitted (see ``fit_reject_reason``).
    ``key_cols`` come along for ``split``."""
    vec = assemble(df, feature_cols, "features").where(_usable(label_col))
    return vec.select(F.col(label_col).cast("double").alias("label"), "features", *(key_cols or []))


def split(df: DataFrame, seed: int, weights=(0.8, 0.2), key_cols: list[str] | None = None):
    """Split of a checkpointed copy, by the hash of the row's key (``key_share``) if ``key_cols`` are given, else seeded random.

    The labeled rows are written once to the shared checkpoint folder
    (``spark.checkpoint.dir``), which cuts the lineage: both halves and every
    pass of the fit read the same rows, and a lost executor costs a re-read,
    not a re-run of clustering or bucketing. With ``key_cols`` they are a table
    that holds the half of each row, so that no pass hashes keys again.
    """
    if not key_cols:
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True).randomSplit(list(weights), seed=seed)
    half, path = "__first_half", scratch_path(df.sparkSession, "split")
    df.withColumn(half, key_share(key_cols, seed) < weights[0] / sum(weights)).write.parquet(path)
    kept = df.sparkSession.read.parquet(path)
    return kept.where(half).drop(half), kept.where(~F.col(half)).drop(half)


def fit_linear(train: DataFrame, fit_intercept: bool):
    """M6/M7: least squares on (label, features)."""
    lr = LinearRegression(featuresCol="features", labelCol="label", fitIntercept=fit_intercept,
                          solver="normal", regParam=0.0, standardization=False)
    return lr.fit(train)


def regression_metrics(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                       prefix: str = "") -> DataFrame:
    """One-row frame with RMSE and explained variance, from one distributed aggregate.

    explained variance = mean((prediction - mean(label))^2), as in Spark's
    regression metrics; taken as var(prediction) + (mean(prediction) -
    mean(label))^2, since sums of squares cancel for large values.
    """
    p, y = F.col(prediction_col), F.col(label_col)
    bias = F.avg(p) - F.avg(y)
    return pred.agg(F.sqrt(F.avg((p - y) * (p - y))).alias(f"{prefix}rmse"),
                    (F.var_pop(p) + bias * bias).alias(f"{prefix}explained_variance"),
                    F.count(F.lit(1)).alias(f"{prefix}n"))


@dataclass
class FitResult:
    model: object
    metrics: DataFrame
    train: DataFrame | None = None
    test: DataFrame | None = None


def _train_and_score(data: DataFrame, fit_intercept: bool, seed: int, key_cols: list[str] | None = None) -> FitResult:
    train, test = split(data, seed, key_cols=key_cols)
    model = fit_linear(train, fit_intercept)
    test_m = regression_metrics(model.transform(test), prefix="test_")
    train_m = regression_metrics(model.transform(train), prefix="train_")
    return FitResult(model, test_m.crossJoin(train_m), train, test)


def fare_regression_clusters(trips: DataFrame, seed: int = 7, sample_fraction: float | None = None,
                             pickup_k: int = K.PICKUP_CLUSTERS, dropoff_k: int = K.DROPOFF_CLUSTERS,
                             key_cols: list[str] | None = None) -> FitResult:
    """M9: F9 -> L4 -> M2 (pickup k=20, dropoff k=5, decision D12) -> M1 -> L5 -> M6 -> A16."""
    df = maybe_sample(cleaning.drop_zero_coordinates(trips), sample_fraction, seed, key_cols)
    for cols, k, prediction in ((["pickup_latitude", "pickup_longitude"], pickup_k, "predction_pickup"),
                                (["dropoff_latitude", "dropoff_longitude"], dropoff_k, "prediction_dropoff")):
        df = nearest_centre(df, cols, repeatable_centres(df, cols, k=k), prediction)
    columns, path = ["predction_pickup", "prediction_dropoff"], scratch_path(trips.sparkSession, "clusters")
    df.select("fare_amount", *columns, *(key_cols or [])).write.parquet(path)  # ``labeled`` filters by cluster
    data = labeled(trips.sparkSession.read.parquet(path), "fare_amount", columns, key_cols)
    return _train_and_score(data, fit_intercept=False, seed=seed, key_cols=key_cols)  # checkpoints the labeled rows


def fare_regression_buckets(trips: DataFrame, seed: int = 7, sample_fraction: float | None = None,
                            num_buckets: int = K.QUANTILE_BUCKETS, key_cols: list[str] | None = None) -> FitResult:
    """F10 -> M4 (100 quantile buckets on 4 coordinates) -> M1 -> L5 -> M6 -> A16."""
    df = cleaning.within_nyc(maybe_sample(trips, sample_fraction, seed, key_cols))
    cols = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    df = quantile_buckets(df, cols, num_buckets=num_buckets)
    data = labeled(df, "fare_amount", [c + "_bucket" for c in cols], key_cols)
    return _train_and_score(data, fit_intercept=False, seed=seed, key_cols=key_cols)


def distance_fare_pairs(df: DataFrame) -> DataFrame:
    """The (fare, distance) pairs behind the distance/fare scatter plot."""
    return df.select(*[c for c in df.columns if c not in ("fare_amount", "distance")], "fare_amount", "distance")


def fare_regression_distance(trips: DataFrame, seed: int = 7, sample_fraction: float | None = None,
                             key_cols: list[str] | None = None) -> FitResult:
    """F10 -> P21 -> F12 -> L5 -> M7 (with intercept) -> A16."""
    df = cleaning.within_nyc(maybe_sample(trips, sample_fraction, seed, key_cols))
    df = cleaning.fare_distance_window(cleaning.with_trip_distance(df))
    data = labeled(df, "fare_amount", ["distance"], key_cols)
    return _train_and_score(data, fit_intercept=True, seed=seed, key_cols=key_cols)


def fit_summary(model, metrics: DataFrame) -> DataFrame:
    """Model coefficients (bounded: one per feature) next to the metrics row."""
    spark = metrics.sparkSession
    coefs = [float(c) for c in model.coefficients]
    row = spark.createDataFrame([(float(model.intercept), coefs)], "intercept double, coefficients array<double>")
    return row.crossJoin(metrics)
