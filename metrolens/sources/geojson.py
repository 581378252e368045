"""GeoJSON street geometry flattened to points.

The first line of each feature's multi-line geometry is exploded to
ordered (x, y) points. Three ways of reading:

* ``read_collection``: FeatureCollection documents of any size, each read by
  many tasks. Spark's text source cuts the file at the bytes ``"Feature"``, the
  type name that stands once in each feature, and finds the next one wherever
  a byte range begins; a piece is the rest of one feature;
* ``read_features(multiline=True)``: the same documents, each parsed whole by
  one task, for features that do not begin with their type;
* ``read_features(multiline=False)``: newline-delimited features (GeoJSONSeq).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranks import with_position

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no installed copy of the package

_COORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
_GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", _COORDS),
])
FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("geometry", _GEOMETRY),
])
COLLECTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEATURE_SCHEMA)),
])


def read_features(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per feature: (feature_id, geometry)."""
    if multiline:
        doc = spark.read.schema(COLLECTION_SCHEMA).option("multiLine", True).json(path)
        feats = doc.select(F.posexplode("features").alias("pos", "f"))
        return feats.select(F.coalesce(F.col("f.id"), F.col("pos").cast("long")).alias("feature_id"),
                            F.col("f.geometry").alias("geometry"))
    feats = spark.read.schema(FEATURE_SCHEMA).json(path)
    return feats.select(F.col("id").alias("feature_id"), "geometry")


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of FeatureCollection documents: (feature_id, geometry), in pieces of a file as large as
    ``spark.sql.files.maxPartitionBytes``.

    ``feature_id`` is the feature's id, or, where a document gives none, its place among all features of all files (by
    file name, then by order in the file), so it repeats for no two features without id. Each feature must begin with
    ``"type": "Feature"`` and name that type in no other value; a feature that cannot be read as one with multi-line geometry (or null), or has no geometry
    member, is an error, never a lost row.
    """
    pieces = spark.read.option("lineSep", '"Feature"').text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    pieces = pieces.withColumn("at", F.monotonically_increasing_id())
    rest = F.concat(F.lit('{"type":"Feature"'), F.col("value"))
    feature = F.from_json(rest, FEATURE_SCHEMA, {"mode": "FAILFAST"})
    whole = pieces.where(F.ltrim("value").rlike(r"^\s*[,}]"))  # the others are the head of a document
    whole = whole.select("file", "block", "at", feature.alias("f"), F.col("value").contains('"geometry"').alias("given"))
    stated = F.when(~F.col("given"), F.raise_error(F.lit("feature without a geometry member: read with read_features(multiline=True)")))
    rows = whole.select("file", "block", "at", F.col("f.id").alias("id"), F.coalesce(F.col("f.geometry"), stated.cast(_GEOMETRY)).alias("geometry"))
    if rows.where(F.col("id").isNull()).isEmpty():
        return rows.select(F.col("id").alias("feature_id"), "geometry")
    placed = with_position(rows, [F.col("file"), F.col("block"), F.col("at")], "_place")
    return placed.select(F.coalesce("id", "_place").alias("feature_id"), "geometry")


def write_collections(features: DataFrame, path: str) -> None:
    """GeoJSON features (rows of their members, ``type`` first) as FeatureCollection documents, one for each partition."""

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(['{"type":"FeatureCollection","features":['])], ["value"])
        comma = ""
        for batch in batches:
            lines = [comma + batch.column(0)[0].as_py(), *("," + t for t in batch.column(0).to_pylist()[1:])] if batch.num_rows else []
            comma = "," if lines else comma
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]}"])], ["value"])

    features.select(F.to_json(F.struct(*features.columns)).alias("value")).mapInArrow(document, "value string").write.text(path)


def first_line_points(features: DataFrame) -> DataFrame:
    """(feature_id, point_index, x, y) for the first line of each feature only."""
    pts = features.select(
        "feature_id",
        F.posexplode(F.element_at(F.col("geometry.coordinates"), 1)).alias("point_index", "xy"),
    )
    return pts.select("feature_id", "point_index",
                      F.element_at("xy", 1).alias("x"), F.element_at("xy", 2).alias("y"))


def read_street_points(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return first_line_points(read_features(spark, path, multiline))
