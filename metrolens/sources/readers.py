"""CSV sources.

All readers are lazy scans. With an explicit schema there is no inference
job; CSV cannot push filters into the file, but Catalyst still prunes the
parsed columns to those the plan uses.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


@dataclass(frozen=True)
class InputPaths:
    """Input locations for the parking, taxi and bike jobs (S10: no built-in paths)."""

    tickets: str | None = None
    segments: str | None = None
    meters: str | None = None
    trips: str | None = None
    bikes: str | None = None
    addresses: str | None = None

    def require(self, name: str) -> str:
        value = getattr(self, name)
        if not value:
            raise ValueError(f"input path '{name}' is not set")
        return value


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True,
             infer: bool = False) -> DataFrame:
    """CSV with typed columns and no inference pass.

    With a header, columns are found by name (the files carry many more
    columns, in any order): every column is read as text and the schema's
    columns are selected and converted with ``try_cast`` (bad text -> NULL).
    Without a header the schema is applied by position. ``infer=True``
    falls back to Spark's schema inference (an extra pass over the data).
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if infer or schema is None:
        return reader.option("inferSchema", infer).csv(path)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not header:
        return reader.schema(st).csv(path)
    raw = reader.option("enforceSchema", False).csv(path)  # a file whose header differs is an error, not shifted columns
    missing = [f.name for f in st.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"CSV at {path} lacks columns {missing}")
    return raw.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in st.fields])


def read_csv_by_header(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV files as one table of text columns, also where the files' headers differ.

    The first line of each file is read first (a row a file for the driver, which lists the files anyhow); files of the same header
    make one reader, and the readers are joined by column name. A column that a file lacks is NULL there.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at"))
    first = lines.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in sorted(first.collect()):
        groups.setdefault(r["header"], []).append(r["file"])
    if not groups:
        return spark.read.option("header", True).csv(path)
    out = None
    for _, files in sorted(groups.items(), key=lambda g: g[1]):
        part = spark.read.option("header", True).option("enforceSchema", False).csv([unquote(f) for f in files])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def load_parking_tickets(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """S3: the seven ticket columns, renamed to camel case."""
    raw = read_csv(spark, path, schemas.PARKING_TICKETS_RAW, infer=infer)
    return rename_ticket_columns(raw)


def rename_ticket_columns(raw: DataFrame) -> DataFrame:
    return raw.select([F.col(f"`{src}`").alias(dst) for src, dst in schemas.TICKET_RENAMES.items()])


def load_street_segments(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """The seven centerline columns the jobs use."""
    return read_csv(spark, path, schemas.STREET_SEGMENTS, infer=infer).select(*schemas.SEGMENT_COLUMNS)


def load_parking_meters(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """The meter files with all their columns, as text (types only with ``infer``, for files of one header); columns are found by name in every file."""
    df = read_csv(spark, path, None, infer=True) if infer else read_csv_by_header(spark, path)
    missing = [c for c in schemas.PARKING_METERS.fieldNames() if c not in df.columns]
    if missing:
        raise ValueError(f"meter file at {path} lacks columns {missing}")
    return df


def register_trips(spark: SparkSession, path_or_df, view: str = "trips", infer: bool = False) -> DataFrame:
    """Trip table registered as a SQL view."""
    df = path_or_df if isinstance(path_or_df, DataFrame) else read_csv(spark, path_or_df, schemas.TAXI_TRIPS, infer=infer)
    df.createOrReplaceTempView(view)
    return df


def trips_projection(spark: SparkSession, columns: list[str], view: str = "trips") -> DataFrame:
    """SQL projection over the registered view."""
    cols = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT {cols} FROM {view}")


def read_csv_by_position(spark: SparkSession, path: str, positions: dict[int, str],
                         cast: str = "double") -> DataFrame:
    """Headered CSV read by column position; the header row is skipped.

    ``positions`` maps a 0-based column index to the output name.
    """
    raw = spark.read.option("header", True).csv(path)
    cols = raw.columns
    return raw.select([F.col(f"`{cols[i]}`").try_cast(cast).alias(name) for i, name in sorted(positions.items())])
