"""Reference-shaped frames derived from the driver's synthetic tables.

The driver's tables (TPC-H-like + events) stand in for the parking, taxi
and bike files. Each function below is a lazy projection of a whole table
(no subsets, no row caps), so every registered query's work grows with the
data. The same derivations are written in SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _violation_time(ts) -> F.Column:
    """'hhmm' + 'A'/'P' text of a timestamp, e.g. 00:09 -> '1209A'."""
    return F.concat(F.date_format(ts, "hhmm"), F.substring(F.date_format(ts, "a"), 1, 1))


def segments_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street segments: label = nation key; right range k..k+6, left range k+4..k+10 (k = key % 40).

    Bounds are text, as in the centerline CSV, and typed by the operator.
    """
    s = table(spark, sf_dir, "supplier")
    k = (F.col("s_suppkey") % 40).cast("int")
    return s.select(
        (k + 10).cast("string").alias("L_HIGH_HN"),
        (k + 4).cast("string").alias("L_LOW_HN"),
        (k + 6).cast("string").alias("R_HIGH_HN"),
        k.cast("string").alias("R_LOW_HN"),
        F.col("s_nationkey").cast("string").alias("ST_LABEL"),
        F.col("s_suppkey").cast("int").alias("PHYSICALID"),
        F.col("s_name").alias("the_geom"),
    )


def tickets_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets: street = part key % 25, house number = quantity, issue date = ship date as MM/dd/yyyy."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("PlateId"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("IssueDate"),
        (F.col("l_partkey") % 25).cast("string").alias("StreetName"),
        F.col("l_quantity").cast("int").cast("string").alias("HouseNumber"),
        _violation_time(F.col("l_shipdate")).alias("ViolationTime"),
        F.col("l_linenumber").alias("IssuerCode"),
        F.col("l_suppkey").cast("string").alias("MeterNo"),
    )


def tickets_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets: street = user id % 25, house number = floor(value), time = ts as 'hhmmA'."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("PlateId"),
        F.date_format("ts", "MM/dd/yyyy").alias("IssueDate"),
        (F.col("user_id") % 25).cast("string").alias("StreetName"),
        F.floor("value").cast("string").alias("HouseNumber"),
        _violation_time(F.col("ts")).alias("ViolationTime"),
        F.lit(None).cast("int").alias("IssuerCode"),
        F.lit(None).cast("string").alias("MeterNo"),
    )


def tickets_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets whose issue date is the order date as MM/dd/yyyy text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("PlateId"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("IssueDate"),
        F.lit(None).cast("string").alias("StreetName"),
        F.lit(None).cast("string").alias("HouseNumber"),
        F.lit(None).cast("string").alias("ViolationTime"),
        F.lit(None).cast("int").alias("IssuerCode"),
        F.lit(None).cast("string").alias("MeterNo"),
    )


# Meters: suppliers. x = account balance in cents, y = nation key, as WKT text.
METER_CENTER_X, METER_CENTER_Y, METER_RANGE = 500000.0, 12.0, 200000.0


def meters_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters: WKT 'POINT (cents nation)'; suppliers of nation 0 get malformed text 'POINT (cents)'."""
    s = table(spark, sf_dir, "supplier")
    cents = F.round(F.col("s_acctbal") * 100).cast("long").cast("string")
    nation = F.col("s_nationkey").cast("string")
    wkt = F.when(F.col("s_nationkey") == 0, F.concat(F.lit("POINT ("), cents, F.lit(")"))) \
           .otherwise(F.concat(F.lit("POINT ("), cents, F.lit(" "), nation, F.lit(")")))
    return s.select(F.col("s_suppkey").cast("string").alias("MeterNo"), wkt.alias("the_geom"))


def meter_tickets_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets at meters: returned, large line items carry the supplier key with a dash ('7-9'), others ''."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_suppkey").cast("string")
    dashed = F.when(F.length(k) > 1, F.concat(F.expr("substr(cast(l_suppkey as string), 1, length(cast(l_suppkey as string)) - 1)"),
                                             F.lit("-"), F.substring(k, -1, 1))).otherwise(k)
    is_meter = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49.5)
    return li.select(
        F.col("l_orderkey").cast("string").alias("PlateId"),
        F.when(is_meter, dashed).otherwise(F.lit("")).alias("MeterNo"),
    )


def taxi_trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips: pickup time = ship date, distance = quantity; coordinates scaled into the NYC box."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        (F.lit(40.6) + F.col("l_discount") * 3).alias("pickup_latitude"),
        (F.lit(-74.05) + F.col("l_tax") * 3.75).alias("pickup_longitude"),
        (F.lit(40.6) + F.col("l_linenumber") / 25.0).alias("dropoff_latitude"),
        (F.lit(-74.05) + F.col("l_quantity") / 200.0).alias("dropoff_longitude"),
        (F.col("l_extendedprice") / 1500.0).alias("fare_amount"),
    )


def taxi_trips_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips with pickup time = event time and pickup point from user id and value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("value") / 5000.0 - 74.0).alias("pickup_longitude"),
        (F.col("user_id") / 1000.0 + 40.6).alias("pickup_latitude"),
    )


def map_points_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map points near NYC: latitude from user id, longitude from value; label = event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("point_id"),
        (F.col("user_id") / 1000.0 + 40.6).alias("latitude"),
        (F.col("value") / 5000.0 - 74.0).alias("longitude"),
        F.col("event_type").alias("label"),
    )


def bike_trips_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bike rides: start = order date + (key % 24) h as text; ids, duration and names from order columns."""
    o = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    stop = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    return o.select(
        F.col("o_orderkey").alias("trip_id"),
        F.date_format(start, "MM/dd/yyyy HH:mm:ss").alias("starttime"),
        F.date_format(stop, "MM/dd/yyyy HH:mm:ss").alias("stoptime"),
        (F.floor(F.col("o_totalprice") / 1000) - 5).cast("int").alias("duration"),
        F.col("o_custkey").cast("int").alias("startId"),
        (F.col("o_orderkey") % 500).cast("int").alias("endId"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderpriority")).alias("endName"),
        F.col("o_orderpriority").alias("address"),
        F.lit("1").alias("gender"),
        F.lit("1980").alias("birth year"),
        F.lit("Subscriber").alias("usertype"),
    )


def rides_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with a street address: the customer's nation written as 'NATION_<key>'."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("trip_id"), F.col("c_mktsegment").alias("routes"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("address"))


def addresses_from_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address points: nation name -> (40 + key / 2, -74 + region / 10)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("address"),
        (F.lit(40.0) + F.col("n_nationkey") / 2.0).alias("latitude"),
        (F.lit(-74.0) + F.col("n_regionkey") / 10.0).alias("longtitude"),
    )


def world_points_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World-wide points: longitude = value - 245, latitude = user id - 75."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", (F.col("value") - 245.0).alias("longitude"),
                     (F.col("user_id") - 75.0).alias("latitude"))


def line_points_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poly-line points: one line per order, points in line-number order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("line_id"), F.col("l_linenumber").alias("seq"),
                     (F.lit(40.5) + F.col("l_quantity") / 100.0).alias("latitude"),
                     (F.lit(-74.0) + F.col("l_discount")).alias("longitude"))


def cluster_points_from_lineitem(spark: SparkSession, sf_dir: str, cluster: str = "l_suppkey % 7") -> DataFrame:
    """Clustered points: cluster = supplier key % 7 (or another expression), x = price / 1000, y = quantity + 10 * discount."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.expr(cluster).alias("cluster"),
                     (F.col("l_extendedprice") / 1000.0).alias("x_pixel"),
                     (F.col("l_quantity") + F.col("l_discount") * 10.0).alias("y_pixel"))


def street_features_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features, one per line item (no grouping): a two-line geometry whose first
    line has two points (discount / quantity and tax / line number) and whose second
    line (which readers must ignore) has one constant point. id = order key * 100 + line number."""
    li = table(spark, sf_dir, "lineitem")
    p1 = F.array(F.lit(-74.0) + F.col("l_discount"), F.lit(40.5) + F.col("l_quantity") / 100.0)
    p2 = F.array(F.lit(-74.0) + F.col("l_tax"), F.lit(40.5) + F.col("l_linenumber") / 100.0)
    second = F.array(F.array(F.lit(-73.0), F.lit(41.0)))
    coords = F.array(F.array(p1, p2), second)
    return li.select(F.lit("Feature").alias("type"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                     F.struct(F.lit("MultiLineString").alias("type"), coords.alias("coordinates")).alias("geometry"))
