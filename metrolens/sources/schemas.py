"""Explicit schemas of the reference-shaped inputs (no inference pass over big CSVs).

Column names are the raw CSV header names; loaders rename where the
reference renames (parking tickets to camel case).
"""

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw parking-violation file: only the columns the jobs read are typed here;
# use ``infer=True`` in the loader for files carrying extra columns in other positions.
PARKING_TICKETS_RAW = _schema(
    ("Plate Id", S), ("Issue Date", S), ("Street Name", S), ("House Number", S),
    ("Violation Time", S), ("Issuer Code", I), ("Meter Number", S),
)

# Ticket columns after the loader's rename.
TICKET_RENAMES = {
    "Plate Id": "PlateId",
    "Issue Date": "IssueDate",
    "Street Name": "StreetName",
    "House Number": "HouseNumber",
    "Violation Time": "ViolationTime",
    "Issuer Code": "IssuerCode",
    "Meter Number": "MeterNo",
}

STREET_SEGMENTS = _schema(
    ("L_LOW_HN", S), ("L_HIGH_HN", S), ("R_LOW_HN", S), ("R_HIGH_HN", S),
    ("ST_LABEL", S), ("PHYSICALID", I), ("the_geom", S),
)
SEGMENT_COLUMNS = ["L_HIGH_HN", "L_LOW_HN", "R_HIGH_HN", "R_LOW_HN", "ST_LABEL", "PHYSICALID", "the_geom"]

PARKING_METERS = _schema(("MeterNo", S), ("the_geom", S))

TAXI_TRIPS = _schema(
    ("tpep_pickup_datetime", TS), ("trip_distance", D),
    ("pickup_longitude", D), ("pickup_latitude", D),
    ("dropoff_longitude", D), ("dropoff_latitude", D),
    ("fare_amount", D),
)

BIKE_TRIPS = _schema(
    ("starttime", S), ("stoptime", S), ("duration", I), ("startId", I), ("endId", I),
    ("endName", S), ("address", S), ("gender", S), ("birth year", S), ("usertype", S),
)

ADDRESS_POINTS = _schema(("address", S), ("latitude", D), ("longtitude", D))
