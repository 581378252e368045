"""Small reference-shaped inputs with dirty rows (FIXTURES.md section 1)."""

from metrolens.sources import schemas

TICKET_ROWS = [
    # Plate Id, Issue Date, Street Name, House Number, Violation Time, Issuer Code, Meter Number
    ("P1", "08/04/2013", "MAIN ST", "12", "0623A", 1, "123-4567"),
    ("P2", "13/45/2013", "MAIN ST", "123-45", "1200A", 2, ""),
    ("P3", None, "MAIN ST", "7A", "1230P", 3, None),
    ("P4", "08/05/2013", "MAIN ST", None, "1159P", 4, "123-4567"),
    ("P5", "8/6/2013", "BROADWAY", "15", "0030A", 5, "765-4321"),
    ("P6", "08/07/2013", "BROADWAY", "40", "1345P", 6, "1234567"),
    ("P7", "08/08/2013", "BROADWAY", "41", "xx", 7, "555"),
    ("P8", "08/09/2013", "ELM ST", "5", None, 8, "555"),
    ("P9", "08/10/2013", "MAIN ST", "20", "0900P", 9, "999-9999"),
]


def tickets(spark):
    return spark.createDataFrame(TICKET_ROWS, schemas.PARKING_TICKETS_RAW)


SEGMENT_ROWS = [
    # L_LOW, L_HIGH, R_LOW, R_HIGH, ST_LABEL, PHYSICALID, the_geom
    ("1", "11", None, None, "MAIN ST", 1, "G1"),          # left range only
    (None, None, "10", "20", "MAIN ST", 2, "G2"),          # right range only
    ("10", "30", "12", "25", "MAIN ST", 3, "G3"),          # both, overlapping
    ("50", "40", "60", "55", "BROADWAY", 4, "G4"),         # low > high on both sides
    ("1x", "50", "10", "20", "BROADWAY", 5, "G5"),         # non-numeric left bound
    ("10", "45", None, None, "BROADWAY", 6, "G6"),         # same label twice
    ("10", "45", None, None, "BROADWAY", 6, "G6"),         # exact duplicate row
    ("1", "9", None, None, "NOWHERE", 7, "G7"),            # segment without tickets
    ("0", "2000000", None, None, "BROADWAY", 8, "G8"),     # wide range (coarser bin level)
]


def segments(spark):
    rows = [(a, b, c, d, e, f, g) for a, b, c, d, e, f, g in SEGMENT_ROWS]
    df = spark.createDataFrame(rows, "L_LOW_HN string, L_HIGH_HN string, R_LOW_HN string, R_HIGH_HN string, "
                                     "ST_LABEL string, PHYSICALID int, the_geom string")
    return df.select(*schemas.SEGMENT_COLUMNS)


METER_ROWS = [
    ("1234567", "POINT (-73.99 40.75)"),     # inside the box
    ("7654321", "POINT (-73.89 40.75)"),     # exactly on the edge (0.1 away in x)
    ("5550000", "POINT (-73.50 40.75)"),     # outside
    ("9999999", "POINT (-73.98 40.74)"),     # duplicate meter row
    ("9999999", "POINT (-73.98 40.74)"),
    ("1111111", "POINT (-73.99 40.76)"),     # meter without tickets
    ("2222222", "POINT (-73.99)"),           # malformed text
]


def meters(spark):
    return spark.createDataFrame(METER_ROWS, "MeterNo string, the_geom string")
