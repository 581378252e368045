"""Clock and calendar operators: ticket hour/weekday, taxi month and midnight, bike season.

A1, A2, A7, A8, F1-F4, F7-F8, F13-F14, P15-P20, L1-L2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts as tp


def ordered_small(df: DataFrame, *cols: str) -> DataFrame:
    """Order a bounded result (24 hours, 7 days, a few hundred months or labels).

    One partition sorted locally: the same order as ``orderBy`` without the
    range-partitioning sample job and shuffle. Only for outputs whose size is
    bounded by their keys, never for row-level data.
    """
    return df.coalesce(1).sortWithinPartitions(*cols)


def with_ticket_hour(tickets: DataFrame, time_col: str = "ViolationTime", drop_invalid: bool = True) -> DataFrame:
    """P6-P8 + F1-F3: add ``AMPM`` ('A'/'P') and ``Hour`` (1-12); drop unusable rows.

    Hour 0 and 13+ in the raw text are dropped, as are rows whose letter is
    not exactly A or P. With ``drop_invalid=False`` such rows stay with NULL
    ``Hour`` and ``AMPM`` (both set in one projection, so the text is parsed
    once), for callers that aggregate next and count only non-NULL keys.
    """
    ampm, h12 = tp.ampm_letter(time_col), tp.hour12(time_col)
    if drop_invalid:
        df = tickets.withColumns({"AMPM": ampm, "Hour": h12})
        # IN lists test each derived value once (NULL never matches).
        return df.where(F.col("Hour").isin(*range(1, 13)) & F.col("AMPM").isin("A", "P"))
    ok = h12.isin(*range(1, 13)) & ampm.isin("A", "P")
    return tickets.withColumns({"AMPM": F.when(ok, ampm), "Hour": F.when(ok, h12)})


def with_ticket_weekday(tickets: DataFrame, date_col: str = "IssueDate",
                        pattern: str = tp.ISSUE_DATE_PATTERN, drop_invalid: bool = True) -> DataFrame:
    """P15-P16 + F4: add ``day_of_week`` (1 = Monday ... 7 = Sunday); drop unparseable dates.

    With ``drop_invalid=False`` unparseable dates stay as NULL, for callers
    that aggregate next and count only non-NULL keys (``tickets_by_weekday``,
    ``interval_join.tickets_per_segment(by=...)``): Catalyst would otherwise
    inline the parse into the pushed-down NULL filter and parse every date
    twice.
    """
    df = tickets.withColumn("day_of_week", tp.iso_weekday(tp.parse_date(date_col, pattern)))
    return df.where(F.col("day_of_week").isNotNull()) if drop_invalid else df


def tickets_by_hour(tickets: DataFrame, time_col: str = "ViolationTime",
                    hour_col: str = "hour", count_col: str = "tickets") -> DataFrame:
    """A1: ticket count per hour of day 0-23 (at most 24 rows), ordered by hour.

    The reference groups by (AMPM, Hour) and maps to 24-hour time on the
    driver; the mapping is one-to-one, so grouping by the 24-hour value
    gives the same counts in one cluster-side aggregate.
    """
    df = with_ticket_hour(tickets, time_col, drop_invalid=False)
    counts = df.groupBy(tp.hour24("Hour", "AMPM").alias(hour_col)).agg(F.count(hour_col).alias(count_col))
    return ordered_small(counts.where(F.col(count_col) > 0), hour_col)


def tickets_by_weekday(tickets: DataFrame, date_col: str = "IssueDate",
                       pattern: str = tp.ISSUE_DATE_PATTERN, count_col: str = "tickets") -> DataFrame:
    """A2: ticket count per ISO weekday (at most 7 rows), ordered by day."""
    df = with_ticket_weekday(tickets, date_col, pattern, drop_invalid=False)
    # count(day) skips unparseable dates; their NULL group (count 0) is dropped
    # after the aggregate, so each date is parsed once.
    counts = df.groupBy("day_of_week").agg(F.count("day_of_week").alias(count_col)).where(F.col(count_col) > 0)
    return ordered_small(counts, "day_of_week")


def monthly_trips(trips: DataFrame, ts_col: str = "tpep_pickup_datetime",
                  distance_col: str = "trip_distance") -> DataFrame:
    """A7-A8 (+J4, L1): trips and mean distance per (year, month), in one aggregate.

    The reference computes the two aggregates separately and inner-joins
    them; NULL keys vanish in that join, so they are filtered here.
    """
    df = trips.select(tp.year_of(ts_col).alias("year"), tp.month_of(ts_col).alias("month"), distance_col)
    df = df.where(F.col("year").isNotNull() & F.col("month").isNotNull())
    out = df.groupBy("year", "month").agg(F.avg(distance_col).alias("avg_distance"), F.count(F.lit(1)).alias("trips"))
    return ordered_small(out, "year", "month")


def midnight_trips(trips: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """F8: trips picked up in hour 0 (NULL timestamps dropped)."""
    return trips.where(F.hour(F.col(ts_col)) < 1)


def with_season_and_time_of_day(df: DataFrame, month_col: str = "month", hour_col: str = "startHour") -> DataFrame:
    """``season`` and ``time_of_day`` labels, for filtering or partitioned output."""
    return df.withColumns({"season": tp.season_of_month(month_col), "time_of_day": tp.time_of_day(hour_col)})


def split_by(df: DataFrame, label_col: str, label: str) -> DataFrame:
    """one split (e.g. ``season == 'winter'``); prefer one partitioned write for all."""
    return df.where(F.col(label_col) == label)


def label_counts(df: DataFrame, label_col: str, count_col: str = "rows") -> DataFrame:
    return ordered_small(df.groupBy(label_col).agg(F.count(F.lit(1)).alias(count_col)), label_col)
