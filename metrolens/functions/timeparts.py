"""Column expressions for clock and calendar parts.

All are built-in expressions (JVM side, inside whole-stage codegen). Spark 4
runs in ANSI mode, so text is converted with ``try_*`` forms: bad text
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EVENING_AFTER_HOUR, MORNING_BEFORE_HOUR, SEASON_MONTHS

ISSUE_DATE_PATTERN = "M/d/yyyy"          # accepts 08/04/2013 and 8/4/2013
BIKE_TIME_PATTERN = "M/d/yyyy H:mm[:ss]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ampm_letter(violation_time) -> Column:
    """The text with all digits removed ('0623A' -> 'A').

    ``translate`` deletes the characters without a regex engine; same result
    as replacing the digit runs.
    """
    return F.translate(_c(violation_time), _DIGITS, "")


def hhmm_digits(violation_time) -> Column:
    """The text with all ASCII letters removed ('0623A' -> '0623')."""
    return F.translate(_c(violation_time), _LETTERS, "")


def hour12(violation_time) -> Column:
    """HHMM text divided by 100 and truncated to int; NULL when not numeric."""
    return (hhmm_digits(violation_time).try_cast("double") / 100).try_cast("int")


def hour24(hour_12, ampm) -> Column:
    """12-hour clock to 0-23 (12A -> 0, 12P -> 12)."""
    return (_c(hour_12) % 12 + F.when(_c(ampm) == "P", 12).otherwise(0)).cast("int")


def parse_date(text, pattern: str = ISSUE_DATE_PATTERN) -> Column:
    """Date text to DATE; unparseable text becomes NULL."""
    return F.to_date(F.try_to_timestamp(_c(text), F.lit(pattern)))


def parse_timestamp(text, pattern: str = BIKE_TIME_PATTERN) -> Column:
    return F.try_to_timestamp(_c(text), F.lit(pattern))


def iso_weekday(date) -> Column:
    """ISO day of week, 1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(date)) + 1).cast("int")


def month_of(ts) -> Column:
    """P17."""
    return F.month(_c(ts)).cast("int")


def year_of(ts) -> Column:
    """P17."""
    return F.year(_c(ts)).cast("int")


def hour_of(ts) -> Column:
    """P18."""
    return F.hour(_c(ts)).cast("int")


def season_of_month(month) -> Column:
    """season label from the month number; NULL outside 1-12."""
    m = _c(month)
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def time_of_day(hour) -> Column:
    """'morning' before 10, 'evening' after 17, else 'midday'; NULL hour stays NULL."""
    h = _c(hour)
    return (F.when(h < MORNING_BEFORE_HOUR, "morning")
             .when(h > EVENING_AFTER_HOUR, "evening")
             .when(h.isNotNull(), "midday"))
