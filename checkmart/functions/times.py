"""Dates and times. All timestamps are zone-less (`timestamp_ntz`)."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from checkmart.vocabulary import LONG_CHECK_HOURS, SUSPICIOUS_OPEN_DAYS

# A calendar date must be spelled out; bare numbers (years, spreadsheet serials) are not dates.
DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}"

# A spreadsheet serial of a day from 1954 on, with a fraction.
SERIAL_TEXT = r"^\d{5}(\.\d+)?$"

# Spreadsheet day 25569 is 1970-01-01, so serials count days from 1899-12-30.
SERIAL_OF_1970 = 25569
MICROS_PER_DAY = 86_400_000_000


def to_ts(c: Column, formats: Sequence[str] = (), serials: bool = False) -> Column:
    """Text as a timestamp, or NULL. ISO text always parses.

    `formats` adds datetime patterns to try after it; `serials` takes plain numbers as spreadsheet serial dates.
    """
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(DATE_TEXT), text.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    if serials:
        others.append(F.when(text.rlike(SERIAL_TEXT), excel_serial_to_ts(text.try_cast("double"))))
    return F.coalesce(iso, *others)


def to_day(c: Column, formats: Sequence[str] = (), serials: bool = False) -> Column:
    """Text as a date, or NULL; a time of day is cut off."""
    return to_ts(c, formats, serials).cast("date")


def excel_serial_to_ts(c: Column) -> Column:
    """Spreadsheet serial number (days since 1899-12-30, with a fraction) as a timestamp."""
    micros = F.round((c - SERIAL_OF_1970) * F.lit(float(MICROS_PER_DAY))).cast("bigint")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(micros / MICROS_PER_DAY).cast("int")
    rest = micros - days.cast("bigint") * MICROS_PER_DAY
    return epoch + F.make_dt_interval(days=days, secs=(rest / 1_000_000).cast("decimal(18,6)"))


def _units_since_start(ts: Column, unit: str) -> Column:
    # whole units since year 1; later timestamps are positive, so the truncation is a floor
    return F.timestamp_diff(unit, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"), ts)


def boundaries_between(unit: str, start: Column, end: Column) -> Column:
    """Signed number of `unit` boundaries crossed from start to end (09:59:59 -> 10:00:01 crosses one hour)."""
    return _units_since_start(end, unit) - _units_since_start(start, unit)


def minutes_between(start: Column, end: Column) -> Column:
    """Signed number of minute boundaries crossed."""
    return boundaries_between("MINUTE", start, end)


def is_long_duration(start: Column, end: Column, hours: int = LONG_CHECK_HOURS) -> Column:
    """Whether more than `hours` hour boundaries were crossed; NULL ends count as no."""
    return F.coalesce(boundaries_between("HOUR", start, end) > hours, F.lit(False))


def is_suspicious_open(open_ts: Column, day: Column, days: int = SUSPICIOUS_OPEN_DAYS) -> Column:
    """Whether the check was opened more than `days` days before the start of its accounting day."""
    earliest = day.cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")
    return F.coalesce(open_ts < earliest, F.lit(False))


def is_multiday_check(open_ts: Column, day: Column) -> Column:
    """Whether the check was opened on an earlier day than it is accounted on; NULL stays NULL."""
    return open_ts.cast("date") < day


def open_date(open_ts: Column) -> Column:
    """Start of the opening day, as a timestamp."""
    return F.date_trunc("day", open_ts).cast("timestamp_ntz")


def open_hour(open_ts: Column) -> Column:
    return F.hour(open_ts)


def calendar_attributes(day: Column) -> list[Column]:
    """Year, month, day, YYYY-MM, English weekday name, ISO weekday (1 = Monday) and weekend flag."""
    iso_weekday = F.weekday(day) + 1
    return [
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "EEEE").alias("weekday_name"),
        iso_weekday.cast("bigint").alias("iso_weekday"),
        (iso_weekday >= 6).alias("is_weekend"),
    ]
