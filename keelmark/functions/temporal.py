"""Date and time columns that count calendar boundaries.

``datediff(MONTH, ...)``, ``months_between`` and ``timestampdiff`` count complete
units; the product's definitions count how many month (or hour) starts are
crossed, so those are spelled out here.
"""

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def moment(value: datetime | Column) -> Column:
    """A zone-less timestamp literal (``F.lit(datetime)`` would apply the session zone)."""
    if isinstance(value, Column):
        return value
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'")


def months_before(value: date | Column, months: int) -> Column:
    return F.add_months(day(value), -months)


def moment_before(value: datetime | Column, *, days: int = 0, hours: int = 0) -> Column:
    return moment(value) - F.make_dt_interval(F.lit(days), F.lit(hours))


def months_crossed(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def days_crossed(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def _hours(value: Column) -> Column:
    """Hours since the epoch, from the fields of the timestamp: no zone is involved."""
    return F.unix_date(F.to_date(value)).cast("bigint") * 24 + F.hour(value)


def hours_crossed(start: Column, end: Column) -> Column:
    return _hours(end) - _hours(start)


def _micros(value: Column) -> Column:
    seconds = F.date_part(F.lit("SECOND"), value)
    return (_hours(value) * 60 + F.minute(value)) * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def seconds_elapsed(start: Column, end: Column) -> Column:
    """Whole seconds, from microseconds: truncating each side first would be off by one."""
    return F.floor((_micros(end) - _micros(start)) / 1_000_000).cast("bigint")


def hour_of(value: Column) -> Column:
    return F.to_date(value).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(value))
