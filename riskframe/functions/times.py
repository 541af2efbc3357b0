"""UTC days and wall-clock times whatever the session's time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_wall(ts: str | Column) -> Column:
    """The timestamp shown with its UTC clock time."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def from_utc_wall(ts: str | Column) -> Column:
    """The instant of a clock time that is meant as UTC."""
    return F.from_utc_timestamp(ts, F.current_timezone())


def utc_day(ts: str | Column) -> Column:
    return F.to_date(utc_wall(ts))
