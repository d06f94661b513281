"""Time-zone arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock_to_instant(column: Column, timezone: str) -> Column:
    """Instant at which the clocks of `timezone` show the `timestamp_ntz` value of `column`."""
    return F.make_timestamp(
        F.year(column),
        F.month(column),
        F.dayofmonth(column),
        F.hour(column),
        F.minute(column),
        F.extract(F.lit("SECONDS"), column),
        F.lit(timezone),
    )


def date_to_instant(column: Column, timezone: str) -> Column:
    """Instant of midnight in `timezone` on the date in `column`."""
    return F.make_timestamp(
        F.year(column),
        F.month(column),
        F.dayofmonth(column),
        F.lit(0),
        F.lit(0),
        F.lit(0).cast("decimal(8,6)"),
        F.lit(timezone),
    )


def utc_wall_clock(column: Column) -> Column:
    """UTC wall clock (`timestamp_ntz`) of an instant, whatever the session time zone is."""
    return F.convert_timezone(None, F.lit("UTC"), column)


def utc_date(column: Column) -> Column:
    """UTC calendar date of an instant."""
    return F.to_date(utc_wall_clock(column))
