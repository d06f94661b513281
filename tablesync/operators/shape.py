"""Column shaping between a source and its target.

Each operator is one projection. `shape` composes them in the order the target
expects: generated column, cleaned names, type casts, ingestion time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from tablesync.functions.names import clean_name
from tablesync.functions.timestamps import date_to_instant, utc_date, wall_clock_to_instant

# Fixed value: the name readers expect of the column with the time of ingestion.
INGESTED_AT = "_platform_ingested_at"


def quoted(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def actual_names(names: Iterable[str], columns: Iterable[str]) -> list[str]:
    """Column names as the data spells them, given in any case; exact spelling goes first."""
    present = list(columns)
    found = []
    for name in names:
        matches = [name] if name in present else [c for c in present if c.lower() == name.lower()]
        if len(matches) != 1:
            raise ValueError(f"{'no' if not matches else 'more than one'} column {name!r}")
        found.append(matches[0])
    return found


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with `clean_name`."""
    return df.toDF(*[clean_name(name) for name in df.columns])


def add_generated_column(df: DataFrame, name: str, expression: str, data_type: str) -> DataFrame:
    """Add `expression` cast to `data_type`; an existing column of that name is replaced.

    The expression sees the columns under the names they have in `df`. A value that does not
    fit the type becomes NULL.
    """
    return df.withColumn(name, F.expr(expression).try_cast(data_type))


def date_to_timestamp(df: DataFrame, timezone: str | None = None) -> DataFrame:
    """Turn every date column into a timestamp at midnight.

    Midnight is that of `timezone`, or of the session when none is given.
    """
    def cast(field_name: str, data_type: DataType) -> Column:
        column = quoted(field_name)
        if not isinstance(data_type, DateType):
            return column
        instant = date_to_instant(column, timezone) if timezone else column.cast("timestamp")
        return instant.alias(field_name)

    return df.select(*[cast(field.name, field.dataType) for field in df.schema])


def _instant(column: Column, data_type: DataType, timezone: str) -> Column:
    """UTC instant of a source wall clock.

    A `timestamp_ntz` is the wall clock itself. A `timestamp` is taken as a wall clock that
    a reader stored as if it were UTC.
    """
    if isinstance(data_type, TimestampNTZType):
        return wall_clock_to_instant(column, timezone)
    return F.to_utc_timestamp(column, timezone)


def timestamp_to_utc(df: DataFrame, timezone: str) -> DataFrame:
    """Turn every timestamp column from the wall clock of `timezone` into a UTC instant."""
    def shift(field_name: str, data_type: DataType) -> Column:
        column = quoted(field_name)
        if not isinstance(data_type, (TimestampType, TimestampNTZType)):
            return column
        return _instant(column, data_type, timezone).alias(field_name)

    return df.select(*[shift(field.name, field.dataType) for field in df.schema])


def partition_timestamp_to_date(df: DataFrame, partition_columns: Iterable[str]) -> DataFrame:
    """Turn partition columns that are timestamps into dates; names match in any case."""
    wanted = {clean_name(name).lower() for name in partition_columns}

    def to_date(field_name: str, data_type: DataType) -> Column:
        column = quoted(field_name)
        if field_name.lower() not in wanted:
            return column
        if not isinstance(data_type, (TimestampType, TimestampNTZType)):
            return column
        return F.to_date(column).alias(field_name)

    return df.select(*[to_date(field.name, field.dataType) for field in df.schema])


def add_ingestion_time(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Put the ingestion time first, replacing a column of that name if the source has one."""
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    others = [quoted(name) for name in df.columns if name.lower() != INGESTED_AT]
    return df.select(moment.alias(INGESTED_AT), *others)


def cast_times(
    df: DataFrame,
    timezone: str,
    partition_columns: Iterable[str] = (),
    partition_date: str = "local",
) -> DataFrame:
    """All date and timestamp casts of `shape` in one projection.

    Dates become midnight of `timezone`, timestamps become UTC instants, and partition
    columns of either type become dates: the calendar date at the source, or with
    `partition_date="utc"` the UTC date of the instant.
    """
    if partition_date not in ("local", "utc"):
        raise ValueError("partition_date is 'local' or 'utc'")
    wanted = {clean_name(name).lower() for name in partition_columns}

    def cast(field_name: str, data_type: DataType) -> Column:
        column = quoted(field_name)
        if isinstance(data_type, DateType):
            instant = date_to_instant(column, timezone)
            local = column
        elif isinstance(data_type, TimestampNTZType):
            instant = wall_clock_to_instant(column, timezone)
            local = F.to_date(column)
        elif isinstance(data_type, TimestampType):
            instant = F.to_utc_timestamp(column, timezone)
            local = utc_date(column)
        else:
            return column
        if field_name.lower() not in wanted:
            return instant.alias(field_name)
        return (local if partition_date == "local" else utc_date(instant)).alias(field_name)

    return df.select(*[cast(field.name, field.dataType) for field in df.schema])


def shape(
    df: DataFrame,
    timezone: str,
    partition_columns: Iterable[str] = (),
    generated: tuple[str, str, str] | None = None,
    ingestion_time: bool = True,
    partition_date: str = "local",
) -> DataFrame:
    """Generated column, clean names, time casts and ingestion time, in that order.

    `generated` is `(name, expression, type)`; the expression sees the source's own names
    and unshifted times, and its result is cast like any other column.
    """
    if generated is not None:
        df = add_generated_column(df, *generated)
    df = clean_column_names(df)
    df = cast_times(df, timezone, list(partition_columns), partition_date)
    return add_ingestion_time(df) if ingestion_time else df
