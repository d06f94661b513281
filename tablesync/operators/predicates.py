"""Filters, key conditions and the touched-partition semi-join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.timestamps import date_to_instant
from tablesync.operators.shape import quoted

# Frames measured to be no larger than this may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024

CHANGE_OP = "_op"
CHANGE_KEY_PREFIX = "_pk_"


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the size of a frame of plain columns, by one aggregation over it."""
    width = F.lit(0).cast("long")
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(quoted(name).cast("string")), F.lit(0)) + 16
    return int(df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """`df` marked for broadcast if it is measured to fit the limit, else as it is.

    To be used where the other side of a join is a whole table: without the mark, Spark would
    start to shuffle that table before it knows that this side is small.
    """
    allowed = BROADCAST_BYTES if limit is None else limit
    return F.broadcast(df) if measured_bytes(df) <= allowed else df


def as_column(predicate: Column | str) -> Column:
    """A predicate given as SQL text or as a column."""
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def date_window(
    column: str,
    start: dt.date | str,
    end: dt.date | str | None = None,
    timezone: str | None = None,
) -> Column:
    """Half-open day window `[start, end)`; without `end`, the one day `start`.

    The bounds are constants, so the filter reaches the scan. For a column of instants,
    `timezone` says whose days are meant.
    """
    first = dt.date.fromisoformat(str(start))
    last = first + dt.timedelta(days=1) if end is None else dt.date.fromisoformat(str(end))
    lower, upper = F.lit(first), F.lit(last)
    if timezone is not None:
        lower, upper = date_to_instant(lower, timezone), date_to_instant(upper, timezone)
    return (quoted(column) >= lower) & (quoted(column) < upper)


def filter_source(
    df: DataFrame,
    where: Column | str | None = None,
    window: Column | None = None,
) -> DataFrame:
    """Apply the day window and the user's predicate, each when given."""
    if window is not None:
        df = df.where(window)
    return df.where(as_column(where)) if where is not None else df


def key_equality(
    keys: Sequence[str],
    source: str,
    target: str,
    source_prefix: str = "",
    target_prefix: str = "",
) -> Column:
    """Conjunction of `source.key = target.key`; NULL keys match nothing."""
    if not keys:
        raise ValueError("at least one key column is needed")
    return reduce(
        and_,
        [F.col(f"{source}.`{source_prefix}{key}`") == F.col(f"{target}.`{target_prefix}{key}`")
         for key in keys],
    )


def touched_partitions(source: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Distinct values of a partition column among the source rows, NULL included."""
    return source.select(quoted(prefix + column).alias(column)).distinct()


def in_touched_partitions(target: DataFrame, touched: DataFrame, column: str) -> DataFrame:
    """Target rows whose partition value is in `touched` (NULL equals NULL).

    A semi-join instead of a rendered IN list: values are never turned into text. It reads all
    partitions; a target table chooses its directories by name instead.
    """
    values = touched.select(quoted(column).alias("_touched"))
    return target.join(values, quoted(column).eqNullSafe(F.col("_touched")), "left_semi")


def not_in_touched_partitions(target: DataFrame, touched: DataFrame, column: str) -> DataFrame:
    """Target rows whose partition value is not in `touched` (NULL equals NULL)."""
    values = touched.select(quoted(column).alias("_touched"))
    return target.join(values, quoted(column).eqNullSafe(F.col("_touched")), "left_anti")


def merge_condition(
    keys: Sequence[str],
    source: str = "source",
    target: str = "target",
    source_prefix: str = "",
    target_prefix: str = "",
    partition_values: Sequence | None = None,
    partition_column: str | None = None,
) -> Column:
    """Key equality, narrowed to the given partition values of the target.

    For callers that already hold a short list of values; `in_touched_partitions` is the form
    for any number of them.
    """
    condition = key_equality(keys, source, target, source_prefix, target_prefix)
    if partition_column is None or not partition_values:
        return condition
    return F.col(f"{target}.`{partition_column}`").isin(list(partition_values)) & condition


def replace_scope(where: Column | str | None, window: Column | None = None) -> Column:
    """Rows that a filtered overwrite may replace; a NULL outcome counts as out of scope."""
    scope = F.lit(True)
    if window is not None:
        scope = scope & window
    if where is not None:
        scope = scope & as_column(where)
    return F.coalesce(scope, F.lit(False))


def is_delete() -> Column:
    """Change rows that delete."""
    return F.col(CHANGE_OP) == "D"


def is_write() -> Column:
    """Change rows that insert or update."""
    return F.col(CHANGE_OP).isin("I", "U")


def string_join(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "joined") -> DataFrame:
    """Distinct values of a text column as one sorted `a, b, c` text per group.

    For catalogs and partition values, whose number is bounded by the layout of a table.
    """
    text = F.array_join(F.sort_array(F.collect_set(quoted(column))), ", ").alias(name)
    return df.groupBy(*[quoted(key) for key in by]).agg(text)
