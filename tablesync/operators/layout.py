"""Z-order clustering with built-in expressions only.

Every column is replaced by its rank among cut points, the ranks' bits are interleaved into
one number, and rows are range-partitioned and sorted by that number. Files then cover narrow
ranges of each column, which the scan's min/max statistics can skip. Cut points are whole
values of any type that can be ordered, so long common starts of texts do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    FractionalType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.functions.timestamps import utc_wall_clock, wall_clock_to_instant
from tablesync.operators.shape import quoted

ZVALUE = "_zvalue"
SALT = "_zsalt"

# Bits of a z-value; a column beyond as many only orders the rows of a cell.
MAX_BITS = 62

# Sampled rows per cut point. Cut points shape the files, they decide no row's content.
ROWS_PER_CUT = 100


def bits_per_column(n_columns: int, num_files: int) -> int:
    """Bits of each column, so that all together tell some times more cells than files."""
    wanted = math.ceil((math.log2(max(num_files, 1)) + 2) / n_columns)
    return max(1, min(wanted, MAX_BITS // min(n_columns, MAX_BITS), 12))


def _cut_points(df: DataFrame, columns: Sequence[str], bits: int) -> list[list[str]]:
    """`2^bits - 1` rising cut points per column as text, NULL left out.

    They split the rows about evenly, so a frequent value stands for several of them. Numbers, dates and
    times go through mergeable quantile sketches, all in one pass; their size is fixed, and each task hands
    on one. Other types have no such sketch and are sampled.
    """
    sketched = [name for name in columns if _sketched(df.schema[name].dataType)]
    points = _sketched_points(df, sketched, bits) if sketched else {}
    others = [name for name in columns if name not in points]
    points |= _sampled_points(df, others, bits) if others else {}
    return [points[name] for name in columns]


def _sketched(data_type: DataType) -> bool:
    return isinstance(data_type, (NumericType, DateType, TimestampType, TimestampNTZType))


def _sketched_points(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[str]]:
    """Cut points of columns whose values map to numbers in their order."""
    whole = [n for n in columns if not isinstance(df.schema[n].dataType, FractionalType)]
    ranks = F.lit([i / 2**bits for i in range(1, 2**bits)])
    sketches = []
    for at, name in enumerate(columns):
        number = _as_number(quoted(name), df.schema[name].dataType)
        if name in whole:
            points = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(number), ranks)
        else:  # values that are no number are the greatest, and no cut point
            finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
            points = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(finite), ranks)
        present = F.count(number if name in whole else finite)
        sketches.append(F.when(present > 0, F.struct(points.alias("p"))).alias(f"c{at}"))
    row = df.agg(*sketches).first()
    found = {}
    spelled = df.sparkSession.range(1)
    for at, name in enumerate(columns):
        data_type, cuts = df.schema[name].dataType, row[at]
        found[name] = []
        if cuts:
            texts = F.transform(F.lit(list(cuts["p"])), partial(_spelled, data_type))
            found[name] = [text for text in spelled.select(texts.alias("t")).first()["t"] if text is not None]
    return found


def _spelled(data_type: DataType, number: Column) -> Column:
    return _as_text(_from_number(number, data_type), data_type)


def _as_number(column: Column, data_type: DataType) -> Column:
    """A value as a whole number or a double, in the same order."""
    if isinstance(data_type, DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(data_type, TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, TimestampNTZType):
        return F.unix_micros(wall_clock_to_instant(column, "UTC"))
    return column.cast("double" if isinstance(data_type, FractionalType) else "bigint")


def _from_number(column: Column, data_type: DataType) -> Column:
    if isinstance(data_type, DateType):
        return F.date_from_unix_date(column.cast("int"))
    if isinstance(data_type, TimestampType):
        return F.timestamp_micros(column)
    if isinstance(data_type, TimestampNTZType):
        return utc_wall_clock(F.timestamp_micros(column))
    return column.try_cast(data_type)


def _sampled_points(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[str]]:
    """Cut points from a sample whose size goes with their number only."""
    n_cells = 2**bits
    n_rows = df.count()
    share = min(1.0, ROWS_PER_CUT * n_cells / max(n_rows, 1))
    sample = df.select([quoted(name) for name in columns])
    sample = sample if share == 1.0 else sample.sample(share, seed=1)
    places = F.sequence(F.lit(1), F.lit(n_cells - 1))

    def cuts(name: str) -> Column:
        ordered = F.sort_array(F.collect_list(quoted(name)))
        at = F.transform(places, lambda i: F.floor(i * F.size(ordered) / n_cells).cast("int"))
        return F.transform(at, lambda i: _as_text(F.get(ordered, i), df.schema[name].dataType))

    row = sample.agg(*[cuts(name).alias(f"c{i}") for i, name in enumerate(columns)]).first()
    return {name: [cut for cut in points if cut is not None] for name, points in zip(columns, row, strict=True)}


def _as_text(value: Column, data_type: DataType) -> Column:
    return F.hex(value) if isinstance(data_type, BinaryType) else value.cast("string")


def _rank(column: Column, data_type: DataType, cuts: Sequence[str], bits: int) -> Column:
    """Number of cut points not above the value, by binary search; NULL ranks lowest."""
    if not cuts:
        return F.lit(0).cast("long")
    texts = F.lit(list(cuts))
    if isinstance(data_type, BinaryType):
        points = F.transform(texts, F.unhex)
    else:
        points = texts.cast(f"array<{data_type.simpleString()}>")
    steps = F.lit([2**bit for bit in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(
            (found + step <= len(cuts)) & (F.get(points, found + step - 1) <= column), found + step
        ).otherwise(found),
    ).cast("long")


def interleave(ranks: Sequence[Column], bits: int) -> Column:
    """Z-value: bit `b` of rank `i` becomes bit `b * n + (n - 1 - i)`."""
    n = len(ranks)
    if bits * n > MAX_BITS:
        raise ValueError("too many clustering columns for the number of bits")
    value = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            value = value.bitwiseOR(F.shiftleft(taken, bit * n + (n - 1 - i)))
    return value


def with_zvalue(df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """`df` with the z-value of each row, from cut points taken over all its rows."""
    columns = list(columns)[: MAX_BITS // bits]
    types = {field.name: field.dataType for field in df.schema}
    cuts = _cut_points(df, columns, bits)
    ranks = [_rank(quoted(n), types[n], points, bits) for n, points in zip(columns, cuts)]
    return df.withColumn(ZVALUE, interleave(ranks, bits))


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    num_files: int,
    partition_by: Sequence[str] = (),
    salt: Column | None = None,
    sort: bool = True,
) -> DataFrame:
    """`df` in `num_files` partitions ordered by z-value within `partition_by`.

    Rows of a cell are ordered by the columns themselves. The salt is the last range key, so a value combination that fills a large part of the
    table is still spread over several tasks and files. It must be deterministic for a row;
    by default it is a hash of the whole row, while a table scan can pass its row position.
    Without `sort`, the z-value stays as a column for the caller to sort by.
    """
    if salt is None:
        salt = F.xxhash64(*[quoted(name) for name in df.columns])
    bits = bits_per_column(len(columns), num_files)
    marked = with_zvalue(df.withColumn(SALT, salt), columns, bits)
    ranges = [*[quoted(name) for name in partition_by], F.col(ZVALUE), *[quoted(n) for n in columns]]
    clustered = marked.repartitionByRange(num_files, *ranges, F.col(SALT)).drop(SALT)
    return clustered.sortWithinPartitions(*ranges).drop(ZVALUE) if sort else clustered
