"""JDBC reads: one connection, parallel ranges, and version-range slices.

All functions take the connection as a plain options mapping (`url`, `driver`, credentials and
whatever else Spark's JDBC source accepts) and a relation: a table name or a `select` text.
Timestamps are read as `timestamp_ntz`, the wall clock the source shows, so that the result
does not depend on the time zone of any JVM.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal, InvalidOperation
from functools import reduce
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.operators.predicates import filter_source
from tablesync.operators.shape import quoted

# SQL type names and the Spark types they are read as. Anything else is text.
SQL_TYPES: dict[str, DataType] = {
    "BOOLEAN": BooleanType(),
    "BIT": BooleanType(),
    "TINYINT": IntegerType(),
    "SMALLINT": IntegerType(),
    "INTEGER": IntegerType(),
    "BIGINT": LongType(),
    "REAL": FloatType(),
    "FLOAT": DoubleType(),
    "DOUBLE": DoubleType(),
    "BINARY": BinaryType(),
    "VARBINARY": BinaryType(),
    "LONGVARBINARY": BinaryType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}

# Rounds of a histogram, its edges at most (a tree of ten comparisons), and the share of a range's mean that a
# cell may hold.
HISTOGRAM_ROUNDS, MOST_EDGES, FINENESS = 6, 1000, 0.25

# Types of columns by which a read can be split into ranges.
_RANGE_TYPES = (NumericType, DateType, TimestampType, TimestampNTZType)


def subquery(relation: str) -> str:
    """Relation text for the `dbtable` option: a query becomes a named subquery."""
    text = relation.strip().rstrip(";")
    return f"({text}) subq" if text[:6].lower() in ("select", "values") or text[:4].lower() == "with" else text


def jdbc_scan(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    custom_schema: str = "",
) -> DataFrame:
    """Read a table or query over one connection; filters and columns are pushed down by Spark."""
    reader = spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**options)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    return reader.option("dbtable", subquery(relation)).load()


def format_bounds(bounds: DataFrame) -> DataFrame:
    """Bounds as text; timestamps are truncated to their day."""
    def text(name: str, data_type: DataType) -> Column:
        column = quoted(name)
        if isinstance(data_type, (TimestampType, TimestampNTZType)):
            day = F.date_trunc("day", column)
            column = F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSS")
        return column.cast("string").alias(name)

    return bounds.select(*[text(field.name, field.dataType) for field in bounds.schema])


def partition_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row `max_bound, min_bound` (text) over the rows of `df`; NULLs if there are none."""
    return format_bounds(
        df.agg(F.max(quoted(column)).alias("max_bound"), F.min(quoted(column)).alias("min_bound"))
    )


def jdbc_bounds(
    spark: SparkSession, options: Mapping[str, str], relation: str, column: str, whole_days: bool = True
) -> DataFrame:
    """`partition_bounds` computed by the source itself over the same query.

    Without `whole_days` timestamps keep their time.
    """
    query = (
        f"select max(b.{column}) as max_bound, min(b.{column}) as min_bound "
        f"from {_derived_table(relation)} b"
    )
    bounds = jdbc_scan(spark, options, query).toDF("max_bound", "min_bound")
    return format_bounds(bounds) if whole_days else bounds.select(*[F.col(c).cast("string") for c in bounds.columns])


def _derived_table(relation: str) -> str:
    text = subquery(relation)
    return text[: -len(" subq")] if text.endswith(") subq") else text


def filtered_relation(relation: str, conditions: Sequence[str]) -> str:
    """Query over a relation with conditions for the source itself to evaluate."""
    if not conditions:
        return relation
    text = " and ".join(f"({condition})" for condition in conditions)
    return f"select * from {_derived_table(relation)} f where {text}"


def window_condition(column: str, data_type: DataType, start: dt.date, end: dt.date) -> str:
    """`[start, end)` on a column in the source's SQL, with JDBC's date and time literals."""
    if isinstance(data_type, DateType):
        return f"{column} >= {{d '{start}'}} and {column} < {{d '{end}'}}"
    return f"{column} >= {{ts '{start} 00:00:00'}} and {column} < {{ts '{end} 00:00:00'}}"


def column_type(df: DataFrame, column: str) -> DataType:
    """Type of a column whose name may be quoted and in any case, as source SQL allows."""
    wanted = column.strip('"[]`').lower()
    return next(f.dataType for f in df.schema if f.name.lower() == wanted)


def jdbc_partitioned_scan(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    column: str,
    num_partitions: int,
    custom_schema: str = "",
    even: bool = True,
) -> DataFrame:
    """Read in up to `num_partitions` parallel ranges of a numeric, date or timestamp column.

    The ranges hold about equally many rows of the relation, by a histogram that the source counts
    (`depth_edges`): each of its few rounds is one grouped query over the split column. With
    `even=False` they are equally wide instead, from one query for the bounds. Either way a filter
    that narrows the rows belongs into the relation (`filtered_relation`). An empty source is read
    over one connection. A value that holds much of the source stays in one range.
    """
    scan = jdbc_scan(spark, options, relation, custom_schema)
    split_type = column_type(scan, column)
    if not isinstance(split_type, _RANGE_TYPES):
        raise ValueError(f"cannot split a read by {column} of type {split_type.simpleString()}")
    if even:
        edges, n_null, mean = depth_edges(spark, options, relation, column, num_partitions)
        predicates = range_conditions(column, edges, n_null > mean)
        return _jdbc_predicates(spark, options, relation, predicates, custom_schema) if len(predicates) > 1 else scan
    bounds = jdbc_bounds(spark, options, relation, column, whole_days=False).first()
    if bounds is None or bounds["min_bound"] is None:
        return scan
    if isinstance(split_type, TimestampNTZType):
        predicates = time_ranges(column, bounds["min_bound"], bounds["max_bound"], num_partitions)
        return _jdbc_predicates(spark, options, relation, predicates, custom_schema)
    ranges = {
        "partitionColumn": column,
        "lowerBound": _whole(bounds["min_bound"], math.floor),
        "upperBound": _whole(bounds["max_bound"], math.ceil),
        "numPartitions": str(num_partitions),
    }
    return jdbc_scan(spark, {**options, **ranges}, relation, custom_schema)


class _Cell(NamedTuple):
    """Values of a column between two that occur, both included, and how many rows have them."""

    low: Any
    high: Any
    n: int


def depth_edges(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    column: str,
    parts: int,
    weight: str = "1",
) -> tuple[list, int, float]:
    """Values that cut a relation into `parts` ranges of about equally many rows; the number of rows
    without a value, and the mean of a range.

    The source counts the rows between some edges and tells the least and greatest value there; cells
    that hold too much are cut again, between values that occur, until none does or all its rows
    have one value. `weight` is what a row counts for, as SQL.
    """
    derived = _derived_table(relation)
    query = f"select min(b.{column}) as low, max(b.{column}) as high, sum({_present(column, weight)}) as n, sum({weight}) as m from {derived} b"
    whole = jdbc_scan(spark, options, query).toDF("low", "high", "n", "m").first()
    total = int(whole["n"] or 0)
    n_null, mean = int(whole["m"] or 0) - total, max(total, 1) / parts
    cells = [_Cell(whole["low"], whole["high"], total)] if whole["low"] is not None else []
    for _ in range(HISTOGRAM_ROUNDS):
        heavy = [c for c in cells if c.n > mean * FINENESS and c.low != c.high]
        room = MOST_EDGES - len(cells)
        if not heavy or room < 1:
            break
        weights = sum(c.n for c in heavy)
        inner = [e for c in heavy for e in _between(c.low, c.high, 2 + int(min(room * c.n / weights, 8 * c.n / mean)))]
        edges = sorted({c.low for c in cells[1:]} | set(inner))[:MOST_EDGES]
        query = (
            f"select q.bucket, min(q.c) as low, max(q.c) as high, sum(q.w) as n from "
            f"(select {_bucket(f'b.{column}', edges)} as bucket, b.{column} as c, {weight} as w from {derived} b where b.{column} is not null) q "
            "group by q.bucket"
        )
        # no more rows than edges
        counted = jdbc_scan(spark, options, query).toDF("bucket", "low", "high", "n").collect()
        cells = sorted(_Cell(r["low"], r["high"], int(r["n"])) for r in counted)
    before = list(accumulate((c.n for c in cells), initial=0))
    edges = set()
    for part in range(1, parts):
        nearest = min(range(len(cells)), key=lambda i: abs(before[i] - part * total / parts), default=0)
        if nearest:
            edges.add(cells[nearest].low)
    return sorted(edges), n_null, mean


def _present(column: str, weight: str) -> str:
    return f"case when b.{column} is null then 0 else {weight} end"


def _between(low, high, pieces: int) -> list:
    """Inner edges of equally wide pieces, of the values' own type."""
    if isinstance(low, dt.date) and not isinstance(low, dt.datetime):
        days = (high - low).days
        return sorted({low + dt.timedelta(days=-(-days * i // pieces)) for i in range(1, pieces)} - {low})
    if isinstance(low, int):
        return sorted({low - (-(high - low) * i // pieces) for i in range(1, pieces)} - {low})
    step = (high - low) / pieces
    return sorted({low + step * i for i in range(1, pieces)} - {low})


def sql_literal(value) -> str:
    """A number, date or wall clock as SQL, times with JDBC's literals."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value}'}}"
    if isinstance(value, Decimal):
        return f"{value:f}"
    return repr(value).upper()


def _bucket(column: str, edges: Sequence, first: int = 0) -> str:
    """The number of edges up to a value, as a balanced tree of comparisons."""
    if not edges:
        return str(first)
    middle = len(edges) // 2
    below, above = _bucket(column, edges[:middle], first), _bucket(column, edges[middle + 1 :], first + middle + 1)
    return f"case when {column} < {sql_literal(edges[middle])} then {below} else {above} end"


def range_conditions(column: str, edges: Sequence, nulls_apart: bool = False) -> list[str]:
    """Adjacent conditions between the edges; the outer ones are open, the first takes the NULLs
    unless they stand apart."""
    marks = [sql_literal(edge) for edge in edges]
    if not marks:
        return [f"{column} is null", f"{column} is not null"] if nulls_apart else [f"{column} is null or {column} is not null"]
    lowest = [f"{column} is null", f"{column} < {marks[0]}"] if nulls_apart else [f"{column} < {marks[0]} or {column} is null"]
    middle = [f"{column} >= {a} and {column} < {b}" for a, b in zip(marks, marks[1:], strict=False)]
    return [*lowest, *middle, f"{column} >= {marks[-1]}"]


def _whole(bound: str, rounding: Callable[[Decimal], int]) -> str:
    """A fractional bound as the whole number Spark wants for numeric columns."""
    try:
        number = Decimal(bound)
    except InvalidOperation:
        return bound
    return str(rounding(number))


def time_ranges(column: str, lower: str, upper: str, num_partitions: int) -> list[str]:
    """Adjacent conditions on a timestamp column, one per partition; the outer ones are open.

    Spark splits by instants only; these conditions compare wall clocks, as the source does.
    """
    first, last = dt.datetime.fromisoformat(lower), dt.datetime.fromisoformat(upper)
    step = (last - first) / num_partitions
    inner = sorted({first + step * i for i in range(1, num_partitions)} - {first})
    edges = [f"{{ts '{edge:%Y-%m-%d %H:%M:%S.%f}'}}" for edge in inner]
    if not edges:
        return [f"{column} is null or {column} is not null"]
    middle = [f"{column} >= {a} and {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} or {column} is null", *middle, f"{column} >= {edges[-1]}"]


def _jdbc_predicates(
    spark: SparkSession,
    options: Mapping[str, str],
    relation: str,
    predicates: list[str],
    custom_schema: str = "",
) -> DataFrame:
    """One partition per condition."""
    properties = {name: value for name, value in options.items() if name != "url"}
    properties["preferTimestampNTZ"] = "true"
    if custom_schema:
        properties["customSchema"] = custom_schema
    return spark.read.jdbc(
        url=options["url"], table=subquery(relation), predicates=predicates, properties=properties
    )


def table_filter_scan(
    scan: DataFrame, where: Column | str | None = None, window: Column | None = None
) -> DataFrame:
    """A full-table scan with the composed predicate."""
    return filter_source(scan, where, window)


def query_scan(
    spark: SparkSession,
    query: str,
    where: Column | str | None = None,
    window: Column | None = None,
    args: Mapping | None = None,
) -> DataFrame:
    """A Spark SQL query as source; window and predicate apply to its result, each when given."""
    return filter_source(spark.sql(query, args=dict(args or {})), where, window)


def type_override_schema(
    catalog: DataFrame, by: Sequence[str] = (), timestamp_type: str = "timestamp"
) -> DataFrame:
    """`customSchema` text per group of a column catalog `(column_name, data_type, …)`.

    Lists the `date` and `datetime2` columns, the latter as timestamps; empty text if a group
    has none. The number of columns of one table bounds each list.
    """
    source_type = F.lower(quoted("data_type"))
    spark_type = (
        F.when(source_type == "datetime2", timestamp_type).when(source_type == "date", "date")
    )
    entry = F.when(spark_type.isNotNull(), F.concat_ws(" ", quoted("column_name"), spark_type))
    text = F.array_join(F.sort_array(F.collect_set(entry)), ", ")
    return catalog.groupBy([quoted(name) for name in by]).agg(text.alias("custom_schema"))


def normalise_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Cast columns from their declared SQL types; undeclared columns stay as they are.

    `DECIMAL(p,s)` and `NUMERIC(p,s)` keep precision (38 at most) and scale; unknown types are
    read as text. A value that does not fit becomes NULL.
    """
    return df.select(
        *[
            quoted(name).try_cast(spark_type(declared[name])).alias(name)
            if name in declared
            else quoted(name)
            for name in df.columns
        ]
    )


def spark_type(sql_type: str) -> DataType:
    """Spark type for a SQL type name with optional `(precision, scale)`."""
    name, _, rest = sql_type.strip().upper().partition("(")
    name = name.strip()
    if name in ("DECIMAL", "NUMERIC"):
        digits = [int(part) for part in rest.rstrip(") ").split(",") if part.strip()]
        precision = min(digits[0], 38) if digits else 38
        return DecimalType(precision, min(digits[1], precision) if len(digits) > 1 else 0)
    return SQL_TYPES.get(name, StringType())


def version_slices(last: int, current: int, num_slices: int) -> list[tuple[int, int]]:
    """`(last, current]` as at most `num_slices` adjacent half-open ranges `(from, to]`."""
    width = max(current - last, 0)
    n = max(1, min(num_slices, width))
    edges = [last + width * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:]))


def depth_slices(last: int, current: int, edges: Sequence[int]) -> list[tuple[int, int]]:
    """`(last, current]` cut before each of the edges."""
    inner = [int(edge) - 1 for edge in edges if last < int(edge) - 1 < current]
    marks = [last, *inner, current]
    return list(zip(marks, marks[1:], strict=False))


def version_range_scan(
    df: DataFrame, version: str, last: int, current: int
) -> DataFrame:
    """Rows of a feed with `last < version <= current`."""
    number = quoted(version)
    return df.where((number > last) & (number <= current))


def jdbc_version_range_scan(
    spark: SparkSession,
    options: Mapping[str, str],
    feed: str | Callable[[int, int], str],
    version: str,
    last: int,
    current: int,
    num_slices: int,
    counts: Callable[[int, int], str] | None = None,
) -> DataFrame:
    """Read a change feed of `(last, current]` in parallel slices of versions.

    `feed` is a relation with a version column, or a function from `(last, current)` to a
    query (a table function or procedure call of the source); it is then called once per
    slice and `version` is not needed, unless `counts` is given: a function from `(last, current)`
    to a query for the number `n` of changes of each version (`version`). The slices hold about equally
    many changes where the source can count them (a relation, or `counts`), else equally many versions.
    A source that can only answer the whole range is read with `num_slices=1`; those rows are spread
    over the cluster afterwards.
    """
    slices = version_slices(last, current, num_slices)
    if len(slices) > 1 and (counts is not None or not callable(feed)):
        limits = [f"{version} > {last}", f"{version} <= {current}"]
        counted = counts(last, current) if counts is not None else filtered_relation(feed, limits)
        weight = "1" if counts is None else "b.n"
        edges, _, _ = depth_edges(spark, options, counted, version, num_slices, weight)
        slices = depth_slices(last, current, edges)
    if callable(feed):
        parts = [jdbc_scan(spark, options, feed(low, high)) for low, high in slices]
        df = reduce(DataFrame.unionByName, parts)
    else:
        predicates = [f"{version} > {low} and {version} <= {high}" for low, high in slices]
        df = _jdbc_predicates(spark, options, feed, predicates)
    if len(slices) > 1:
        return df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def scalar_version(df: DataFrame) -> int:
    """First row, first column as a version number."""
    row = df.first()
    if row is None or row[0] is None:
        raise ValueError("the source returned no version: is change tracking enabled there?")
    return int(row[0])
