"""JDBC reads of a table that Spark first copies into the database embedded in its own JVM.

That database is seen by one process only, so these queries run in a local session and refuse
any other. The operators themselves take any JDBC source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.predicates import date_window
from tablesync.sources.jdbc import (
    jdbc_bounds,
    jdbc_partitioned_scan,
    jdbc_scan,
    jdbc_version_range_scan,
    table_filter_scan,
)
from tablesync_checks.data import read


def embedded_copy(spark: SparkSession, df: DataFrame, name: str) -> dict[str, str]:
    """Copy a frame into a new in-memory database and return its connection options."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("the embedded database is visible to its own process only")
    options = {
        "url": f"jdbc:derby:memory:c{uuid.uuid4().hex};create=true",
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    }
    upper = df.toDF(*[column.upper() for column in df.columns])
    upper.write.format("jdbc").options(**options).option("dbtable", name.upper()).save()
    return options


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[column.lower() for column in df.columns])


def _jdbc_scan(spark, sf):
    options = embedded_copy(spark, read(spark, sf, "orders"), "orders")
    return _lower(jdbc_scan(spark, options, "select * from ORDERS"))


def _jdbc_filter_scan(spark, sf):
    options = embedded_copy(spark, read(spark, sf, "orders"), "orders")
    window = date_window("O_ORDERDATE", "1996-01-01", "1999-01-01")
    return _lower(table_filter_scan(jdbc_scan(spark, options, "ORDERS"), "O_TOTALPRICE > 1000", window))


def _jdbc_partitioned_scan(spark, sf):
    options = embedded_copy(spark, read(spark, sf, "orders"), "orders")
    return _lower(jdbc_partitioned_scan(spark, options, "ORDERS", "O_ORDERKEY", 8))


def _jdbc_partitioned_scan_by_time(spark, sf):
    options = embedded_copy(spark, read(spark, sf, "orders"), "orders")
    return _lower(jdbc_partitioned_scan(spark, options, "select * from ORDERS", "O_ORDERDATE", 5))


def _jdbc_bounds(spark, sf):
    options = embedded_copy(spark, read(spark, sf, "events"), "events")
    return jdbc_bounds(spark, options, "EVENTS", "TS")


def _jdbc_version_range_scan(spark, sf):
    events = read(spark, sf, "events")
    options = embedded_copy(spark, events, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    return _lower(jdbc_version_range_scan(spark, options, "EVENTS", "EVENT_ID", low, high, 6))


QUERIES = {
    "jdbc_scan": _jdbc_scan,
    "jdbc_filter_scan": _jdbc_filter_scan,
    "jdbc_partitioned_scan": _jdbc_partitioned_scan,
    "jdbc_partitioned_scan_by_time": _jdbc_partitioned_scan_by_time,
    "jdbc_bounds": _jdbc_bounds,
    "jdbc_version_range_scan": _jdbc_version_range_scan,
}

ORACLE = {
    "jdbc_scan": "select * from orders",
    "jdbc_filter_scan": """
        select * from orders
        where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1999-01-01'
          and o_totalprice > 1000""",
    "jdbc_partitioned_scan": "select * from orders",
    "jdbc_partitioned_scan_by_time": "select * from orders",
    "jdbc_bounds": """
        select strftime(date_trunc('day', max(ts))::timestamp, '%Y-%m-%d %H:%M:%S.%g') as max_bound,
               strftime(date_trunc('day', min(ts))::timestamp, '%Y-%m-%d %H:%M:%S.%g') as min_bound from events""",
    "jdbc_version_range_scan": "select * from events where event_id > (select min(event_id) from events)",
}
