"""Scans, filters, column shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.functions.cursor import cursor_json, cursor_version
from tablesync.functions.names import slug_column
from tablesync.operators.merge import drop_change_columns
from tablesync.operators.predicates import date_window, filter_source, string_join, touched_partitions
from tablesync.operators.schema import catalog_difference
from tablesync.operators.shape import (
    add_generated_column,
    add_ingestion_time,
    clean_column_names,
    date_to_timestamp,
    partition_timestamp_to_date,
    shape,
    timestamp_to_utc,
)
from tablesync.sources.jdbc import (
    normalise_types,
    partition_bounds,
    query_scan,
    table_filter_scan,
    type_override_schema,
    version_range_scan,
)
from tablesync_checks.data import ORDERS_CHANGES_SQL, orders_changes, plain_times, read

ZONE = "Europe/Kiev"


def _table_filter_scan(spark, sf):
    return table_filter_scan(read(spark, sf, "orders"), "o_orderpriority <> '5-LOW' and o_totalprice > 1000")


def _date_window_filter(spark, sf):
    return filter_source(read(spark, sf, "orders"), window=date_window("o_orderdate", "1996-01-01", "1998-07-01"))


def _user_where(spark, sf):
    return table_filter_scan(
        read(spark, sf, "orders"),
        "o_orderstatus = 'O' or o_totalprice < 50000",
        date_window("o_orderdate", "1995-06-01", "2001-01-01"),
    )


def _query_scan_windowed(spark, sf):
    query = f"""
        select o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment
        from parquet.`{sf}/orders.parquet` o join parquet.`{sf}/customer.parquet` c
          on o.o_custkey = c.c_custkey"""
    return query_scan(
        spark, query, "c_mktsegment <> 'BUILDING'", date_window("o_orderdate", "1996-01-01", "2000-01-01")
    )


def _bound_version_query(spark, sf):
    """The user's own change query with the run's versions bound to its named markers."""
    bounds = read(spark, sf, "events").agg(F.min("event_id"), F.max("event_id")).first()
    return query_scan(
        spark,
        f"select event_id, user_id, event_type, value from parquet.`{sf}/events.parquet` "
        "where event_id > :queryCTLastVersion and event_id <= :queryCTCurrentVersion",
        args={"queryCTLastVersion": bounds[0], "queryCTCurrentVersion": bounds[1]},
    )


def _version_range_scan(spark, sf):
    events = read(spark, sf, "events")
    bounds = events.agg(F.min("event_id"), F.max("event_id")).first()
    return version_range_scan(events, "event_id", bounds[0], bounds[1])


def _partition_bounds(spark, sf):
    return partition_bounds(read(spark, sf, "orders"), "o_orderdate")


def _partition_bounds_numeric(spark, sf):
    return partition_bounds(read(spark, sf, "lineitem"), "l_orderkey")


def _partition_bounds_time_of_day(spark, sf):
    return partition_bounds(read(spark, sf, "events"), "ts")


def _type_override_schema(spark, sf):
    """A column catalog of many tables: every order is one, its line numbers are the columns."""
    catalog = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("table_name"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.expr("case l_returnflag when 'A' then 'date' when 'R' then 'datetime2' else 'int' end")
        .alias("data_type"),
    )
    return type_override_schema(catalog, ["table_name"])


def _normalise_types(spark, sf):
    return normalise_types(
        read(spark, sf, "part"),
        {"p_partkey": "INTEGER", "p_size": "BIGINT", "p_retailprice": "DECIMAL(12,2)", "p_brand": "XML"},
    )


def _odd_customer(spark, sf):
    return read(spark, sf, "customer").toDF("c_cust key", "c.(name)", "c:nation", "c_acct\tbal*", "seg ment.")


def _clean_column_names(spark, sf):
    return clean_column_names(_odd_customer(spark, sf))


def _add_generated_column(spark, sf):
    return add_generated_column(
        read(spark, sf, "orders"), "day_key", "replace(cast(cast(o_orderdate as date) as string), '-', '')", "int"
    )


def _generated_column_overwrite(spark, sf):
    return add_generated_column(
        read(spark, sf, "orders"), "o_orderpriority", "substring(o_orderpriority, 1, 1)", "int"
    )


def _date_to_timestamp(spark, sf):
    dated = read(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return plain_times(date_to_timestamp(dated, ZONE))


def _timestamp_to_utc(spark, sf):
    return plain_times(timestamp_to_utc(read(spark, sf, "events"), ZONE))


def _partition_timestamp_to_date(spark, sf):
    return partition_timestamp_to_date(read(spark, sf, "events"), ["TS"])


def _add_ingestion_time(spark, sf):
    moment = F.lit("2024-05-06 07:08:09").cast("timestamp_ntz")
    return add_ingestion_time(read(spark, sf, "customer"), moment)


def _table_slug(spark, sf):
    return read(spark, sf, "part").select(
        "p_partkey", slug_column(F.concat_ws("#", "p_brand", "p_name")).alias("slug")
    )


def _shape_orders(spark, sf):
    shaped = shape(
        orders_changes(spark, sf),
        ZONE,
        partition_columns=["o_orderstatus"],
        generated=("order_year", "year(o_orderdate)", "string"),
        ingestion_time=False,
    )
    return plain_times(drop_change_columns(shaped))


def _shape_events(spark, sf):
    """Partition date as the source's calendar shows it, other times as instants."""
    events = read(spark, sf, "events").withColumn("day", F.col("ts"))
    return plain_times(shape(events, ZONE, ["day"], ingestion_time=False))


def _touched_partitions(spark, sf):
    return touched_partitions(read(spark, sf, "orders"), "o_orderpriority")


def _partition_values(spark, sf):
    return string_join(read(spark, sf, "orders"), "o_orderpriority", ["o_orderstatus"], "priorities")


def _catalogs(spark, sf):
    part = read(spark, sf, "part").select(
        F.col("p_brand").alias("table_name"), F.col("p_type").alias("column_name"), "p_size"
    )
    return part.where("p_size <= 25").drop("p_size"), part.where("p_size > 25").drop("p_size")


def _schema_check(spark, sf):
    source, target = _catalogs(spark, sf)
    return catalog_difference(source, target, ["table_name", "column_name"])


def _cursor_metadata(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", cursor_json(F.col("event_id")).alias("user_metadata")
    ).withColumn("version", cursor_version(F.col("user_metadata")))


QUERIES = {
    "table_filter_scan": _table_filter_scan,
    "date_window_filter": _date_window_filter,
    "user_where": _user_where,
    "query_scan_windowed": _query_scan_windowed,
    "bound_version_query": _bound_version_query,
    "version_range_scan": _version_range_scan,
    "partition_bounds": _partition_bounds,
    "partition_bounds_numeric": _partition_bounds_numeric,
    "partition_bounds_time_of_day": _partition_bounds_time_of_day,
    "type_override_schema": _type_override_schema,
    "normalise_types": _normalise_types,
    "clean_column_names": _clean_column_names,
    "add_generated_column": _add_generated_column,
    "generated_column_overwrite": _generated_column_overwrite,
    "date_to_timestamp": _date_to_timestamp,
    "timestamp_to_utc": _timestamp_to_utc,
    "partition_timestamp_to_date": _partition_timestamp_to_date,
    "add_ingestion_time": _add_ingestion_time,
    "table_slug": _table_slug,
    "shape_orders": _shape_orders,
    "shape_events": _shape_events,
    "touched_partitions": _touched_partitions,
    "partition_values": _partition_values,
    "schema_check": _schema_check,
    "cursor_metadata": _cursor_metadata,
}

_BOUNDS = (
    "select strftime(date_trunc('day', max({c}))::timestamp, '%Y-%m-%d %H:%M:%S.%g') as max_bound, "
    "strftime(date_trunc('day', min({c}))::timestamp, '%Y-%m-%d %H:%M:%S.%g') as min_bound from {t}"
)

ORACLE = {
    "table_filter_scan": "select * from orders where o_orderpriority <> '5-LOW' and o_totalprice > 1000",
    "date_window_filter": """
        select * from orders
        where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-07-01'""",
    "user_where": """
        select * from orders
        where o_orderdate >= timestamp '1995-06-01' and o_orderdate < timestamp '2001-01-01'
          and (o_orderstatus = 'O' or o_totalprice < 50000)""",
    "query_scan_windowed": """
        select o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment
        from orders o join customer c on o.o_custkey = c.c_custkey
        where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '2000-01-01'
          and c_mktsegment <> 'BUILDING'""",
    "bound_version_query": """
        select event_id, user_id, event_type, value from events
        where event_id > (select min(event_id) from events)""",
    "version_range_scan": "select * from events where event_id > (select min(event_id) from events)",
    "partition_bounds": _BOUNDS.format(c="o_orderdate", t="orders"),
    "partition_bounds_numeric": """
        select cast(max(l_orderkey) as varchar) as max_bound,
               cast(min(l_orderkey) as varchar) as min_bound from lineitem""",
    "partition_bounds_time_of_day": _BOUNDS.format(c="ts", t="events"),
    "type_override_schema": """
        select l_orderkey as table_name, coalesce(string_agg(distinct entry, ', ' order by entry), '') as custom_schema
        from (select l_orderkey,
                     case l_returnflag when 'A' then 'c' || l_linenumber || ' date'
                                       when 'R' then 'c' || l_linenumber || ' timestamp' end as entry
              from lineitem) c
        group by l_orderkey""",
    "normalise_types": """
        select cast(p_partkey as integer) as p_partkey, p_name, p_brand, p_type,
               cast(p_size as bigint) as p_size, cast(p_retailprice as decimal(12, 2)) as p_retailprice
        from part""",
    "clean_column_names": """
        select c_custkey as "c_cust__key", c_name as "c__name", c_nationkey as "c__nation",
               c_acctbal as "c_acct__bal*", c_mktsegment as "seg__ment__" from customer""",
    "add_generated_column": """
        select *, cast(replace(cast(cast(o_orderdate as date) as varchar), '-', '') as integer) as day_key
        from orders""",
    "generated_column_overwrite":
        "select * replace (cast(substring(o_orderpriority, 1, 1) as integer) as o_orderpriority) from orders",
    "date_to_timestamp": """
        select * replace ((cast(cast(o_orderdate as date) as timestamp) at time zone 'Europe/Kiev')
                          at time zone 'UTC' as o_orderdate) from orders""",
    "timestamp_to_utc": """
        select * replace ((ts at time zone 'Europe/Kiev') at time zone 'UTC' as ts) from events""",
    "partition_timestamp_to_date": "select * replace (cast(ts as date) as ts) from events",
    "add_ingestion_time": """
        select timestamp '2024-05-06 07:08:09' as _platform_ingested_at, * from customer""",
    "table_slug": """
        select p_partkey, lower(regexp_replace(p_brand || '#' || p_name, '[^A-Za-z0-9_]', '_', 'g')) as slug
        from part""",
    "shape_orders": f"""
        select case when op <> 'D' then pk end as o_orderkey,
               case when op <> 'D' then o_custkey end as o_custkey,
               case when op <> 'D' then o_orderstatus end as o_orderstatus,
               case when op <> 'D' then o_totalprice end as o_totalprice,
               case when op <> 'D' then (o_orderdate at time zone 'Europe/Kiev') at time zone 'UTC' end as o_orderdate,
               case when op <> 'D' then o_orderpriority end as o_orderpriority,
               case when op <> 'D' then cast(year(o_orderdate) as varchar) end as order_year
        from ({ORDERS_CHANGES_SQL}) c""",
    "shape_events": """
        select * replace ((ts at time zone 'Europe/Kiev') at time zone 'UTC' as ts), cast(ts as date) as "day"
        from events""",
    "touched_partitions": "select distinct o_orderpriority from orders",
    "partition_values": """
        select o_orderstatus, string_agg(distinct o_orderpriority, ', ' order by o_orderpriority) as priorities
        from orders group by o_orderstatus""",
    "schema_check": """
        with s as (select distinct p_brand as table_name, p_type as column_name from part where p_size <= 25),
             t as (select distinct p_brand as table_name, p_type as column_name from part where p_size > 25)
        select table_name, column_name, 'source' as side from (select * from s except select * from t) a
        union all
        select table_name, column_name, 'target' as side from (select * from t except select * from s) b""",
    "cursor_metadata": """
        select event_id, '{"ChangeTrackingVersion":' || cast(event_id as varchar) || '}' as user_metadata,
               event_id as version from events""",
}
