"""Queries that write target tables and read them back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.predicates import date_window
from tablesync.plans.spec import SyncSpec
from tablesync.plans.sync import run_sync
from tablesync.sinks.catalog import register_table, set_retention
from tablesync.sinks.files import new_path
from tablesync.sinks.table import TargetTable
from tablesync.sources.feeds import LogChangeSource
from tablesync.streaming.batches import apply_change_stream
from tablesync_checks.data import (
    LINE_KEY,
    NEW_ORDERS_SQL,
    ORDER_COLUMNS,
    line_changes,
    new_database,
    new_orders,
    new_table,
    orders_changes,
    plain_times,
    read,
)
from tablesync_checks.merging import APPLIED_SQL, LINES_SQL, merged_sql


def _write_modes(spark, sf):
    """Created, appended to, then partly overwritten."""
    customer = read(spark, sf, "customer")
    table = new_table(spark)
    table.write(customer)
    table.write(customer, "ignore")
    table.write(customer.withColumn("c_custkey", -1 - F.col("c_custkey")), "append")
    replaced = customer.where("c_acctbal < 0").withColumn("c_acctbal", F.col("c_acctbal") - 1)
    table.write(replaced, "overwrite", scope="c_acctbal < 0")
    return table.read()


def _partitioned_overwrite(spark, sf):
    """Only partitions that occur in the source are replaced, and only within the window."""
    orders = read(spark, sf, "orders")
    table = new_table(spark)
    table.write(orders, partition_by=["o_orderstatus", "o_orderpriority"])
    window = date_window("o_orderdate", "1997-01-01", "1999-01-01")
    source = orders.where(window).where("o_orderpriority > '2' and o_orderstatus <> 'P'")
    table.write(source.withColumn("o_totalprice", F.col("o_totalprice") + 1), "overwrite", scope=window)
    return table.read()


def _target_after_commits(spark, sf):
    table = new_table(spark)
    table.write(read(spark, sf, "orders"), partition_by=["o_orderpriority"], version=1)
    table.apply_changes(orders_changes(spark, sf), ["o_orderkey"], version=2)
    return table.read()


def _unpartitioned_target(spark, sf):
    table = new_table(spark)
    table.write(read(spark, sf, "orders"), version=1)
    table.apply_changes(orders_changes(spark, sf), ["o_orderkey"], version=2)
    return table.read()


def _key_sliced_target(spark, sf):
    """An unpartitioned table in slices by key; each merge opens only those it touches."""
    table = new_table(spark)
    table.write(read(spark, sf, "orders"), version=1, slice_by=["o_orderkey"], slices=16)
    table.apply_changes(orders_changes(spark, sf), ["o_orderkey"], version=2)
    return table.read()


def moved_orders(spark, sf) -> DataFrame:
    """All but the low-priority orders, finished: their partition changes."""
    moved = read(spark, sf, "orders").where("o_orderpriority <> '5-LOW'")
    return moved.withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1})


def _upsert_partition_move(spark, sf):
    table = new_table(spark)
    table.upsert(read(spark, sf, "orders"), ["o_orderkey"], ["o_orderstatus"])
    table.upsert(moved_orders(spark, sf), ["o_orderkey"])
    return table.read()


def _apply_changes_partition_move(spark, sf):
    table = new_table(spark)
    table.write(read(spark, sf, "orders"), partition_by=["o_orderstatus"])
    changes = moved_orders(spark, sf).select(
        "*", F.lit("U").alias("_op"), F.col("o_orderkey").alias("_pk_o_orderkey")
    )
    table.apply_changes(changes, ["o_orderkey"], version=1)
    return table.read()


def _parent_child_table(spark, sf):
    table = new_table(spark)
    table.write(read(spark, sf, "lineitem"), partition_by=["l_returnflag"], version=1)
    table.apply_parent_child_changes(line_changes(spark, sf), LINE_KEY, ["l_orderkey"], version=2)
    return table.read()


def _zorder(spark, sf):
    table = new_table(spark)
    table.write(read(spark, sf, "lineitem"), partition_by=["l_linestatus"])
    table.zorder(["l_partkey", "l_shipdate", "l_returnflag"], num_files=8)
    return table.read()


def _registered_table(spark, sf):
    orders = read(spark, sf, "orders")
    table = new_table(spark)
    table.write(orders, partition_by=["o_orderpriority"])
    database = new_database()
    register_table(table, database, "orders", new_path(spark, "database"))
    table.upsert(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    register_table(table, database, "orders")
    set_retention(table, database, "orders", "interval 3 days", "interval 2 days")
    return spark.table(f"{database}.orders")


@dataclass
class _Delivered:
    """A change source whose change rows are a given frame."""

    base: DataFrame
    rows: DataFrame
    version: int

    def current_version(self) -> int:
        return self.version

    def min_valid_version(self) -> int:
        return 0

    def snapshot(self) -> DataFrame:
        return self.base

    def changes(self, last: int, current: int) -> DataFrame:
        return self.rows


def _status_log(spark, sf) -> DataFrame:
    """Which orders differ between the two states of `new_orders`, and when that happened."""
    orders = read(spark, sf, "orders")
    gone_or_dearer = orders.where("o_orderstatus <> 'P'").select(
        "o_orderkey",
        (F.col("o_orderkey") + 1).alias("version"),
        F.when(F.col("o_orderstatus") == "F", "D").otherwise("U").alias("op"),
    )
    added = orders.where("o_orderpriority = '5-LOW'").select(
        F.expr("-1 - o_orderkey").alias("o_orderkey"),
        (F.col("o_orderkey") + 1).alias("version"),
        F.lit("I").alias("op"),
    )
    return gone_or_dearer.unionByName(added)


def _incremental_sync(spark, sf):
    """Full load, then the changes of a log in two capped runs."""
    log = _status_log(spark, sf)
    top = log.agg(F.max("version")).first()[0]
    spec = SyncSpec(
        path=new_path(spark, "sync"), table="Orders", schema="dbo", change_tracking=True,
        primary_key="[o_orderkey]", write_partitioned=True, partition_by=["o_orderpriority"],
        timezone="Europe/Kiev", ingestion_time=False, ct_window=top // 2 + 1,
    )
    before = _Delivered(read(spark, sf, "orders"), log, 0)
    run_sync(spark, spec, before)
    later = LogChangeSource(new_orders(spark, sf), _with_start(log), ["o_orderkey"], "version", "op")
    run_sync(spark, spec, later)
    run_sync(spark, spec, later)
    return plain_times(TargetTable(spark, spec.target_path).read())


def _with_start(log: DataFrame) -> DataFrame:
    """The log with its versions known to be complete from 0 on."""
    return log.unionByName(
        log.agg(F.min("version").alias("version")).select(
            F.lit(None).cast("long").alias("o_orderkey"), F.lit(1).cast("long").alias("version"),
            F.lit("D").alias("op"),
        )
    )


def _upsert_sync(spark, sf):
    """Two upsert runs with a window, a generated partition column and clustering."""
    spec = SyncSpec(
        path=new_path(spark, "sync"), table="Orders", use_merge=True, merge_keys="o_orderkey",
        window_column="o_orderdate", window_start="1996-01-01", window_end="2000-01-01",
        write_partitioned=True, partition_by=["order_year"], generated_name="order_year",
        generated_expression="year(o_orderdate)", generated_type="int", timezone="UTC",
        ingestion_time=False, zorder_by="o_custkey, o_orderdate",
    )
    orders = read(spark, sf, "orders")
    run_sync(spark, spec, orders, stage_source=False)
    dearer = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    run_sync(spark, spec, dearer)
    return plain_times(TargetTable(spark, spec.target_path).read())


def _parent_child_sync(spark, sf):
    spec = SyncSpec(
        path=new_path(spark, "sync"), table="Lines", custom_ct=True, primary_key=LINE_KEY,
        parent_key="l_orderkey", timezone="UTC", ingestion_time=False,
    )
    lines = read(spark, sf, "lineitem")
    run_sync(spark, spec, _Delivered(lines, lines, 1))
    run_sync(spark, spec, _Delivered(lines, line_changes(spark, sf), 2))
    return plain_times(TargetTable(spark, spec.target_path).read())


def _change_stream(spark, sf):
    """The customer of each order, as of its latest order, kept by a stream of orders."""
    schema = read(spark, sf, "orders").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    table = new_table(spark)
    table.write(read(spark, sf, "customer").select("c_custkey", F.lit(None).cast("double").alias("last_price")))
    changes = arriving.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("last_price"),
        F.when(F.col("o_orderstatus") == "F", "D").otherwise("U").alias("_op"),
        F.col("o_custkey").alias("_pk_c_custkey"),
        F.col("o_orderkey").alias("version"),
    )
    query = apply_change_stream(
        changes, table, ["c_custkey"], "version", f"orders-{new_database()}", new_path(spark, "stream")
    )
    query.awaitTermination()
    return table.read()


QUERIES = {
    "write_modes": _write_modes,
    "partitioned_overwrite": _partitioned_overwrite,
    "target_after_commits": _target_after_commits,
    "unpartitioned_target": _unpartitioned_target,
    "key_sliced_target": _key_sliced_target,
    "upsert_partition_move": _upsert_partition_move,
    "apply_changes_partition_move": _apply_changes_partition_move,
    "parent_child_table": _parent_child_table,
    "zorder": _zorder,
    "registered_table": _registered_table,
    "incremental_sync": _incremental_sync,
    "upsert_sync": _upsert_sync,
    "parent_child_sync": _parent_child_sync,
    "change_stream": _change_stream,
}

_MOVED_SQL = merged_sql(
    ORDER_COLUMNS,
    "select * from orders",
    """select * replace ('F' as o_orderstatus, o_totalprice + 1 as o_totalprice)
       from orders where o_orderpriority <> '5-LOW'""",
    ["o_orderkey"],
)

ORACLE = {
    "write_modes": """
        with both_signs as (select * from customer
                            union all select * replace (-1 - c_custkey as c_custkey) from customer)
        select * from both_signs where not (c_acctbal < 0)
        union all select * replace (c_acctbal - 1 as c_acctbal) from customer where c_acctbal < 0""",
    "partitioned_overwrite": """
        with s as (select * replace (o_totalprice + 1 as o_totalprice) from orders
                   where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1999-01-01'
                     and o_orderpriority > '2' and o_orderstatus <> 'P')
        select * from orders
        where not (o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1999-01-01'
                   and o_orderpriority in (select o_orderpriority from s))
        union all select * from s""",
    "target_after_commits": APPLIED_SQL,
    "unpartitioned_target": APPLIED_SQL,
    "key_sliced_target": APPLIED_SQL,
    "upsert_partition_move": _MOVED_SQL,
    "apply_changes_partition_move": _MOVED_SQL,
    "parent_child_table": LINES_SQL,
    "zorder": "select * from lineitem",
    "registered_table": "select * replace (o_totalprice + 1 as o_totalprice) from orders",
    "incremental_sync": f"""
        select * replace ((o_orderdate at time zone 'Europe/Kiev') at time zone 'UTC' as o_orderdate)
        from ({NEW_ORDERS_SQL}) n""",
    "upsert_sync": """
        select * replace (case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice),
               cast(year(o_orderdate) as integer) as order_year
        from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '2000-01-01'""",
    "parent_child_sync": LINES_SQL,
    "change_stream": """
        with latest as (select * from (
                select o_custkey, o_totalprice, o_orderstatus,
                       row_number() over (partition by o_custkey order by o_orderkey desc) as n
                from orders) x where n = 1)
        select c_custkey, cast(null as double) as last_price from customer
        where c_custkey not in (select o_custkey from latest)
        union all
        select o_custkey, o_totalprice from latest where o_orderstatus <> 'F'""",
}
