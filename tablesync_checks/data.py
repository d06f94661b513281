"""Change sets, logs and catalogs that the queries derive from whole tables, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sinks.files import new_path
from tablesync.sinks.table import TargetTable
from tablesync.functions.timestamps import utc_wall_clock

ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_table(spark: SparkSession) -> TargetTable:
    """A target table that exists nowhere yet, in the cluster's shared folder."""
    return TargetTable(spark, new_path(spark, "table"))


def new_database() -> str:
    return f"checks_{uuid.uuid4().hex}"


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clocks, the form in which results are compared."""
    return df.select(
        *[
            utc_wall_clock(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
    )


# A change set over all orders: status F deletes, O updates, P inserts. Keys of P rows and of
# low-priority rows do not exist in the target, so absent deletes and absent updates occur too.
_CHANGED_KEY = "case when o_orderstatus = 'P' or o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end"
_CHANGE_OP = "case o_orderstatus when 'F' then 'D' when 'O' then 'U' else 'I' end"

ORDERS_CHANGES_SQL = f"""
    select {_CHANGED_KEY} as pk, {_CHANGE_OP} as op, o_custkey, o_orderstatus,
           o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
    from orders"""


def orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows for `orders`; base columns of deletes are NULL, as a feed delivers them."""
    marked = read(spark, sf_dir, "orders").select(
        F.expr(_CHANGED_KEY).alias("_pk_o_orderkey"),
        F.expr(_CHANGE_OP).alias("_op"),
        "*",
        (F.col("o_totalprice") + 1).alias("new_price"),
    )
    values = {name: F.col(name) for name in ORDER_COLUMNS}
    values["o_orderkey"] = F.col("_pk_o_orderkey")
    values["o_totalprice"] = F.col("new_price")
    present = F.col("_op") != "D"
    return marked.select(
        *[F.when(present, values[name]).alias(name) for name in ORDER_COLUMNS],
        "_op",
        "_pk_o_orderkey",
    )


# A later state of all orders: F orders gone, O orders dearer, P orders as they were, and a
# new order next to each low-priority one.
NEW_ORDERS_SQL = """
    select o_orderkey, o_custkey, o_orderstatus,
           case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end as o_totalprice,
           o_orderdate, o_orderpriority
    from orders where o_orderstatus <> 'F'
    union all
    select -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderpriority = '5-LOW'"""


def new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    price = F.expr("case when o_orderstatus = 'O' then o_totalprice + 1 else o_totalprice end")
    later = orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", price)
    added = orders.where("o_orderpriority = '5-LOW'").withColumn("o_orderkey", F.expr("-1 - o_orderkey"))
    return later.unionByName(added)


# A change log for customers: every order is a change of its customer, in order of order key.
# Low-priority orders speak of customers that do not exist.
_LOG_KEY = "case when o_orderpriority = '5-LOW' then -1 - o_custkey else o_custkey end"

CUSTOMER_LOG_SQL = f"""
    select {_LOG_KEY} as c_custkey, o_orderkey as version, {_CHANGE_OP} as op from orders"""


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.expr(_LOG_KEY).alias("c_custkey"),
        F.col("o_orderkey").alias("version"),
        F.expr(_CHANGE_OP).alias("op"),
    )


# One ledger per user: each event is a commit, with its version as JSON, as a bare number,
# empty or missing.
LEDGER_SQL = """
    select user_id, event_id as "commit",
           case event_type when 'error' then 'OPTIMIZE' when 'view' then 'WRITE' else 'MERGE' end as op,
           case event_type
                when 'purchase' then '{"ChangeTrackingVersion":' || cast(event_id as varchar) || '}'
                when 'click' then cast(event_id as varchar)
                when 'view' then '' end as user_metadata,
           ts
    from events"""


def ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    number = F.col("event_id").cast("string")
    return read(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_id").alias("commit"),
        F.when(kind == "error", "OPTIMIZE").when(kind == "view", "WRITE").otherwise("MERGE").alias("op"),
        F.when(kind == "purchase", F.concat(F.lit('{"ChangeTrackingVersion":'), number, F.lit("}")))
        .when(kind == "click", number)
        .when(kind == "view", "")
        .alias("user_metadata"),
        "ts",
    )


# A parent/child feed for order lines: F orders that are not urgent lose all lines; returned
# lines come again with a new price; accepted lines come once more under a new part.
LINE_WRITES_SQL = """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
           l_extendedprice + 1 as l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           l_shipdate
    from lineitem where l_returnflag = 'R'
    union all
    select l_orderkey, -1 - l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
    from lineitem where l_returnflag = 'A'"""
DELETED_PARENTS_SQL = """
    select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'"""


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    updated = lines.where("l_returnflag = 'R'").withColumn(
        "l_extendedprice", F.col("l_extendedprice") + 1
    ).withColumn("_op", F.lit("U"))
    inserted = lines.where("l_returnflag = 'A'").withColumn(
        "l_partkey", F.expr("-1 - l_partkey")
    ).withColumn("_op", F.lit("I"))
    writes = updated.unionByName(inserted).select(
        "*", *[F.col(key).alias(f"_pk_{key}") for key in LINE_KEY]
    )
    gone = (
        read(spark, sf_dir, "orders")
        .where("o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'")
        .select(F.col("o_orderkey").alias("_pk_l_orderkey"), F.lit("D").alias("_op"))
    )
    return writes.unionByName(gone, allowMissingColumns=True)
