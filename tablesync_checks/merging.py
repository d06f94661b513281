"""Merges, replacements and change rows as pure frame operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators.changes import (
    capped_current_version,
    change_counts,
    change_feed,
    cursor_is_valid,
    net_changes,
    snapshot_diff,
    source_versions,
)
from tablesync.operators.merge import (
    apply_changes,
    apply_parent_child_changes,
    duplicate_keys,
    latest_per_key,
    replace_where,
    upsert,
)
from tablesync.operators.predicates import date_window, key_equality, merge_condition
from tablesync.sinks.ledger import (
    expirable_dirs,
    expired_commits,
    last_synced_version,
    latest_sync_commit,
)
from tablesync.sources.jdbc import scalar_version, version_range_scan
from tablesync_checks.data import (
    CUSTOMER_LOG_SQL,
    DELETED_PARENTS_SQL,
    LEDGER_SQL,
    LINE_COLUMNS,
    LINE_KEY,
    LINE_WRITES_SQL,
    NEW_ORDERS_SQL,
    ORDER_COLUMNS,
    ORDERS_CHANGES_SQL,
    customer_log,
    ledgers,
    line_changes,
    new_orders,
    orders_changes,
    read,
)

# A later version of every order: half of the statuses keep their key, P orders get a new one.
_UPSERT_KEY = "case when o_orderstatus = 'P' then -1 - o_orderkey else o_orderkey end"
_UPSERT_SQL = f"""
    select {_UPSERT_KEY} as o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 as o_totalprice,
           o_orderdate, o_orderpriority
    from orders where o_orderpriority <> '1-URGENT'"""


def upsert_source(spark, sf):
    return (
        read(spark, sf, "orders")
        .where("o_orderpriority <> '1-URGENT'")
        .withColumn("o_orderkey", F.expr(_UPSERT_KEY))
        .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    )


def merged_sql(columns, target, source, key, drop="false"):
    """Full outer join form of a merge, for the SQL side."""
    picked = ", ".join(f"case when s.in_s then s.{c} else t.{c} end as {c}" for c in columns)
    on = " and ".join(f"t.{k} = s.{k}" for k in key)
    return (
        f"select {picked} from ({target}) t full outer join "
        f"(select *, true as in_s from ({source}) q) s on {on} where not ({drop})"
    )


def _upsert(spark, sf):
    return upsert(read(spark, sf, "orders"), upsert_source(spark, sf), ["o_orderkey"])


def _upsert_unique_target(spark, sf):
    return upsert(
        read(spark, sf, "orders"), upsert_source(spark, sf), ["o_orderkey"], target_keys_unique=True
    )


def _null_key_customer(spark, sf):
    """Customers of one segment have no key."""
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    return read(spark, sf, "customer").withColumn("c_custkey", key)


def _upsert_null_keys(spark, sf):
    customer = _null_key_customer(spark, sf)
    return upsert(customer, customer.withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])


def _upsert_repeated_target_keys(spark, sf):
    """One source row per order replaces each of the order's lines."""
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    heads = read(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.lit(0).alias("l_linenumber"),
        F.col("o_totalprice").alias("l_quantity"),
    )
    return upsert(lines, heads, ["l_orderkey"])


def _upsert_composite_key(spark, sf):
    """Threads get a remark on every turn of the assistant, and a closing turn."""
    turns = read(spark, sf, "conversations")
    remarked = turns.where("role = 'assistant'").withColumn("text", F.concat("text", F.lit(" *")))
    closing = turns.where("turn = 0").withColumns({"turn": F.lit(-1).cast("long"), "role": F.lit("end")})
    return upsert(turns, remarked.unionByName(closing), ["conv_id", "turn"])


def _upsert_documents(spark, sf):
    """Labelled documents come again with their whole text and a new source."""
    labels = read(spark, sf, "labels").select("doc_id", "toxic")
    documents = read(spark, sf, "documents")
    labelled = documents.join(labels, "doc_id").select(
        F.when(F.col("toxic") == 1, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"),
        "text", "lang", F.lit("labelled").alias("source"), "n_chars",
    )
    return upsert(documents, labelled, ["doc_id"])


def _upsert_source_partitions_only(spark, sf):
    """The older prune rule: orders whose status changed stay behind next to their new version."""
    moved = read(spark, sf, "orders").where("o_orderpriority <> '5-LOW' and o_orderstatus <> 'O'")
    moved = moved.withColumn("o_orderstatus", F.lit("P"))
    return upsert(read(spark, sf, "orders"), moved, ["o_orderkey"], source_partitions_only="o_orderstatus")


def _apply_changes(spark, sf):
    return apply_changes(read(spark, sf, "orders"), orders_changes(spark, sf), ["o_orderkey"])


def _parent_child_changes(spark, sf):
    return apply_parent_child_changes(
        read(spark, sf, "lineitem"), line_changes(spark, sf), LINE_KEY, ["l_orderkey"]
    )


def _thread_changes(spark, sf):
    """Threads with a system turn are deleted as a whole; their user turns come back."""
    turns = read(spark, sf, "conversations")
    gone = turns.where("role = 'system'").select(
        F.col("conv_id").alias("_pk_conv_id"), F.lit("D").alias("_op")
    )
    back = turns.where("role = 'user'").select(
        "*", F.col("conv_id").alias("_pk_conv_id"), F.col("turn").alias("_pk_turn"),
        F.lit("U").alias("_op"),
    )
    changes = back.unionByName(gone, allowMissingColumns=True)
    return apply_parent_child_changes(turns, changes, ["conv_id", "turn"], ["conv_id"])


def _replace_where(spark, sf):
    scope = date_window("o_orderdate", "1997-01-01", "1998-01-01")
    source = read(spark, sf, "orders").where(scope).where("o_orderpriority <> '5-LOW'")
    source = source.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return replace_where(read(spark, sf, "orders"), source, scope)


def _replace_touched_partitions(spark, sf):
    source = read(spark, sf, "orders").where("o_orderpriority < '4' and o_orderstatus = 'O'")
    return replace_where(read(spark, sf, "orders"), source, "o_totalprice > 1000", "o_orderpriority", check=False)


def _duplicate_keys(spark, sf):
    found = duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return found.withColumnRenamed("count", "n_rows")


def _latest_per_key(spark, sf):
    return latest_per_key(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def _cut(spark, sf):
    """Versions of a run over the log of orders: all from the start up to three quarters."""
    row = source_versions(read(spark, sf, "orders"), "o_orderkey").first()
    low, high = row["min_valid_version"], row["current_version"]
    return low, high - (high - low) // 4


def _scalar_version(spark, sf):
    """Rows after the middle version, which comes from the source's first row and column."""
    orders = read(spark, sf, "orders")
    middle = scalar_version(orders.select(F.expr("(max(o_orderkey) + min(o_orderkey)) div 2")))
    return version_range_scan(orders, "o_orderkey", middle, scalar_version(orders.select(F.max("o_orderkey"))))


def _key_equality(spark, sf):
    """Lines whose supplier has the number of the order's customer."""
    lines = read(spark, sf, "lineitem").selectExpr("l_orderkey as id", "l_linenumber", "l_suppkey as other")
    orders = read(spark, sf, "orders").selectExpr("o_orderkey as id", "o_custkey as other")
    joined = lines.alias("L").join(orders.alias("O"), key_equality(["id", "other"], "L", "O"))
    return joined.select(F.col("L.id").alias("id"), F.col("L.l_linenumber").alias("line"), F.col("O.other").alias("other"))


def _merge_condition(spark, sf):
    """Changed orders matched with their targets in the partitions of two statuses."""
    changes = orders_changes(spark, sf).alias("source")
    target = read(spark, sf, "orders").alias("target")
    condition = merge_condition(
        ["o_orderkey"], source_prefix="_pk_", partition_values=["F", "O"], partition_column="o_orderstatus"
    )
    return changes.join(target, condition).select(
        F.col("source._pk_o_orderkey").alias("pk"), F.col("source._op").alias("op"), F.col("target.o_totalprice").alias("old_price")
    )


def _net_changes(spark, sf):
    last, current = _cut(spark, sf)
    log = read(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.col("o_orderkey").alias("version"),
        F.expr("case o_orderstatus when 'F' then 'D' when 'O' then 'U' else 'I' end").alias("op"),
    )
    return net_changes(log, ["o_custkey", "o_orderpriority"], "version", "op", last, current)


def _change_feed(spark, sf):
    last, current = _cut(spark, sf)
    net = net_changes(customer_log(spark, sf), ["c_custkey"], "version", "op", last, current)
    return change_feed(read(spark, sf, "customer"), net, ["c_custkey"])


def _change_counts(spark, sf):
    return change_counts(orders_changes(spark, sf))


def _source_versions(spark, sf):
    return source_versions(read(spark, sf, "events"), "event_id", ["user_id"])


def _capped_current_version(spark, sf):
    versions = source_versions(read(spark, sf, "events"), "event_id", ["user_id"])
    capped = capped_current_version(F.col("current_version"), F.col("min_valid_version"), 5000)
    return versions.select("user_id", capped.alias("current_version"))


def _commit_history(spark, sf):
    return latest_sync_commit(ledgers(spark, sf), ["user_id"])


def _last_synced_version(spark, sf):
    latest = latest_sync_commit(ledgers(spark, sf), ["user_id"]).select("user_id", "version")
    valid = source_versions(read(spark, sf, "events"), "event_id", ["user_id"])
    joined = latest.join(valid, "user_id")
    return joined.select(
        "user_id", last_synced_version(joined, F.col("min_valid_version")).alias("last_version")
    )


def _cursor_validity(spark, sf):
    """Which targets a source that has forgotten the older half of its versions can still serve."""
    latest = latest_sync_commit(ledgers(spark, sf), ["user_id"])
    versions = source_versions(read(spark, sf, "events"), "event_id").first()
    oldest = F.lit((versions["min_valid_version"] + versions["current_version"]) // 2)
    valid = cursor_is_valid(last_synced_version(latest, oldest), oldest)
    return latest.select("user_id", valid.alias("is_valid"))


def _expire_snapshots(spark, sf):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return expired_commits(ledgers(spark, sf), now, "interval 7 days", ["user_id"])


def _expirable_dirs(spark, sf):
    """Each commit lists two directories; users who share a value list the same one again."""
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    events = read(spark, sf, "events").select("event_id", F.floor("value").alias("slot"))
    listed = ledgers(spark, sf).join(events, F.col("commit") == F.col("event_id")).withColumn(
        "dirs", F.array(F.concat(F.lit("own="), "commit"), F.concat(F.lit("slot="), "slot"))
    )
    return expirable_dirs(listed, now, "7 days", ["user_id"])


def _snapshot_diff(spark, sf):
    return snapshot_diff(read(spark, sf, "orders"), new_orders(spark, sf), ["o_orderkey"])


def _snapshot_round_trip(spark, sf):
    """Applying the difference of two states to the first gives the second."""
    orders = read(spark, sf, "orders")
    return apply_changes(orders, snapshot_diff(orders, new_orders(spark, sf), ["o_orderkey"]), ["o_orderkey"])


QUERIES = {
    "upsert": _upsert,
    "upsert_unique_target": _upsert_unique_target,
    "upsert_null_keys": _upsert_null_keys,
    "upsert_repeated_target_keys": _upsert_repeated_target_keys,
    "upsert_composite_key": _upsert_composite_key,
    "upsert_documents": _upsert_documents,
    "upsert_source_partitions_only": _upsert_source_partitions_only,
    "apply_changes": _apply_changes,
    "parent_child_changes": _parent_child_changes,
    "thread_changes": _thread_changes,
    "replace_where": _replace_where,
    "replace_touched_partitions": _replace_touched_partitions,
    "duplicate_keys": _duplicate_keys,
    "latest_per_key": _latest_per_key,
    "scalar_version": _scalar_version,
    "key_equality": _key_equality,
    "merge_condition": _merge_condition,
    "net_changes": _net_changes,
    "change_feed": _change_feed,
    "change_counts": _change_counts,
    "source_versions": _source_versions,
    "capped_current_version": _capped_current_version,
    "commit_history": _commit_history,
    "last_synced_version": _last_synced_version,
    "cursor_validity": _cursor_validity,
    "expire_snapshots": _expire_snapshots,
    "expirable_dirs": _expirable_dirs,
    "snapshot_diff": _snapshot_diff,
    "snapshot_round_trip": _snapshot_round_trip,
}

APPLIED_SQL = merged_sql(
    ORDER_COLUMNS,
    "select * from orders",
    f"select pk as o_orderkey, * exclude (pk) from ({ORDERS_CHANGES_SQL}) c",
    ["o_orderkey"],
    "s.in_s is not null and s.op = 'D'",
)
UPSERTED_SQL = merged_sql(ORDER_COLUMNS, "select * from orders", _UPSERT_SQL, ["o_orderkey"])
LINES_SQL = merged_sql(
    LINE_COLUMNS,
    f"select * from lineitem where l_orderkey not in ({DELETED_PARENTS_SQL})",
    LINE_WRITES_SQL,
    LINE_KEY,
)
_CUT_SQL = "(select max(o_orderkey) - (max(o_orderkey) - min(o_orderkey) + 1) // 4 from orders)"
_SEGMENT_KEY = "case when c_mktsegment <> 'BUILDING' then c_custkey end"
_LATEST_COMMIT_SQL = f"""
    select user_id, "commit", op, user_metadata,
           case when regexp_full_match(user_metadata, '[0-9]+') then try_cast(user_metadata as bigint)
                when user_metadata like '{{%' then try_cast(json_extract_string(user_metadata, '$.ChangeTrackingVersion') as bigint)
           end as version
    from (select *, row_number() over (partition by user_id order by "commit" desc) as n
          from ({LEDGER_SQL}) l where op <> 'OPTIMIZE') x where n = 1"""

ORACLE = {
    "upsert": UPSERTED_SQL,
    "upsert_unique_target": UPSERTED_SQL,
    "upsert_null_keys": merged_sql(
        ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        f"select * replace ({_SEGMENT_KEY} as c_custkey) from customer",
        f"select * replace ({_SEGMENT_KEY} as c_custkey, c_acctbal + 1 as c_acctbal) from customer",
        ["c_custkey"],
    ),
    "upsert_repeated_target_keys": merged_sql(
        ["l_orderkey", "l_linenumber", "l_quantity"],
        "select l_orderkey, l_linenumber, l_quantity from lineitem",
        """select o_orderkey as l_orderkey, 0 as l_linenumber, o_totalprice as l_quantity
           from orders where o_orderstatus <> 'F'""",
        ["l_orderkey"],
    ),
    "upsert_composite_key": merged_sql(
        ["conv_id", "turn", "role", "text"],
        "select * from conversations",
        """select conv_id, turn, role, text || ' *' as text from conversations where role = 'assistant'
           union all select conv_id, -1, 'end', text from conversations where turn = 0""",
        ["conv_id", "turn"],
    ),
    "upsert_documents": merged_sql(
        ["doc_id", "text", "lang", "source", "n_chars"],
        "select * from documents",
        """select case when toxic = 1 then -1 - d.doc_id else d.doc_id end as doc_id, text, lang,
                  'labelled' as source, n_chars
           from documents d join labels l on d.doc_id = l.doc_id""",
        ["doc_id"],
    ),
    "upsert_source_partitions_only": """
        with s as (select * replace ('P' as o_orderstatus) from orders
                   where o_orderpriority <> '5-LOW' and o_orderstatus <> 'O')
        select * from orders o
        where not (o_orderstatus = 'P' and exists (select 1 from s where s.o_orderkey = o.o_orderkey))
        union all select * from s""",
    "apply_changes": APPLIED_SQL,
    "parent_child_changes": LINES_SQL,
    "thread_changes": merged_sql(
        ["conv_id", "turn", "role", "text"],
        """select * from conversations
           where conv_id not in (select conv_id from conversations where role = 'system')""",
        "select * from conversations where role = 'user'",
        ["conv_id", "turn"],
    ),
    "replace_where": """
        select * from orders
        where not (o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01')
        union all
        select * replace (o_totalprice + 1 as o_totalprice) from orders
        where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01'
          and o_orderpriority <> '5-LOW'""",
    "replace_touched_partitions": """
        with s as (select * from orders where o_orderpriority < '4' and o_orderstatus = 'O')
        select * from orders
        where not (o_totalprice > 1000 and o_orderpriority in (select o_orderpriority from s))
        union all select * from s""",
    "duplicate_keys": """
        select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "scalar_version": """
        select * from orders where o_orderkey > (select (max(o_orderkey) + min(o_orderkey)) // 2 from orders)""",
    "key_equality": """
        select l_orderkey as id, l_linenumber as line, o_custkey as other
        from lineitem join orders on l_orderkey = o_orderkey and l_suppkey = o_custkey""",
    "merge_condition": f"""
        select c.pk, c.op, t.o_totalprice as old_price
        from ({ORDERS_CHANGES_SQL}) c join orders t on c.pk = t.o_orderkey where t.o_orderstatus in ('F', 'O')""",
    "latest_per_key": """
        select * exclude (n) from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
                         l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
                         l_linestatus desc) as n
            from lineitem) x where n = 1""",
    "net_changes": f"""
        select o_custkey, o_orderpriority, version, op as _op from (
            select o_custkey, o_orderpriority, o_orderkey as version,
                   case o_orderstatus when 'F' then 'D' when 'O' then 'U' else 'I' end as op,
                   row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey desc) as n
            from orders) x
        where n = 1 and version <= {_CUT_SQL}""",
    "change_feed": f"""
        with net as (
            select * from (select *, row_number() over (partition by c_custkey order by version desc) as n
                           from ({CUSTOMER_LOG_SQL}) l) x
            where n = 1 and version <= {_CUT_SQL})
        select b.*, net.op as _op, net.c_custkey as _pk_c_custkey
        from customer b right outer join net on b.c_custkey = net.c_custkey""",
    "change_counts": f"select op as _op, count(*) as n_changes from ({ORDERS_CHANGES_SQL}) c group by op",
    "source_versions": """
        select user_id, max(event_id) as current_version, min(event_id) - 1 as min_valid_version
        from events group by user_id""",
    "capped_current_version": """
        select user_id, least(max(event_id), min(event_id) - 1 + 5000) as current_version
        from events group by user_id""",
    "commit_history": _LATEST_COMMIT_SQL,
    "last_synced_version": f"""
        select h.user_id, coalesce(h.version, v.low) as last_version
        from ({_LATEST_COMMIT_SQL}) h
        join (select user_id, min(event_id) - 1 as low from events group by user_id) v on h.user_id = v.user_id""",
    "cursor_validity": f"""
        with o as (select (min(event_id) - 1 + max(event_id)) // 2 as oldest from events)
        select user_id, coalesce(h.version, o.oldest) >= o.oldest as is_valid
        from ({_LATEST_COMMIT_SQL}) h, o""",
    "expire_snapshots": f"""
        with l as ({LEDGER_SQL})
        select * from l where ts < timestamp '2024-01-13 00:00:00'
          and "commit" <> (select max("commit") from l m where m.user_id = l.user_id)""",
    "expirable_dirs": f"""
        with l as (
            select a.*, unnest(['own=' || a."commit", 'slot=' || cast(floor(e.value) as bigint)]) as dir
            from ({LEDGER_SQL}) a join events e on a."commit" = e.event_id),
        last as (select user_id, max(event_id) as top from events group by user_id)
        select l.user_id, dir from l join last on l.user_id = last.user_id
        group by l.user_id, dir
        having bool_and(ts < timestamp '2024-01-13 00:00:00' and "commit" <> top)""",
    "snapshot_diff": f"""
        with n as ({NEW_ORDERS_SQL})
        select n.*, case when n.o_orderkey is null then 'D' when o.o_orderkey is null then 'I' else 'U' end as _op,
               coalesce(n.o_orderkey, o.o_orderkey) as _pk_o_orderkey
        from orders o full outer join n on o.o_orderkey = n.o_orderkey
        where n.o_orderkey is null or o.o_orderkey is null or n.o_totalprice <> o.o_totalprice""",
    "snapshot_round_trip": NEW_ORDERS_SQL,
}
