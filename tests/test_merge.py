import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablesync.operators.changes import net_changes, snapshot_diff
from tablesync.operators.merge import (
    DuplicateKeyError,
    ReplaceScopeError,
    apply_changes,
    apply_parent_child_changes,
    latest_per_key,
    replace_where,
    require_unique_keys,
    upsert,
)

SCHEMA = "k int, j int, v int"
CHANGE_SCHEMA = f"{SCHEMA}, _op string, _pk_k int, _pk_j int"


def brute_merge(target, source, keys, op=lambda row: "U"):
    """Row-by-row merge over tuples; key positions in `keys`."""
    key = lambda row: tuple(row[i] for i in keys)
    complete = lambda row: None not in key(row)
    by_key = {key(row): row for row in source if complete(row)}
    merged, matched = [], set()
    for row in target:
        found = by_key.get(key(row)) if complete(row) else None
        if found is None:
            merged.append(row)
            continue
        matched.add(key(row))
        if op(found) != "D":
            merged.append(found)
    for row in source:
        if (not complete(row) or key(row) not in matched) and op(row) in ("I", "U"):
            merged.append(row)
    return sorted(merged, key=repr)


def random_rows(rng, n, unique):
    found = {}
    for i in range(n):
        row = (rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, 1, 2]), i)
        key = row[:2] if unique and None not in row[:2] else (i, "any")
        found[key] = row
    return list(found.values())


@pytest.mark.parametrize("seed", range(4))
def test_upsert_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    target = random_rows(rng, 25, unique=False)
    source = [(k, j, v + 100) for k, j, v in random_rows(rng, 15, unique=True)]
    merged = upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k", "j"]
    )
    assert rows(merged) == brute_merge(target, source, (0, 1))


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
@pytest.mark.parametrize("seed", range(3))
def test_apply_changes_equals_brute_force(spark, seed, broadcast):
    rng = random.Random(seed)
    target = random_rows(rng, 25, unique=False)
    source = [
        (k, j, v + 100, rng.choice("IUD"), k, j) for k, j, v in random_rows(rng, 15, unique=True)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        merged = rows(apply_changes(
            spark.createDataFrame(target, SCHEMA),
            spark.createDataFrame(source, CHANGE_SCHEMA),
            ["k", "j"],
        ))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = brute_merge(target, source, (0, 1), op=lambda row: row[3] if len(row) > 3 else "U")
    assert merged == sorted([row[:3] for row in expected], key=repr)


def test_upsert_never_deletes(spark):
    target = spark.createDataFrame([(1, 1, 1), (2, 2, 2)], SCHEMA)
    assert rows(upsert(target, target.limit(0), ["k"])) == rows(target)


def test_update_of_absent_row_inserts_and_delete_of_absent_row_does_nothing(spark):
    target = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    changes = spark.createDataFrame(
        [(2, 2, 2, "U", 2, 2), (None, None, None, "D", 3, 3)], CHANGE_SCHEMA
    )
    assert rows(apply_changes(target, changes, ["k", "j"])) == [(1, 1, 1), (2, 2, 2)]


def test_matched_row_of_unknown_operation_updates_and_unmatched_is_dropped(spark):
    target = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    changes = spark.createDataFrame([(1, 1, 9, "X", 1, 1), (2, 2, 9, None, 2, 2)], CHANGE_SCHEMA)
    assert rows(apply_changes(target, changes, ["k", "j"])) == [(1, 1, 9)]


def test_duplicate_source_keys_raise_unless_null(spark):
    with pytest.raises(DuplicateKeyError):
        require_unique_keys(spark.createDataFrame([(1, 1, 1), (1, 1, 2)], SCHEMA), ["k", "j"])
    require_unique_keys(spark.createDataFrame([(None, 1, 1), (None, 1, 2)], SCHEMA), ["k", "j"])


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 7), (1, 1, None), (2, 1, 1), (None, 1, 3), (None, 1, 4)], SCHEMA)
    assert rows(latest_per_key(df, ["k", "j"], "v")) == [
        (1, 1, 7), (2, 1, 1), (None, 1, 3), (None, 1, 4),
    ]


def test_parent_child(spark):
    target = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 3), (3, 1, 4)], SCHEMA)
    changes = spark.createDataFrame(
        [
            (None, None, None, "D", 1, None),
            (None, None, None, "D", 1, None),
            (1, 2, 20, "I", 1, 2),
            (2, 1, 30, "U", 2, 1),
            (4, 1, 40, "U", 4, 1),
        ],
        CHANGE_SCHEMA,
    )
    merged = apply_parent_child_changes(target, changes, ["k", "j"], ["k"])
    assert rows(merged) == [(1, 2, 20), (2, 1, 30), (3, 1, 4), (4, 1, 40)]


def test_replace_where_raises_on_rows_outside_the_scope(spark):
    target = spark.createDataFrame([(1, 1, 1)], SCHEMA)
    with pytest.raises(ReplaceScopeError):
        replace_where(target, target, "k = 2")
    with pytest.raises(ReplaceScopeError):
        replace_where(target, spark.createDataFrame([(None, 1, 1)], SCHEMA), "k = 2")


def test_replace_where_keeps_null_outcomes(spark):
    target = spark.createDataFrame([(1, 1, 1), (None, 1, 2), (2, 1, 3)], SCHEMA)
    source = spark.createDataFrame([(1, 9, 9)], SCHEMA)
    assert rows(replace_where(target, source, "k = 1")) == [(1, 9, 9), (2, 1, 3), (None, 1, 2)]


def test_reapplying_a_batch_changes_nothing(spark, table):
    orders = table("orders")
    changes = snapshot_diff(
        orders, orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.lit(1.0)), ["o_orderkey"]
    )
    once = apply_changes(orders, changes, ["o_orderkey"])
    assert rows(apply_changes(once, changes, ["o_orderkey"])) == rows(once)


def test_split_version_ranges_equal_the_whole(spark):
    """Applying (0, 10], (10, 30] in order gives what (0, 30] gives, with the base as of 30."""
    rng = random.Random(5)
    log, state, base = [], {}, {}
    for version in range(1, 31):
        key = rng.randint(1, 8)
        if key in state and rng.random() < 0.4:
            del state[key]
            log.append((key, version, "D"))
        else:
            log.append((key, version, "U" if key in state else "I"))
            state[key] = version
    base = spark.createDataFrame(list(state.items()), "k int, v int")
    log = spark.createDataFrame(log, "k int, version int, op string")

    def step(target, last, current):
        net = net_changes(log, ["k"], "version", "op", last, current)
        changes = net.select(F.col("_op"), F.col("k").alias("_pk_k")).join(
            base, F.col("_pk_k") == F.col("k"), "left"
        )
        return apply_changes(target, changes, ["k"])

    empty = spark.createDataFrame([], "k int, v int")
    whole = step(empty, 0, 30)
    assert rows(whole) == sorted(state.items(), key=repr)
    assert rows(step(step(empty, 0, 10), 10, 30)) == rows(whole)


def test_net_changes_leaves_keys_that_change_again_later(spark):
    log = spark.createDataFrame(
        [(1, 1, "I"), (1, 5, "U"), (2, 2, "I"), (3, 3, "I"), (3, 9, "D")], "k int, version int, op string"
    )
    assert rows(net_changes(log, ["k"], "version", "op", 0, 5)) == [(1, 5, "U"), (2, 2, "I")]
    assert rows(net_changes(log, ["k"], "version", "op", 5, 9)) == [(3, 9, "D")]


def test_snapshot_diff_is_null_safe(spark):
    old = spark.createDataFrame([(1, None, 1), (2, 1, None), (3, 3, 3)], SCHEMA)
    new = spark.createDataFrame([(1, None, 1), (2, 1, 2), (4, 4, 4)], SCHEMA)
    found = snapshot_diff(old, new, ["k"])
    assert rows(found.select("_op", "_pk_k")) == [("D", 3), ("I", 4), ("U", 2)]
    assert rows(apply_changes(old, found, ["k"])) == rows(new)


def test_snapshot_diff_compares_values_of_every_type(spark):
    """One key per pair of values: alike ones are no change, others are."""
    alike = [
        "0.0d, -0.0d", "double('nan'), double('nan')", "cast(null as int), cast(null as int)", "x'00ff', x'00FF'", "1.50bd, 1.50bd",
        "array(1, null), array(1, null)", "timestamp'2020-10-25 00:30:00Z', timestamp'2020-10-25 03:30:00+03:00'", "map('a', 1), map('a', 1)",
        "named_struct('a', null, 'b', 'x'), named_struct('a', null, 'b', 'x')",
    ]
    other = [
        "1, null", "'', null", "'-', null", "'1:', '1'", "array(1, null), array(null, 1)", "timestamp'2020-10-25 00:30:00Z', timestamp'2020-10-25 01:30:00Z'",
        "timestamp'2020-01-01 00:00:00.000001Z', timestamp'2020-01-01 00:00:00.000002Z'", "array(timestamp'2020-01-01 00:00:00.000001Z'), array(timestamp'2020-01-01 00:00:00Z')",
        "named_struct('a', null, 'b', 'x'), named_struct('a', 'x', 'b', null)", "x'', x'00'", "date'0001-01-01', date'0001-01-02'", "true, false",
    ]
    for pairs, changes in ((alike, 0), (other, 1)):
        for pair in pairs:
            sides = spark.sql(f"select 1 as k, a, b from (select stack(1, {pair}) as (a, b))")
            old, new = sides.select("k", F.col("a").alias("v")), sides.select("k", F.col("b").alias("v"))
            assert snapshot_diff(old, new, ["k"]).count() == changes, pair


def test_snapshot_diff_of_shifted_columns_and_types(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "ab", "c"), (3, "x", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(None, "a", 1), ("bc", "a", 2), ("y", "x", 3)], "q string, p string, k bigint")
    found = snapshot_diff(old, new, ["K"])
    assert found.columns == ["q", "p", "k", "_op", "_pk_k"] and rows(found) == [("bc", "a", 2, "U", 2)]


def test_snapshot_diff_lists_rows_without_key_apart(spark):
    old = spark.createDataFrame([(None, 1, 1), (1, 1, 1)], SCHEMA)
    new = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (1, 1, 2)], SCHEMA)
    found = snapshot_diff(old, new, ["k"])
    assert rows(found) == sorted([
        (None, None, None, "D", None), (None, 1, 1, "I", None), (None, 2, 2, "I", None),
        (1, 1, 2, "U", 1),
    ], key=repr)


def test_hot_key_and_null_keys_keep_every_row(spark):
    """A third of the target on one key, a third without key: merged like any other."""
    target = spark.range(9000).selectExpr(
        "case id % 3 when 0 then 7 when 1 then null else cast(id as int) end as k",
        "1 as j", "cast(id as int) as v",
    )
    source = spark.createDataFrame([(7, 2, 0), (None, 2, 0), (2, 2, 0)], SCHEMA)
    merged = upsert(target, source, ["k"])
    counts = {tuple(r)[:2]: r.n for r in merged.groupBy("k", "j").agg(F.count("*").alias("n")).where("n > 1 or j = 2").collect()}
    assert counts == {(7, 2): 3000, (None, 1): 3000, (None, 2): 1, (2, 2): 1}
