import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablesync.operators.predicates import (
    date_window,
    filter_source,
    in_touched_partitions,
    key_equality,
    merge_condition,
    not_in_touched_partitions,
    replace_scope,
    string_join,
    touched_partitions,
)


@pytest.fixture
def orders(table):
    return table("orders")


@pytest.mark.parametrize("keys", [["c_nationkey"], ["c_nationkey", "c_mktsegment"]])
def test_key_equality_joins_like_a_dictionary(table, keys):
    """Customers joined with themselves on a nullable key: nulls meet nothing."""
    customers = table("customer").withColumn("c_nationkey", F.when(F.col("c_nationkey") % 4 > 0, F.col("c_nationkey")))
    counts = Counter(tuple(r) for r in customers.select(keys).collect() if None not in tuple(r))
    joined = customers.alias("L").join(customers.alias("R"), key_equality(keys, "L", "R"))
    assert joined.count() == sum(n * n for n in counts.values())


def test_key_equality_of_prefixed_sides_and_of_no_keys(table):
    nation = table("nation")
    left, right = (nation.toDF(*[side + c for c in nation.columns]).alias(side) for side in ("new_", "old_"))
    assert left.join(right, key_equality(["n_nationkey"], "new_", "old_", "new_", "old_")).count() == 25
    with pytest.raises(ValueError):
        key_equality([], "L", "R")


def test_touched_partitions_are_the_distinct_values(orders):
    with_null = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    assert {r[0] for r in touched_partitions(with_null, "o_orderstatus").collect()} == {"F", "O", None}
    renamed = touched_partitions(with_null.withColumnRenamed("o_orderstatus", "_pk_s"), "s", "_pk_")
    assert renamed.columns == ["s"] and renamed.count() == 3


def test_touched_partition_values_are_never_text(spark):
    values = [None, "Nullarbor", "O'Brien", "", "007", "7", "-5", "true"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, p string")
    for value in values:
        source = df.where(F.col("p").eqNullSafe(F.lit(value)))
        touched = touched_partitions(source, "p")
        assert [r.p for r in in_touched_partitions(df, touched, "p").collect()] == [value]
        assert not_in_touched_partitions(df, touched, "p").count() == len(values) - 1


@pytest.mark.parametrize("where", ["o_totalprice > 150000", None, "o_orderpriority like '1%' and o_orderkey % 2 = 0"])
def test_scope_and_touched_partitions_both_narrow(orders, where):
    source = orders.where("o_orderkey < 40")
    touched = touched_partitions(source, "o_custkey")
    found = in_touched_partitions(orders.where(replace_scope(where)), touched, "o_custkey")
    customers = {r.o_custkey for r in source.collect()}
    expected = [r for r in orders.where(where or "true").collect() if r.o_custkey in customers]
    assert rows(found) == sorted(map(tuple, expected), key=repr)


def test_scope_takes_the_window_too(orders):
    window = date_window("o_orderdate", "1995-01-01", "1996-01-01")
    inside = orders.where(replace_scope("o_orderstatus = 'F'", window))
    assert 0 < inside.count() == orders.where("year(o_orderdate) = 1995 and o_orderstatus = 'F'").count()
    assert orders.where(replace_scope(None)).count() == orders.count()


def test_scope_with_null_outcome_is_outside(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert rows(df.where(replace_scope("a = 1"))) == [(1,)]
    assert rows(df.where(~replace_scope("a = 1"))) == [(None,)]


@pytest.mark.parametrize("values, keys_met", [(None, 25), ([], 25), ([0, 4], 10), ([17], 0)])
def test_merge_condition_is_narrowed_to_partition_values(table, values, keys_met):
    nation = table("nation")
    changes = nation.select(F.col("n_nationkey").alias("_pk_n_nationkey"), "n_name")
    condition = merge_condition(
        ["n_nationkey"], "c", "t", source_prefix="_pk_", partition_values=values, partition_column="n_regionkey"
    )
    assert changes.alias("c").join(nation.alias("t"), condition).count() == keys_met


def test_date_window_is_half_open(spark):
    df = spark.sql(
        "select explode(sequence(timestamp_ntz'2024-05-02 18:00:00', "
        "timestamp_ntz'2024-06-11 18:00:00', interval 6 hours)) as ts"
    )
    found = df.where(date_window("ts", "2024-05-09", "2024-06-01")).agg(F.min("ts"), F.max("ts")).first()
    assert found[0] == dt.datetime(2024, 5, 9)
    assert found[1] == dt.datetime(2024, 5, 31, 18)
    assert df.where(date_window("ts", "2024-05-09")).count() == 4


def test_date_window_of_instants_uses_the_zone(spark):
    df = spark.sql("select timestamp'2024-05-08 19:45:00Z' as ts")
    assert df.where(date_window("ts", "2024-05-09", timezone="Asia/Tokyo")).count() == 1
    assert df.where(date_window("ts", "2024-05-09", timezone="UTC")).count() == 0


def test_filters_are_optional_and_add_up(orders):
    urgent, early = F.col("o_orderpriority") == "1-URGENT", date_window("o_orderdate", "1995-01-01", "1997-01-01")
    counts = [filter_source(orders, *args).count() for args in ((), (urgent,), (None, early), (urgent, early))]
    assert counts[0] == orders.count() and counts[0] > counts[1] > counts[3] and counts[2] > counts[3] > 0
    assert counts[3] == orders.where(urgent & early).count()


def test_string_join(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "v string")
    assert rows(string_join(df, "v")) == [("a, b",)]
