"""JDBC reads against the database embedded in the session's own JVM: no server, no port."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType

from conftest import rows
from tablesync.operators.predicates import date_window
from tablesync.sources.jdbc import (
    depth_slices,
    jdbc_bounds,
    jdbc_partitioned_scan,
    jdbc_scan,
    jdbc_version_range_scan,
    partition_bounds,
    scalar_version,
    spark_type,
    subquery,
    time_ranges,
    type_override_schema,
    version_slices,
)


@pytest.fixture
def source(spark, derby, table):
    upper = table("orders").toDF(*[c.upper() for c in table("orders").columns])
    upper.write.format("jdbc").options(**derby).option("dbtable", "ORDERS").save()
    return derby


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_are_pushed_down(spark, source):
    df = jdbc_scan(spark, source, "ORDERS").where("O_TOTALPRICE > 1000")
    df = df.where(date_window("O_ORDERDATE", "1996-01-01", "1997-01-01")).select("O_ORDERKEY")
    text = plan(df)
    assert "GreaterThan(O_TOTALPRICE" in text and "GreaterThanOrEqual(O_ORDERDATE" in text
    assert "ReadSchema: struct<O_ORDERKEY:bigint" in text


def test_partitioned_scans(spark, source, table):
    for column, n in (("O_ORDERKEY", 8), ("O_ORDERDATE", 5), ("O_TOTALPRICE", 3)):
        df = jdbc_partitioned_scan(spark, source, "select * from ORDERS", column, n)
        assert df.rdd.getNumPartitions() == n
        assert rows(df) == rows(table("orders"))


def clusters(spark, derby, frame):
    frame.toDF(*[c.upper() for c in frame.columns]).write.format("jdbc").options(**derby).option("dbtable", "C").save()


def sizes(df):
    counts = {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    return [counts.get(p, 0) for p in range(df.rdd.getNumPartitions())]


DISTANT = {
    "bigint": "case when id < 700 then id when id < 990 then 4000000000000 + 3 * id else 9000000000000000 + id end",
    "decimal(20,4)": "case when id < 500 then id / 1000 else 1000000000000 + id end",
    "double": "case when id < 900 then 1e-3 * id else 1e12 * id end",
    "date": "date_add(date'1990-01-01', cast(case when id < 800 then id % 400 else 12000 + id end as int))",
    "timestamp_ntz": "timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(case when id < 700 then 0 else 7000 end, 0, 0, id / 1000)",
}


@pytest.mark.parametrize("kind", DISTANT)
def test_ranges_of_distant_clusters_are_even(spark, derby, kind):
    frame = spark.range(1000).selectExpr("id", f"cast({DISTANT[kind]} as {kind}) as v")
    clusters(spark, derby, frame)
    df = jdbc_partitioned_scan(spark, derby, "select * from C where ID >= 20", "V", 10)
    found = sizes(df)
    assert len(found) == 10 and max(found) <= 2 * 98 and min(found) > 0
    assert sorted(r.ID for r in df.select("ID").collect()) == list(range(20, 1000))
    wide = sizes(jdbc_partitioned_scan(spark, derby, "C", "V", 10, even=False))
    assert max(wide) > 3 * 98


def test_ranges_beside_a_hot_value_and_nulls(spark, derby):
    frame = spark.range(900).selectExpr("id", "case when id < 300 then 77 when id < 600 then null else id end as v")
    clusters(spark, derby, frame)
    df = jdbc_partitioned_scan(spark, derby, "C", "V", 6)
    found = sizes(df)
    assert df.count() == 900 and found.count(300) == 2 and all(n <= 200 for n in found if n != 300)


def test_equal_values_are_one_range(spark, derby):
    clusters(spark, derby, spark.range(20).selectExpr("id", "5 as v"))
    assert sizes(jdbc_partitioned_scan(spark, derby, "C", "V", 4)) == [20]


@pytest.mark.parametrize("edges, rest", [([], [0, 10]), ([1], [0, 10]), ([4, 4, 11, 12], [0, 3, 3, 10]), ([2, 9], [0, 1, 8, 10])])
def test_slices_before_edges_cover_the_range(edges, rest):
    assert [a for a, _ in depth_slices(0, 10, edges)] + [10] == rest


@pytest.mark.parametrize("way", ["relation", "counts"])
def test_version_slices_hold_equally_many_changes(spark, derby, way):
    """Nine tenths of the changes lie in a hundredth of the versions."""
    frame = spark.range(2000).selectExpr("id", "case when id < 1800 then 50001 + id % 1000 else 500 * (id - 1800) + 1 end as v")
    clusters(spark, derby, frame)
    def feed(low, high):
        return f"select * from C where V > {low} and V <= {high}"

    def counts(low, high):
        return f"select V, count(*) as N from C where V > {low} and V <= {high} group by V"

    args = ("C", "V", 100, 99_000, 8) if way == "relation" else (feed, "V", 100, 99_000, 8, counts)
    df = jdbc_version_range_scan(spark, derby, *args)
    expected = rows(frame.where("v > 100 and v <= 99000"))
    found = sizes(df)
    assert rows(df) == expected and len(found) == 8
    assert max(found) <= 2 * len(expected) / 8


def test_empty_source_is_read_over_one_connection(spark, source):
    df = jdbc_partitioned_scan(spark, source, "select * from ORDERS where O_ORDERKEY < 0", "O_ORDERKEY", 8)
    assert df.rdd.getNumPartitions() == 1 and df.count() == 0


def test_bounds_of_an_empty_frame_are_null(table):
    assert tuple(partition_bounds(table("orders").limit(0), "o_orderdate").first()) == (None, None)


def test_bounds_are_computed_by_the_source(spark, source, table):
    expected = partition_bounds(table("orders"), "o_orderdate").first()
    assert jdbc_bounds(spark, source, "ORDERS", "O_ORDERDATE").first() == expected


def test_timestamps_are_wall_clocks(spark, source):
    assert dict(jdbc_scan(spark, source, "ORDERS").dtypes)["O_ORDERDATE"] == "timestamp_ntz"


def test_custom_schema(spark, source):
    df = jdbc_scan(spark, source, "ORDERS", "O_ORDERKEY string")
    assert dict(df.dtypes)["O_ORDERKEY"] == "string"


def test_version_slices():
    assert version_slices(0, 10, 3) == [(0, 3), (3, 6), (6, 10)]
    assert version_slices(5, 5, 4) == [(5, 5)]
    assert version_slices(0, 2, 8) == [(0, 1), (1, 2)]


def test_version_range_scan_is_parallel_and_complete(spark, source, table):
    expected = rows(table("orders").where("o_orderkey > 10 and o_orderkey <= 1000"))
    df = jdbc_version_range_scan(spark, source, "ORDERS", "O_ORDERKEY", 10, 1000, 6)
    assert df.rdd.getNumPartitions() == 6 and rows(df) == expected
    feed = lambda low, high: (
        f"select * from ORDERS where O_ORDERKEY > {low} and O_ORDERKEY <= {high}"
    )
    assert rows(jdbc_version_range_scan(spark, source, feed, "", 10, 1000, 4)) == expected


def test_single_slice_is_spread_afterwards(spark, source):
    df = jdbc_version_range_scan(spark, source, "ORDERS", "O_ORDERKEY", 10, 1000, 1)
    assert "RoundRobinPartitioning(8)" in plan(df) and df.count() == 990


def test_scalar_version(spark, source):
    assert scalar_version(jdbc_scan(spark, source, "select max(O_ORDERKEY) as v from ORDERS")) == 1499
    with pytest.raises(ValueError):
        scalar_version(spark.sql("select cast(null as bigint)"))


def test_subquery_text():
    assert subquery("select 1;") == "(select 1) subq"
    assert subquery("dbo.t") == "dbo.t"


def test_time_ranges_of_one_day():
    assert len(time_ranges("c", "2022-01-01 00:00:00.000", "2022-01-01 00:00:00.000", 4)) == 1


def test_sql_types():
    assert spark_type("FLOAT") == DoubleType() and spark_type("real") == FloatType()
    assert spark_type("DECIMAL(50, 4)") == DecimalType(38, 4)
    assert spark_type("numeric(9)") == DecimalType(9, 0)
    assert spark_type("XML") == StringType()


def test_type_override_schema(spark):
    catalog = spark.createDataFrame(
        [("d", "date"), ("t", "datetime2"), ("n", "int")], "column_name string, data_type string"
    )
    assert rows(type_override_schema(catalog)) == [("d date, t timestamp",)]
    assert rows(type_override_schema(catalog.where("data_type = 'int'"))) == [("",)]


def test_bounds_of_timestamps_are_truncated_to_days(spark):
    df = spark.sql("select timestamp_ntz'2024-02-03 04:05:06.789' as ts")
    assert tuple(partition_bounds(df, "ts").first()) == ("2024-02-03 00:00:00.000",) * 2
    assert dt.datetime.fromisoformat(partition_bounds(df, "ts").first()[0])
    assert df.select(F.col("ts")).count() == 1
