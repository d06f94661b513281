"""Layouts, merges and reads that must hold when tables are large: one hot key, many files,
long common text starts, parallel reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablesync import SyncSpec, TargetTable, run_sync
from tablesync.operators.changes import snapshot_diff
from tablesync.operators import layout
from tablesync.operators.layout import bits_per_column, zorder
from tablesync.operators.merge import DuplicateKeyError, apply_changes, latest_per_key, upsert
from tablesync.plans.sync import read_source
from tablesync.sinks import catalog
from tablesync.sinks import table as table_module
from tablesync.sinks.files import SharedFiles, new_path
from tablesync.sources.feeds import JdbcChangeSource
from tablesync.sources.jdbc import jdbc_partitioned_scan


def widths(df, column):
    """Number of distinct values of a column in each partition."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.countDistinct(column).alias("n")).collect()]


def test_text_with_a_long_common_start_clusters(spark):
    df = spark.range(4000).select(F.concat(F.lit("https://example.org/items/"), F.lpad("id", 6, "0")).alias("url"))
    found = widths(zorder(df, ["url"], 8), "url")
    assert len(found) == 8 and max(found) < 2 * 4000 / 8


def test_any_number_of_columns_clusters(spark):
    columns = [f"c{i}" for i in range(70)]
    df = spark.range(200).select(*[(F.col("id") * (i + 3) % 17).alias(c) for i, c in enumerate(columns)])
    for n in (11, 70):
        assert rows(zorder(df, columns[:n], 4)) == rows(df)


def test_one_column_in_many_files_stays_near_the_ideal_width(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_000).alias("k"))
    spans = zorder(df, ["k"], 512).groupBy(F.spark_partition_id()).agg((F.max("k") - F.min("k") + 1).alias("w"))
    assert spans.agg(F.avg("w")).first()[0] < 2 * 100_000 / 512
    assert bits_per_column(1, 512) >= 9


def test_every_orderable_type_clusters(spark):
    df = spark.range(300).selectExpr(
        "id", "date_add(date'2024-01-01', cast(id as int)) d", "timestamp_seconds(id) t", "id % 2 = 0 b",
        "cast(cast(id as string) as binary) x", "cast(id as decimal(20, 3)) n", "if(id % 3 = 0, null, cast(id as double)) f",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int)) w",
    )
    assert rows(zorder(df, df.columns[1:], 5)) == rows(df)


@pytest.fixture
def counted(spark, new_dir):
    target = TargetTable(spark, new_dir)
    target.write(spark.range(100).withColumn("v", F.lit(0)))
    return target


def test_readers_find_one_commit_before_every_catalog_statement(spark, counted, monkeypatch):
    catalog.register_table(counted, "scale_db", "numbers", new_path(spark, "db"))
    counted.replace_where(spark.range(50).withColumn("v", F.lit(1)))
    run, seen = spark.sql, []

    def watched(text, *args, **kwargs):
        if "numbers" in text:
            seen.append(tuple(run("select count(*), count(distinct v) from scale_db.numbers").first()))
        return run(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", watched)
    catalog.register_table(counted, "scale_db", "numbers")
    monkeypatch.undo()
    assert set(seen) <= {(100, 1), (50, 1)} and len(seen) > 2
    assert spark.table("scale_db.numbers").count() == 50


def test_registration_that_stops_half_way_leaves_the_view(spark, counted, monkeypatch):
    catalog.register_table(counted, "scale_db", "halves", new_path(spark, "db"))
    counted.replace_where(spark.range(30).withColumn("v", F.lit(1)))
    run = spark.sql

    def stops(text, *args, **kwargs):
        if "REPLACE VIEW" in text:
            raise RuntimeError("stopped")
        return run(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", stops)
    with pytest.raises(RuntimeError):
        catalog.register_table(counted, "scale_db", "halves")
    monkeypatch.undo()
    assert spark.table("scale_db.halves").count() == 100
    catalog.register_table(counted, "scale_db", "halves")
    assert spark.table("scale_db.halves").count() == 30


@pytest.fixture
def source(spark, derby, table):
    upper = table("orders").toDF(*[c.upper() for c in table("orders").columns])
    upper.write.format("jdbc").options(**derby).option("dbtable", "ORDERS").save()
    return derby


@pytest.mark.parametrize("split_by", ["", "O_ORDERKEY"])
@pytest.mark.parametrize(
    "where, same",
    [
        ("MOD(O_ORDERKEY, 2) = 0", "o_orderkey % 2 = 0"),
        ("LOCATE('URG', O_ORDERPRIORITY) > 0 AND {fn LENGTH(O_ORDERSTATUS)} = 1", "o_orderpriority like '%URG%'"),
    ],
)
def test_predicates_are_in_the_source_sql(spark, source, table, split_by, where, same):
    spec = SyncSpec(
        path="/p", table="ORDERS", jdbc=source, query="select * from ORDERS", where=where,
        split_by=split_by, num_partitions=3,
    )
    df = read_source(spark, spec)
    assert rows(df) == rows(table("orders").where(same))
    assert where in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_day_is_read_in_even_ranges(spark, derby):
    day = spark.range(1600).selectExpr("id as ID", "timestamp_ntz'2024-05-31 00:00:00' + make_dt_interval(0, 0, 0, id * 54) as SOLD")
    day.write.format("jdbc").options(**derby).option("dbtable", "SOLDDAY").save()
    df = jdbc_partitioned_scan(spark, derby, "select * from SOLDDAY", "SOLD", 8)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 200 and df.count() == 1600


def test_changes_query_is_asked_once_per_slice(spark, derby):
    log = spark.range(1, 61).selectExpr("id % 20 as ID", "id as VERSION", "if(id % 7 = 0, 'D', 'U') as OP")
    log.write.format("jdbc").options(**derby).option("dbtable", "LOG").option(
        "createTableColumnTypes", "OP varchar(1)"
    ).save()
    settings = dict(
        changes_query=(
            "select ID as V, OP as SYS_CHANGE_OPERATION, ID as SYS_CHANGE_PK_ID, VERSION from LOG "
            "where VERSION > ? and VERSION <= ?"
        ),
        changes_params=["queryCTLastVersion", "queryCTCurrentVersion"],
    )
    whole = JdbcChangeSource(spark, derby, "dbo", "LOG", ["ID"], **settings).changes(40, 60)
    feed = JdbcChangeSource(spark, derby, "dbo", "LOG", ["ID"], num_partitions=5, feed_version="VERSION", **settings)
    assert "LOG" in feed._rendered_changes(1, 2)
    assert rows(feed.changes(40, 60)) == rows(whole.drop("VERSION"))
    assert SyncSpec.from_options({"path_to_save": "/p", "tab": "t", "ct_changes_version": "VERSION"}).changes_version == "VERSION"


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_the_window_is_the_source_day_in_any_session(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.sql(
            "select explode(array(timestamp'2024-05-31 00:30:00Z', timestamp'2024-05-31 23:30:00Z', "
            "timestamp'2024-06-01 00:30:00Z')) as at"
        )
        spec = SyncSpec(path="/p", table="t", window_column="at", exec_date="2024-05-31")
        assert read_source(spark, spec, df).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_repeated_source_keys_raise(spark, table):
    orders = table("orders")
    twice = orders.limit(1).union(orders.limit(1))
    with pytest.raises(DuplicateKeyError):
        upsert(orders, twice, ["o_orderkey"])
    changes = twice.withColumns({"_op": F.lit("U"), "_pk_o_orderkey": F.col("o_orderkey")})
    with pytest.raises(DuplicateKeyError):
        apply_changes(orders, changes, ["o_orderkey"])
    with pytest.raises(DuplicateKeyError):
        snapshot_diff(orders, twice, ["o_orderkey"])


def test_one_key_on_a_third_of_the_target(spark):
    target = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(0).alias("v"))
    source = spark.createDataFrame([(-1, 5), (1, 6), (9999, 7)], "k bigint, v int")
    merged = upsert(target, source, ["k"])
    assert merged.where("v = 5").count() == 1000 and merged.count() == 3001
    assert rows(merged.where("v > 5")) == [(1, 6), (9999, 7)]


def test_latest_per_key_with_maps_ties_and_null_versions(spark):
    df = spark.sql(
        "select * from values (1, 1, map('a', 1)), (1, 2, map('b', 2)), (1, 2, map('b', 1)), (1, 2, map('b', 2)), "
        "(2, null, map('c', 3)), (2, null, map('c', 4)), (null, 7, map('d', 1)) as t(k, v, m)"
    )
    found = latest_per_key(df, ["k"], "v").selectExpr("k", "v", "to_json(m) as m")
    assert rows(found) == rows(spark.sql(
        "select * from values (1, 2, '{\"b\":2}'), (2, null, '{\"c\":4}'), (null, 7, '{\"d\":1}') as t(k, v, m)"
    ))


def test_directories_stay_few_over_many_merges(spark, new_dir):
    target = TargetTable(spark, new_dir)
    base = spark.range(1000).selectExpr("id", "id % 2 as p", "0 as v")
    target.write(base, partition_by=["p"])
    for turn in range(1, 24):
        target.upsert(base.where(f"id = {turn}").withColumn("v", F.lit(turn)).union(
            spark.sql(f"select {1000 + turn}L as id, {turn % 2}L as p, {turn} as v")
        ), ["id"])
    commit = target.ledger.latest()
    assert len(commit.dirs) <= 2 * (table_module.SMALL_SLICES + 2)
    assert target.read().count() == 1023 and target.read().agg(F.sum("v")).first()[0] == 2 * sum(range(1, 24))


def test_a_merge_keeps_the_other_slices_of_a_plain_load(spark, new_dir, monkeypatch):
    monkeypatch.setattr(table_module, "TASKS_PER_SLICE", 1)
    df = spark.range(0, 800, numPartitions=4).withColumn("v", F.lit(0))
    spec = SyncSpec(path=new_dir, table="t", mode="overwrite", ingestion_time=False)
    run_sync(spark, spec, df)
    target = TargetTable(spark, spec.target_path)
    before = set(target.ledger.latest().dirs)
    target.upsert(spark.sql("select 5L as id, 9 as v"), ["id"])
    assert len(before) == 4 and len(before & set(target.ledger.latest().dirs)) == 3


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_merge_opens_only_the_slices_of_its_keys(spark, new_dir, partitioned):
    """The other slices may be absent from storage."""
    target = TargetTable(spark, new_dir)
    base = spark.range(2000).selectExpr("id", "id % 2 as p", "cast(0 as int) as v")
    target.write(base, partition_by=["p"] if partitioned else [], slice_by=["ID"], slices=32)
    commit = target.ledger.latest()
    assert {commit.slice_of(name) for name in commit.dirs} == set(range(32))
    source = spark.sql("select * from values (3, 1, 7), (5, 1, 7), (90000, 0, 7), (null, 0, 8) as t(id, p, v)")
    touched = {r[0] for r in source.select(table_module._slice_number([F.col("id").cast("bigint")], 32)).collect()}
    for name in commit.dirs:
        if commit.slice_of(name) not in touched:
            SharedFiles(spark, f"{target.root}/{name}").delete_root()
    target.upsert(source, ["id"])
    after = target.ledger.latest()
    left = [name for name in after.dirs if after.slice_of(name) in touched]
    assert set(after.dirs) - set(left) == {name for name in commit.dirs if commit.slice_of(name) not in touched}
    found = target._scan(after, left)
    assert rows(found.where("v > 0").select("id", "v")) == sorted([(3, 7), (5, 7), (90000, 7), (None, 8)], key=repr)
    for row in found.withColumn("s", table_module._slice_number([F.col("id")], 32)).select("s").distinct().collect():
        assert row.s in touched


def test_hashed_slices_stay_few_over_many_merges(spark, new_dir):
    spec = SyncSpec(path=new_dir, table="t", use_merge=True, merge_keys="id", key_slices=4, ingestion_time=False)
    for turn in range(14):
        run_sync(spark, spec, spark.range(turn * 5, turn * 5 + 60).withColumn("v", F.lit(turn)))
    target = TargetTable(spark, spec.target_path)
    commit = target.ledger.latest()
    assert commit.slice_by == ["id"] and len(commit.dirs) <= 4 * (table_module.SMALL_SLICES + 1)
    assert target.read().count() == 13 * 5 + 60 and target.read().where("id = 0 and v = 0").count() == 1
    assert target.read().agg(F.sum("v")).first()[0] == sum(min(i // 5, 13) for i in range(125))
    with pytest.raises(ValueError):
        TargetTable(spark, new_dir + "/other").write(spark.range(3), slice_by=["id"])


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(12,2)", "date", "timestamp", "timestamp_ntz", "string", "tinyint"])
def test_cut_points_split_rows_evenly(spark, kind):
    values = {
        "date": "date_add(date'1999-12-25', cast(id % 5000 as int))", "timestamp": "timestamp_micros(id * 1000003)", "string": "lpad(id, 9, '0')",
        "timestamp_ntz": "timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, 0, id / 10)", "tinyint": "id % 100 - 50",
    }
    df = spark.range(20_000).selectExpr(f"cast({values.get(kind, '(id - 9000) * 3 / 2')} as {kind}) as v")
    df = df.union(spark.sql(f"select cast(null as {kind}) from range(10)"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Kiev")
    try:
        cuts = layout._cut_points(df, ["v"], 3)[0]
        counts = {r["z"]: r["count"] for r in layout.with_zvalue(df, ["v"], 3).groupBy(F.col(layout.ZVALUE).alias("z")).count().collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(cuts) == 7 and set(counts) == set(range(8))
    assert all(0.8 * 2500 < n < 1.25 * 2500 for n in counts.values())


def test_cut_points_of_odd_values(spark):
    df = spark.sql("select * from values (double('nan'), 1), (double('inf'), null), (null, null), (double('-inf'), 1), (2.5d, 1) as t(a, b)")
    cuts = layout._cut_points(df, ["a", "b"], 2)
    assert cuts == [["2.5"] * 3, ["1"] * 3]
    assert layout._cut_points(df.where("a = 7"), ["a", "b"], 2) == [[], []]
    assert zorder(df, ["a", "b"], 3).count() == 5


def test_numbers_and_times_take_one_pass_without_lists(spark, table, monkeypatch):
    monkeypatch.setattr(layout, "_sampled_points", lambda *a: (_ for _ in ()).throw(AssertionError("sampled")))
    orders = table("orders")
    assert rows(zorder(orders, ["o_orderdate", "o_totalprice", "o_custkey"], 6)) == rows(orders)


def test_zorder_of_an_unpartitioned_target_leaves_old_files(spark, counted):
    first = counted.ledger.latest()
    counted.write(spark.range(100, 200).withColumn("v", F.lit(1)), "append")
    counted.zorder(["id"], changed_since=first.commit)
    assert set(first.dirs) <= set(counted.ledger.latest().dirs) and counted.read().count() == 200


def test_staging_falls_back_to_the_warehouse(spark, tmp_path):
    own = SharedFiles(spark, f"{tmp_path}/gone")
    own.delete_root_on_exit()
    assert (tmp_path / "gone").is_dir()


def test_a_stream_reads_its_last_batch_from_the_newest_commit(spark, counted):
    changes = spark.sql("select 3L as id, 8 as v, 'U' as _op, 3L as _pk_id")
    counted.apply_changes(changes, ["id"], 1, stream="s", batch=4)
    counted.upsert(spark.sql("select 4L as id, 9 as v"), ["id"])
    assert counted.ledger.latest().streams == {"s": 4}
    assert dt.datetime.fromisoformat(counted.ledger.latest().ts)
