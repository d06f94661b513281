import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablesync.functions.names import target_name
from tablesync.operators import predicates
from tablesync.operators.merge import DuplicateKeyError, ReplaceScopeError, measure_keys, upsert
from tablesync.operators.schema import SchemaMismatchError
from tablesync.sinks import catalog
from tablesync.sinks import files as files_module
from tablesync.sinks import table as table_module
from tablesync.sinks.files import CommitProtocolError, SharedFiles
from tablesync.sinks.ledger import (
    OPTIMIZE,
    ConcurrentCommitError,
    expirable_dirs,
    expired_commits,
    latest_sync_commit,
)
from tablesync.sinks.table import TableExistsError, TargetTable

SCHEMA = "k int, p string, v int"


@pytest.fixture
def target(spark, new_dir):
    return TargetTable(spark, new_dir)


@pytest.fixture
def filled(spark, target):
    df = spark.createDataFrame([(i, "abc"[i % 3], i) for i in range(12)], SCHEMA)
    target.write(df, partition_by=["p"], version=1)
    return target


def change(spark, *found):
    return spark.createDataFrame([(*r, r[0]) for r in found], f"{SCHEMA}, _op string, _pk_k int")


def partition_dirs(commit, value):
    return {d for d in commit.dirs if f"/p={value}/" in f"{d}/"}


def test_write_modes(spark, target):
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    assert not target.exists()
    target.write(df)
    with pytest.raises(TableExistsError):
        target.write(df)
    assert target.write(df, "ignore") is None
    target.write(df, "append")
    assert rows(target.read()) == [(1, "a", 1), (1, "a", 1)]
    target.write(df.withColumn("v", F.lit(2)), "overwrite")
    assert rows(target.read()) == [(1, "a", 2)]
    with pytest.raises(ValueError):
        target.write(df, "upsert")


def test_schema_check_goes_by_names_and_case(spark, filled):
    for columns in (["k", "p", "V"], ["k", "p", "v", "w"], ["k", "p"]):
        names = ", ".join(f"{c} {'string' if c == 'p' else 'int'}" for c in columns)
        df = spark.createDataFrame([], names)
        with pytest.raises(SchemaMismatchError):
            filled.write(df, "append")
    filled.write(spark.createDataFrame([("x", 5, 12)], "p string, v bigint, k int"), "append")
    assert filled.read().where("k = 12").first()["v"] == 5


def test_odd_partition_values_survive_every_step(spark, target):
    values = [None, "Nullarbor", "O'Brien", "", "007", "-5", "true", "a b%c/d=e", "x{y,z}*?", "é:ü"]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], SCHEMA)
    expected = sorted([(i, v or None, i + 1) for i, v in enumerate(values)], key=repr)
    target.write(df, partition_by=["p"])
    target.upsert(df.withColumn("v", F.col("v") + 1), ["k"])
    assert rows(target.read()) == expected
    again = TargetTable(spark, target.root)
    again.write(again.read(), "overwrite")
    assert rows(again.read()) == expected
    again.zorder(["k"])
    assert rows(again.read()) == expected
    assert catalog.register_table(again, "odd_values", "t")
    assert rows(spark.table("odd_values.t")) == expected


def test_names_of_keys_and_partitions_match_in_any_case(spark, target):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "Id int, P string, v int")
    target.write(df, partition_by=["p"])
    target.upsert(df.withColumn("v", F.col("v") + 1), ["ID"])
    changes = df.selectExpr("Id", "P", "v", "'D' as _op", "Id as _pk_iD").where("Id = 1")
    target.apply_changes(changes, ["id"], 2)
    target.zorder(["V"])
    assert target.ledger.latest().partition_by == ["P"]
    assert rows(target.read()) == [(2, "b", 3)]
    with pytest.raises(ValueError):
        target.upsert(df, ["key"])


def test_two_partition_columns_with_odd_names(spark, target):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 2)], "k int, `p*=%` string, q int")
    target.write(df, partition_by=["p*=%", "q"])
    target.upsert(df.where("k = 2"), ["k"])
    assert rows(target.read()) == rows(df)
    catalog.register_table(target, "odd_names", "t")
    assert rows(spark.table("odd_names.t")) == rows(df)


def test_only_touched_directories_are_rewritten(spark, filled):
    before = filled.ledger.latest()
    after = filled.apply_changes(change(spark, (0, "a", 100, "U"), (99, "b", 9, "I")), ["k"], 2)
    assert partition_dirs(before, "c") == partition_dirs(after, "c")
    assert partition_dirs(before, "b") < partition_dirs(after, "b")
    assert not partition_dirs(before, "a") & partition_dirs(after, "a")
    assert after.changes == {"I": 1, "U": 1, "D": 0}
    assert filled.cursor() == 2


def test_a_change_of_few_rows_rewrites_one_slice_of_a_hot_partition(spark, target, monkeypatch):
    monkeypatch.setattr(table_module, "TASKS_PER_SLICE", 1)
    target.write(spark.range(0, 8000, 1, 8).selectExpr("cast(id as int) as k", "'a' as p", "1 as v"))
    before = target.ledger.latest()
    assert len(before.dirs) == 8
    after = target.apply_changes(change(spark, (1234, "a", 9, "U")), ["k"], 2)
    assert len(set(before.dirs) & set(after.dirs)) == 7
    assert rows(target.read().where("v = 9")) == [(1234, "a", 9)]
    assert target.read().count() == 8000
    catalog.register_table(target, "slice_db", "t")
    assert spark.table("slice_db.t").where("v = 9").count() == 1
    assert spark.table("slice_db.t").count() == 8000


def test_tables_without_slices(spark, target):
    df = spark.createDataFrame([(i, "abc"[i % 3], i) for i in range(12)], SCHEMA)
    target.write(df, partition_by=["p"], sliced=False)
    assert all(d.count("/") == 1 for d in target.ledger.latest().dirs)
    target.apply_changes(change(spark, (1, "b", 100, "U"), (2, None, None, "D")), ["k"], 2)
    target.write(df.where("p = 'a'"), "overwrite")
    target.zorder(["k"], changed_since=1)
    assert target.read().count() == 11 and target.read().where("v = 100").count() == 1


def test_columns_of_the_layout_are_refused(spark, target):
    with pytest.raises(ValueError):
        target.write(spark.createDataFrame([(1, 2)], "k int, _slice int"))


def test_row_whose_partition_moves_appears_once(spark, filled):
    filled.apply_changes(change(spark, (0, "c", 0, "U")), ["k"], 2)
    assert rows(filled.read().where("k = 0")) == [(0, "c", 0)]


def test_older_prune_rule_leaves_the_moved_row_behind(spark, filled):
    filled.apply_changes(change(spark, (0, "c", 0, "U")), ["k"], 2, source_partitions_only=True)
    assert rows(filled.read().where("k = 0")) == [(0, "a", 0), (0, "c", 0)]


def test_merge_by_a_key_with_the_partition_column(spark, filled):
    filled.write(spark.createDataFrame([(0, None, 5)], SCHEMA), "append")
    source = spark.createDataFrame([(0, "a", 50), (0, "b", 51), (0, None, 52)], SCHEMA)
    before = filled.ledger.latest()
    after = filled.upsert(source, ["k", "p"])
    assert partition_dirs(before, "c") == partition_dirs(after, "c")
    assert rows(filled.read().where("k = 0")) == [
        (0, "a", 50), (0, "b", 51), (0, None, 5), (0, None, 52),
    ]


def test_older_prune_rule_with_null_partitions(spark, target):
    target.write(spark.createDataFrame([(0, None, 0), (1, "a", 1), (2, "O'B", 2)], SCHEMA), partition_by=["p"])
    source = spark.createDataFrame([(0, None, 9), (1, None, 9), (2, "O'B", 9)], SCHEMA)
    target.upsert(source, ["k"], source_partitions_only=True)
    assert rows(target.read()) == [(0, None, 9), (1, "a", 1), (1, None, 9), (2, "O'B", 9)]


def test_partition_that_becomes_empty_disappears(spark, filled):
    gone = [(i, None, None, "D") for i in range(0, 12, 3)]
    commit = filled.apply_changes(change(spark, *gone), ["k"], 2)
    assert not partition_dirs(commit, "a")
    assert filled.read().where("p = 'a'").count() == 0
    everything = filled.read().select("k", "p", "v", F.lit("D").alias("_op"), F.col("k").alias("_pk_k"))
    filled.apply_changes(everything, ["k"], 3)
    assert filled.read().count() == 0 and filled.read().columns == ["k", "p", "v"]
    filled.apply_changes(change(spark, (1, "z", 1, "I")), ["k"], 4)
    assert rows(filled.read()) == [(1, "z", 1)]


def test_duplicate_source_keys_raise_before_anything_is_written(spark, filled):
    with pytest.raises(DuplicateKeyError):
        filled.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 1)], SCHEMA), ["k"])
    assert filled.ledger.latest().commit == 0


def test_shuffled_merge_equals_broadcast_merge(spark, filled, monkeypatch):
    monkeypatch.setattr(predicates, "BROADCAST_BYTES", -1)
    source = spark.createDataFrame([(i, "abc"[i % 3], -i) for i in range(6, 18)], SCHEMA)
    filled.upsert(source, ["k"])
    expected = [(i, "abc"[i % 3], i if i < 6 else -i) for i in range(18)]
    assert rows(filled.read()) == sorted(expected, key=repr)


def test_keys_of_another_type_are_not_bounded_as_text(spark, filled):
    source = spark.createDataFrame([("9", "a", -9), ("10", "b", -10)], "k string, p string, v int")
    filled.upsert(source, ["k"])
    assert rows(filled.read().where("v < 0")) == [(10, "b", -10), (9, "a", -9)]
    assert filled.read().count() == 12


def test_repeated_target_keys_are_all_updated(spark, target):
    target.write(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], SCHEMA), partition_by=["p"])
    target.upsert(spark.createDataFrame([(1, "c", 9)], SCHEMA), ["k"])
    assert rows(target.read()) == [(1, "c", 9), (1, "c", 9), (2, "a", 3)]


def test_empty_change_batch_moves_the_cursor_only(spark, filled):
    before = filled.ledger.latest()
    after = filled.apply_changes(change(spark, (1, "a", 1, "U")).limit(0), ["k"], 7)
    assert after.dirs == before.dirs and filled.cursor() == 7
    after = filled.apply_parent_child_changes(
        change(spark, (1, "a", 1, "U")).limit(0), ["k"], ["k"], 8
    )
    assert after.dirs == before.dirs and filled.cursor() == 8


def test_overwrite_replaces_only_partitions_of_the_source(spark, filled):
    filled.write(spark.createDataFrame([(50, "a", 0)], SCHEMA), "overwrite")
    assert rows(filled.read().where("p = 'a'")) == [(50, "a", 0)]
    assert filled.read().count() == 9


def test_scoped_overwrite(spark, filled):
    source = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], SCHEMA)
    filled.write(source, "overwrite", scope="k < 5")
    assert rows(filled.read().where("k < 6")) == [
        (0, "a", 1), (1, "b", 2), (2, "c", 2), (5, "c", 5),
    ]
    with pytest.raises(ReplaceScopeError):
        filled.write(source, "overwrite", scope="k < 1")


def test_crash_before_the_ledger_leaves_the_table_alone(spark, filled, monkeypatch):
    before = rows(filled.read())
    monkeypatch.setattr(type(filled.ledger), "append", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        filled.apply_changes(change(spark, (0, "a", 100, "U")), ["k"], 2)
    monkeypatch.undo()
    assert rows(filled.read()) == before and filled.cursor() == 1
    filled.apply_changes(change(spark, (0, "a", 100, "U")), ["k"], 2)
    assert rows(filled.read().where("k = 0")) == [(0, "a", 100)]


def test_crash_between_the_two_commits_of_a_parent_child_run(spark, filled, monkeypatch):
    changes = spark.createDataFrame(
        [(None, None, None, "D", None, "a"), (3, "a", 33, "I", 3, "a"), (1, "b", 11, "U", 1, "b")],
        f"{SCHEMA}, _op string, _pk_k int, _pk_p string",
    )
    merge = TargetTable._write_merge
    monkeypatch.setattr(TargetTable, "_write_merge", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        filled.apply_parent_child_changes(changes, ["k"], ["p"], 5, 1)
    assert filled.cursor() == 1
    assert filled.read().where("p = 'a'").count() == 0
    monkeypatch.setattr(TargetTable, "_write_merge", merge)
    filled.apply_parent_child_changes(changes, ["k"], ["p"], 5, 1)
    assert filled.cursor() == 5
    assert rows(filled.read().where("k in (0, 1, 3)")) == [(1, "b", 11), (3, "a", 33)]


def test_second_writer_of_the_same_commit_fails(spark, filled):
    stale = filled.ledger.next(filled.ledger.latest(), op="WRITE")
    filled.write(spark.createDataFrame([(77, "a", 7)], SCHEMA), "append")
    with pytest.raises(ConcurrentCommitError):
        filled.ledger.append(stale)
    assert filled.read().where("k = 77").count() == 1


@pytest.fixture
def no_rename(spark, monkeypatch):
    """Storage whose files cannot be renamed, as an object store's."""
    def refuse(*args):
        raise OSError("renamed")

    monkeypatch.setattr(SharedFiles, "_rename_if_absent", refuse)
    monkeypatch.setattr(files_module, "ATOMIC_RENAME", set())
    yield monkeypatch
    spark.conf.unset(files_module.COMMIT_SETTING)


def test_storage_without_a_safe_protocol_is_refused(spark, filled, no_rename):
    before = rows(filled.read())
    with pytest.raises(CommitProtocolError, match="file"):
        filled.write(spark.createDataFrame([(77, "a", 7)], SCHEMA), "append")
    assert rows(filled.read()) == before
    spark.conf.set(files_module.COMMIT_SETTING, "copy")
    with pytest.raises(ValueError):
        filled.write(spark.createDataFrame([(77, "a", 7)], SCHEMA), "append")


@pytest.mark.parametrize("how", ["setting", "scheme"])
def test_commits_by_conditional_creation(spark, filled, no_rename, how):
    if how == "setting":
        spark.conf.set(files_module.COMMIT_SETTING, "create")
    else:
        no_rename.setattr(files_module, "CONDITIONAL_CREATE", {"file"})
    stale = filled.ledger.next(filled.ledger.latest(), op="WRITE", dirs=[])
    filled.write(spark.createDataFrame([(77, "a", 7)], SCHEMA), "append")
    with pytest.raises(ConcurrentCommitError):
        filled.ledger.append(stale)
    assert filled.read().where("k = 77").count() == 1
    assert not [n for n in filled.ledger.files.names(filled.ledger.directory) if n.endswith(".tmp")]
    filled.apply_changes(change(spark, (77, "a", 8, "U")), ["k"], 9)
    assert rows(filled.read().where("k = 77")) == [(77, "a", 8)] and filled.cursor() == 9


def test_a_store_that_fails_otherwise_is_no_second_writer(filled, no_rename, spark, monkeypatch):
    spark.conf.set(files_module.COMMIT_SETTING, "create")
    last = filled.ledger.latest()
    monkeypatch.setattr(SharedFiles, "_conditional", lambda self: (_ for _ in ()).throw(OSError("store is down")))
    with pytest.raises(OSError, match="down"):
        filled.ledger.append(filled.ledger.next(last, op="WRITE"))
    assert filled.ledger.latest().commit == last.commit


def test_the_default_protocol_goes_by_the_storage(spark, filled):
    assert filled.ledger.files.commit_protocol() == "rename"


def test_readers_keep_the_commit_they_started_from(spark, filled):
    held = filled.read()
    filled.write(spark.createDataFrame([(77, "a", 7)], SCHEMA), "overwrite")
    assert held.count() == 12


def test_optimize_does_not_hide_the_cursor(filled):
    filled.zorder(["k"])
    assert filled.ledger.latest().op == OPTIMIZE
    assert filled.cursor() == 1
    newest = latest_sync_commit(filled.history()).first()
    assert (newest["commit"], newest["version"]) == (0, 1)


def test_zorder_of_the_partitions_written_since(spark, filled):
    filled.apply_changes(change(spark, (0, "a", 100, "U")), ["k"], 2)
    before = filled.ledger.latest()
    after = filled.zorder(["k", "v"], changed_since=0)
    assert partition_dirs(before, "b") == partition_dirs(after, "b")
    assert partition_dirs(before, "a") != partition_dirs(after, "a")
    assert filled.zorder(["k"], changed_since=after.commit) is None


def test_zorder_narrows_files_on_every_column(spark, table, target):
    lines = table("lineitem").orderBy(F.xxhash64(*table("lineitem").columns))
    target.write(lines.repartition(8))

    def spread(column):
        located = target.read().groupBy(F.input_file_name()).agg(
            (F.max(column) - F.min(column)).alias("width")
        )
        return located.agg(F.avg("width")).first()[0]

    before = spread("l_partkey"), spread("l_suppkey")
    target.zorder(["l_partkey", "l_suppkey"], num_files=8)
    after = spread("l_partkey"), spread("l_suppkey")
    assert after[0] < before[0] * 0.75 and after[1] < before[1] * 0.75
    assert rows(target.read()) == rows(table("lineitem"))


def test_zorder_spreads_a_hot_value_over_files(spark, target):
    target.write(spark.range(30000).selectExpr("if(id % 3 = 0, 5, id) as k", "1 as j"))
    target.zorder(["k", "j"], num_files=6)
    sizes = [r["count"] for r in target.read().groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30000 and max(sizes) < 30000 / 6 * 2


def test_registration_follows_the_commits(spark, filled):
    name = target_name("dbo", "Filled")
    missing = TargetTable(spark, filled.root + "-missing")
    assert not catalog.register_table(missing, "reg_db", "nothing")
    for _ in range(2):
        assert catalog.register_table(filled, "reg_db", name)
        assert rows(spark.table(f"reg_db.{name}")) == rows(filled.read())
    filled.apply_changes(change(spark, (0, None, None, "D"), (50, "z", 1, "I")), ["k"], 2)
    catalog.register_table(filled, "reg_db", name)
    assert rows(spark.table(f"reg_db.{name}")) == rows(filled.read())


def test_registration_of_an_unpartitioned_target(spark, target):
    target.write(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    catalog.register_table(target, "reg_db", "flat")
    target.write(spark.createDataFrame([(2, "b", 2)], SCHEMA), "append")
    catalog.register_table(target, "reg_db", "flat")
    assert rows(spark.table("reg_db.flat")) == [(1, "a", 1), (2, "b", 2)]


def test_retention_is_altered_only_if_it_differs_and_keeps_the_cursor(spark, filled):
    catalog.register_table(filled, "ret_db", "t")
    assert catalog.set_retention(filled, "ret_db", "t")
    assert not catalog.set_retention(filled, "ret_db", "t")
    assert catalog.set_retention(filled, "ret_db", "t", log="interval 3 days")
    assert filled.cursor() == 1
    assert filled.ledger.latest().retention["log"] == "interval 3 days"


def test_expired_commits_and_their_directories(spark, filled):
    for version in (2, 3):
        filled.apply_changes(change(spark, (0, "a", version, "U")), ["k"], version)
    history = filled.history()
    later = F.current_timestamp() + F.expr("interval 8 days")
    assert rows(expired_commits(history, later, "7 days").select("commit")) == [(0,), (1,)]
    assert expired_commits(history, F.current_timestamp(), "interval 7 days").count() == 0
    live = set(filled.ledger.latest().dirs)
    dirs = {r["dir"] for r in expirable_dirs(history, later, "7 days").collect()}
    everything = {d for r in history.collect() for d in r["dirs"]}
    assert dirs == everything - live


def test_ledger_file_holds_one_commit(filled):
    text = filled.ledger.files.read_text(f"{filled.ledger.directory}/{0:020d}.json")
    content = json.loads(text)
    assert content["user_metadata"] == '{"ChangeTrackingVersion":1}'
    assert dt.datetime.fromisoformat(content["ts"]).tzinfo is not None


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, -1])
def test_rows_moved_by_the_first_commit_are_found_by_the_second(spark, new_dir, monkeypatch, limit):
    """Deletes and writes fall into the same directories, slices of odd and null partitions among them."""
    monkeypatch.setattr(predicates, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(table_module, "TASKS_PER_SLICE", 1)
    target = TargetTable(spark, new_dir)
    odd = ["a b", "é%/2", None, "x=y"]
    lines = [(k, k // 2, odd[k % 4], k) for k in range(40)]
    schema = "k int, parent int, p string, v int"
    target.write(spark.createDataFrame(lines, schema).repartition(3), partition_by=["p"], version=1)
    gone = [(None, None, None, None, "D", None, n) for n in (0, 1, 1, 5)]
    new = [(k, 0 if k < 2 else k // 2, odd[k % 4], -k, "U", k, None) for k in (1, 4, 5, 23, 30, 41)]
    changes = spark.createDataFrame(gone + new, f"{schema}, _op string, _pk_k int, _pk_parent int")
    target.apply_parent_child_changes(changes, ["k"], ["parent"], 2)
    kept = {k: (k, parent, p, v) for k, parent, p, v in lines if parent not in (0, 1, 5)}
    assert rows(target.read()) == rows_of(kept | {row[0]: row[:4] for row in new})


def rows_of(by_key):
    return sorted(by_key.values(), key=repr)


def test_many_written_keys_are_not_looked_for_twice(spark, target, monkeypatch):
    monkeypatch.setattr(predicates, "BROADCAST_BYTES", -1)
    target.write(spark.range(40).selectExpr("cast(id as int) k", "cast(id % 5 as int) parent", "1 v"), version=1)
    schema = "k int, parent int, v int, _op string, _pk_k int, _pk_parent int"
    changes = spark.createDataFrame([(None, None, None, "D", None, 0), (1, 1, 2, "U", 1, None)], schema)
    monkeypatch.setattr(table_module, "_matched_rows", lambda *a: pytest.fail("looked for again"))
    target.apply_parent_child_changes(changes, ["k"], ["parent"], 2)
    assert target.read().count() == 32 and rows(target.read().where("v = 2")) == [(1, 1, 2)]


def test_directories_go_through_joins_as_numbers(spark, filled):
    commit = filled.ledger.latest()
    located = filled._scan(commit, None, with_dir=True)
    assert located.schema["_dir"].dataType.typeName() == "long"
    assert filled._collect_dirs(located.where("p = 'b'"), commit) == partition_dirs(commit, "b")
    assert filled._collect_dirs(located, commit) == set(commit.dirs)


def test_sizes_of_values_take_no_texts_of_numbers(spark):
    source = spark.sql("select id k, cast(id as double) x, timestamp_micros(id) t, 'abc' s from range(10)")
    facts = measure_keys(source, ["k"])
    assert (facts.key_bytes, facts.row_bytes) == (10 * 24, 10 * (3 * 24 + 19))


def test_clustered_files_are_bounded_by_their_rows_in_memory(spark, target, monkeypatch):
    """20,000 equal rows are a tiny file, but 48 bytes each for the task that sorts them."""
    monkeypatch.setattr(table_module, "SORTED_BYTES", 240_000)
    target.write(spark.range(20000).selectExpr("1 k", "2 j"))
    target.zorder(["k", "j"])
    sizes = [r["count"] for r in target.read().groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 4 and max(sizes) < 10000


LINES = "k int, parent int, p string, v int"


def line_changes(spark, gone, new):
    """D rows of parents, and U rows by key."""
    deleted = [(None, None, None, None, "D", None, n) for n in gone]
    written = [(*row, "U", row[0], None) for row in new]
    return spark.createDataFrame(deleted + written, f"{LINES}, _op string, _pk_k int, _pk_parent int")


@pytest.fixture
def in_passes(monkeypatch):
    """Small limits: nothing may be sent whole, and shuffled rows take as many passes as there may be."""
    monkeypatch.setattr(predicates, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(table_module, "PASS_BYTES", 1)
    monkeypatch.setattr(table_module, "PLACE_BYTES", 1)
    return monkeypatch


@pytest.mark.parametrize("parent_key", [["parent"], ["k"], ["parent", "k"]])
def test_parent_child_changes_in_passes_over_parts_of_the_keys(spark, new_dir, in_passes, parent_key):
    """Keys that repeat or are null among rows of all passes, in both commits."""
    target = TargetTable(spark, new_dir)
    lines = [(k, None if k % 7 == 0 else k // 3, "ab"[k % 2], k) for k in range(60)] + [(None, 4, "a", -9), (8, 50, "b", 8)]
    target.write(spark.createDataFrame(lines, LINES).repartition(3), partition_by=["p"], version=1)
    new = [(k, 900 + k % 3, "abc"[k % 3], -k) for k in range(50, 90)] + [(8, 8, "a", -8), (None, 1, "a", -1), (None, 1, "a", -1)]
    changes = line_changes(spark, [0, 3, 3, 5, None, 17], new).withColumn(
        "_pk_k", F.when(F.col("_op") == "D", F.col("_pk_parent") * 3).otherwise(F.col("_pk_k"))
    )
    puts, plain = [], TargetTable._put
    in_passes.setattr(TargetTable, "_put", lambda self, df, *a, **k: puts.append(df) or plain(self, df, *a, **k))
    target.apply_parent_child_changes(changes, ["k"], parent_key, 2)
    assert len(puts) >= 2 * table_module.MAX_PASSES
    if parent_key == ["parent"]:
        left = [r for r in lines if r[1] not in (0, 3, 5, 17)]
    elif parent_key == ["k"]:
        left = [r for r in lines if r[0] not in (0, 9, 15, 51)]
    else:
        left = [r for r in lines if (r[1], r[0]) not in ((3, 9), (5, 15), (17, 51), (0, 0))]
    by_key = {r[0]: r for r in new if r[0] is not None}
    known = {r[0] for r in left}
    merged = [by_key.get(r[0], r) for r in left] + [r for r in new if r[0] is None or r[0] not in known]
    assert rows(target.read()) == sorted(merged, key=repr)


def test_keys_too_many_to_be_sent_at_once_are_sent_in_passes(spark, new_dir, in_passes):
    """Parts of the parents' keys go to all tasks, so the rows that stay are not shuffled."""
    target = TargetTable(spark, new_dir)
    target.write(spark.range(400).selectExpr("cast(id as int) k", "cast(id % 80 as int) parent", "'a' p", "1 v"), version=1)
    in_passes.setattr(predicates, "BROADCAST_BYTES", 400)  # of 60 keys of 24 bytes
    gathered, plain = [], TargetTable._put
    in_passes.setattr(
        TargetTable, "_put", lambda self, df, before, redistribute: gathered.append(redistribute) or plain(self, df, before, redistribute)
    )
    in_passes.setattr(TargetTable, "_compact", lambda *a: None)
    target.apply_parent_child_changes(line_changes(spark, range(60), []), ["k"], ["parent"], 2)
    assert gathered == [False] * 5
    assert rows(target.read().select("k")) == [(k,) for k in sorted((k for k in range(400) if k % 80 >= 60), key=lambda k: repr((k,)))]


def test_keys_of_other_types_are_merged_in_one_pass(spark, filled, in_passes):
    source = spark.createDataFrame([("09", "a", -9), ("10", "b", -10), ("77", "c", 0)], "k string, p string, v int")
    filled.upsert(source, ["k"])
    assert rows(filled.read().where("v <= 0 and k > 0")) == [(10, "b", -10), (77, "c", 0), (9, "a", -9)]


def test_many_partitions_are_not_written_in_passes(spark, new_dir, in_passes):
    """A pass writes directories of its own, so it must have enough rows for each partition."""
    in_passes.setattr(table_module, "PLACE_BYTES", 10_000)
    target = TargetTable(spark, new_dir)
    target.write(spark.range(60).selectExpr("cast(id as int) k", "cast(id as int) parent", "string(id % 6) p", "1 v"), partition_by=["p"], version=1)
    commit = target.apply_parent_child_changes(line_changes(spark, [1], [(k, k, str(k % 6), 2) for k in range(60)]), ["k"], ["parent"], 2)
    assert len(commit.dirs) == 6 and rows(target.read().select("v").distinct()) == [(2,)]


def shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(local.apply(i).getName()) for i in range(local.size()) if local.apply(i).getName().startswith("shuffle_")}


def test_no_shuffle_files_of_a_merge_stay(spark, new_dir, in_passes):
    target = TargetTable(spark, new_dir)
    source = spark.range(400).selectExpr("cast(id as int) k", "cast(id % 80 as int) parent", "string(id % 2) p", "1 v")
    changes = line_changes(spark, range(60), [(k, k, "0", 2) for k in range(200, 500)])
    before = shuffle_files(spark)
    target.write(source, partition_by=["p"], version=1)
    target.apply_parent_child_changes(changes, ["k"], ["parent"], 2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(files_module.CLEANUP_SETTING) == "false"


def test_rows_of_a_source_are_shuffled_once_for_both_joins(spark, in_passes):
    target = spark.range(100).selectExpr("id k", "id % 7 j", "1 v")
    source = spark.range(50, 150).selectExpr("id k", "id % 7 j", "2 v")
    merged = upsert(target, source, ["k", "j"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rows(merged)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == sorted(((k, k % 7, 1 if k < 50 else 2) for k in range(150)), key=repr)
    assert "ReusedExchange" in plan
