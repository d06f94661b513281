"""One sync run: read, shape, write, cluster, register."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.names import clean_name
from tablesync.operators.changes import capped_version, require_valid_cursor
from tablesync.operators.predicates import (
    CHANGE_KEY_PREFIX,
    CHANGE_OP,
    filter_source,
)
from tablesync.operators.shape import shape
from tablesync.plans.spec import SpecError, SyncSpec
from tablesync.sinks.catalog import register_table, set_retention
from tablesync.sinks.files import stage, staging_scope
from tablesync.sinks.ledger import Commit
from tablesync.sinks.table import TargetTable
from tablesync.sources import change_sql
from tablesync.sources.feeds import JdbcChangeSource
from tablesync.sources.jdbc import (
    column_type,
    filtered_relation,
    jdbc_partitioned_scan,
    jdbc_scan,
    type_override_schema,
    window_condition,
)


class ChangeSource(Protocol):
    """What an incremental sync needs to know from its source."""

    def current_version(self) -> int: ...

    def min_valid_version(self) -> int: ...

    def snapshot(self) -> DataFrame: ...

    def changes(self, last: int, current: int) -> DataFrame: ...


@dataclass(frozen=True)
class VersionRange:
    """Versions an incremental run covers; no `last` means a first, full load."""

    last: int | None
    current: int


def plan_versions(target: TargetTable, source: ChangeSource, ct_window: int = -1) -> VersionRange:
    """The versions to fetch next, refusing a cursor the source cannot answer any more."""
    newest = source.current_version()
    if not target.exists():
        return VersionRange(None, newest)
    oldest = source.min_valid_version()
    cursor = target.cursor()
    last = oldest if cursor is None else cursor
    current = capped_version(newest, last, ct_window)
    require_valid_cursor(last, oldest)
    return VersionRange(last, current)


def read_source(spark: SparkSession, spec: SyncSpec, frame: DataFrame | None = None) -> DataFrame:
    """Rows of a non-incremental run: the table or query, window and predicate applied.

    Over JDBC the predicate is in the source's SQL and is evaluated there alone; over a given
    frame it is Spark SQL.
    """
    if frame is not None:
        return filter_source(frame, spec.where or None, spec.window_of(frame.schema))
    if not spec.jdbc:
        raise SpecError("a run needs JDBC options, a frame or a change source")
    return _jdbc(spark, spec, spec.query or change_sql.table_query(spec.schema, spec.table))


def _jdbc(spark: SparkSession, spec: SyncSpec, relation: str) -> DataFrame:
    """The source's rows over JDBC, window and predicate being part of the relation.

    So the source can use its own dialect and indexes, no other rows cross the wire, and the
    ranges of a split read span the filtered rows.
    """
    schema = _type_overrides(spark, spec)
    conditions = [spec.where] if spec.where else []
    if spec.window_column and spec.window_dates:
        window_type = column_type(jdbc_scan(spark, spec.jdbc, relation, schema), spec.window_column)
        conditions.append(window_condition(spec.window_column, window_type, *spec.window_dates))
    filtered = filtered_relation(relation, conditions)
    if not spec.split_by:
        return jdbc_scan(spark, spec.jdbc, filtered, schema)
    return jdbc_partitioned_scan(
        spark, spec.jdbc, filtered, spec.split_by, spec.num_partitions, schema
    )


def _type_overrides(spark: SparkSession, spec: SyncSpec) -> str:
    """Types to read date and time columns as, from the column catalog if the spec names one."""
    if not spec.column_catalog:
        return ""
    catalog = jdbc_scan(spark, spec.jdbc, spec.column_catalog)
    columns = catalog.toDF(*[name.lower() for name in catalog.columns]).where(
        (F.col("table_name") == spec.table) & (F.col("table_schema") == spec.schema)
    )
    return type_override_schema(columns, timestamp_type="timestamp_ntz").first()[0]


def jdbc_change_source(spark: SparkSession, spec: SyncSpec) -> JdbcChangeSource:
    """The change source a spec with JDBC options describes."""
    return JdbcChangeSource(
        spark=spark,
        options=spec.jdbc,
        schema=spec.schema,
        table=spec.table,
        keys=spec.primary_key,
        custom_schema=_type_overrides(spark, spec),
        split_by=spec.split_by,
        num_partitions=spec.num_partitions,
        current_version_query=spec.current_version_query,
        current_version_params=spec.current_version_params,
        min_valid_version_query=spec.min_valid_version_query,
        min_valid_version_params=spec.min_valid_version_params,
        changes_query=spec.changes_query,
        changes_params=spec.changes_params,
        feed_version=spec.changes_version,
        counts_query=spec.changes_counts,
        counts_params=spec.changes_counts_params,
    )


def shape_rows(df: DataFrame, spec: SyncSpec) -> DataFrame:
    """Source rows or change rows in the form of the target.

    Change columns keep their names and pass through the same casts as the columns they
    mirror, so keys compare equal on both sides.
    """
    partition_columns = list(spec.partition_by)
    if CHANGE_OP in df.columns:
        partition_columns += [CHANGE_KEY_PREFIX + name for name in spec.partition_by]
    return shape(
        df,
        timezone=spec.timezone,
        partition_columns=partition_columns,
        generated=spec.generated,
        ingestion_time=spec.ingestion_time,
        partition_date=spec.partition_date,
    )


def run_sync(
    spark: SparkSession,
    spec: SyncSpec,
    source: DataFrame | ChangeSource | None = None,
    stage_source: bool = True,
) -> Commit | None:
    """Carry out one run and return its last data commit (None if nothing was to be done).

    Where a run needs its source more than once, the shaped rows are written once to shared
    storage and every step reads that copy; `stage_source=False` leaves that out for sources
    that are themselves stable files.
    """
    target = TargetTable(spark, spec.target_path)
    before = target.ledger.latest()
    with staging_scope(spark):
        if spec.change_tracking or spec.custom_ct:
            feed = jdbc_change_source(spark, spec) if source is None else source
            if isinstance(feed, DataFrame):
                raise SpecError("change tracking needs a change source, not a frame")
            commit = incremental_sync(target, spec, feed, stage_source)
        else:
            frame = source if isinstance(source, DataFrame) else None
            commit = plain_sync(target, spec, read_source(spark, spec, frame), stage_source)
    finish(target, spec, before)
    return commit


def plain_sync(
    target: TargetTable, spec: SyncSpec, source: DataFrame, stage_source: bool = True
) -> Commit | None:
    """Upsert, or a plain write in the mode of the spec."""
    rows = shape_rows(source, spec)
    scope = spec.overwrite_scope(rows.schema)
    read_again = spec.use_merge or (spec.mode.lower() == "overwrite" and scope is not None)
    if stage_source and read_again and target.exists():
        rows = stage(rows)
    if spec.use_merge:
        keys = [clean_name(key) for key in spec.merge_keys]
        return target.upsert(
            rows, keys, spec.layout, source_partitions_only=spec.source_partitions_only,
            stage_source=False, slices=spec.key_slices,
        )
    return target.write(rows, spec.mode, spec.layout, scope)


def incremental_sync(
    target: TargetTable, spec: SyncSpec, source: ChangeSource, stage_source: bool = True
) -> Commit | None:
    """Full load if there is no target, else the changes since its cursor."""
    versions = plan_versions(target, source, spec.ct_window)
    if versions.last is None:
        rows = shape_rows(source.snapshot(), spec)
        by = [clean_name(key) for key in spec.primary_key] if spec.key_slices else []
        return target.write(
            rows, "errorifexists", spec.layout, version=versions.current, slice_by=by, slices=spec.key_slices
        )
    rows = shape_rows(source.changes(versions.last, versions.current), spec)
    rows = stage(rows) if stage_source else rows
    keys = [clean_name(key) for key in spec.primary_key]
    if spec.custom_ct:
        parents = [clean_name(key) for key in spec.parent_key]
        return target.apply_parent_child_changes(
            rows, keys, parents, versions.current, versions.last, stage_source=False
        )
    return target.apply_changes(
        rows, keys, versions.current, source_partitions_only=spec.source_partitions_only,
        stage_source=False,
    )


def finish(target: TargetTable, spec: SyncSpec, before: Commit | None) -> None:
    """Cluster the partitions this run wrote to, then register the table and its retention."""
    if spec.zorder_by and target.exists():
        columns = [clean_name(name) for name in spec.zorder_by]
        target.zorder(columns, changed_since=None if before is None else before.commit)
    if not spec.database:
        return
    if register_table(target, spec.database, spec.target, spec.database_location or None):
        set_retention(
            target, spec.database, spec.target, spec.log_retention, spec.deleted_file_retention
        )
