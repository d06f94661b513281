"""Change sources: what an incremental sync asks of the table it follows.

A change source answers four questions: its current version, the oldest version it can answer
from, the whole table, and the change rows of a version range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.changes import change_feed, change_key, net_changes, source_versions
from tablesync.operators.merge import latest_per_key
from tablesync.operators.predicates import (
    BROADCAST_BYTES,
    CHANGE_KEY_PREFIX,
    CHANGE_OP,
    measured_bytes,
)
from tablesync.sinks.files import stage
from tablesync.sources import change_sql
from tablesync.sources.jdbc import (
    jdbc_partitioned_scan,
    jdbc_scan,
    jdbc_version_range_scan,
    scalar_version,
)

# Names SQL Server and its users' procedures give the change columns.
SOURCE_OP = "SYS_CHANGE_OPERATION"
SOURCE_KEY_PREFIX = "SYS_CHANGE_PK_"


def with_change_names(df: DataFrame) -> DataFrame:
    """Change columns under the names the merge operators use."""
    names = [
        CHANGE_OP
        if name == SOURCE_OP
        else CHANGE_KEY_PREFIX + name.removeprefix(SOURCE_KEY_PREFIX)
        if name.startswith(SOURCE_KEY_PREFIX)
        else name
        for name in df.columns
    ]
    return df.toDF(*names)


@dataclass
class LogChangeSource:
    """A base table and a change log `(keys, version, op)`, both as frames."""

    base: DataFrame
    log: DataFrame
    keys: Sequence[str]
    version: str
    op: str
    _oldest: int | None = field(default=None, init=False, repr=False)

    def current_version(self) -> int:
        """Highest version of the log; the same pass finds the oldest one."""
        row = source_versions(self.log, self.version).first()
        if row["current_version"] is None:
            raise ValueError("the change log is empty: it has no version")
        self._oldest = int(row["min_valid_version"])
        return int(row["current_version"])

    def min_valid_version(self) -> int:
        """Version before the oldest change, as of the last look at the log."""
        if self._oldest is None:
            self.current_version()
        return self._oldest

    def snapshot(self) -> DataFrame:
        return self.base

    def changes(self, last: int, current: int) -> DataFrame:
        """Change rows; the net changes are staged, so the log is read once."""
        net = stage(
            net_changes(self.log, self.keys, self.version, self.op, last, current), "net"
        )
        small = measured_bytes(net.select([F.col(f"`{key}`") for key in self.keys])) <= BROADCAST_BYTES
        return change_feed(self.base, net, self.keys, broadcast_keys=small)


@dataclass
class JdbcChangeSource:
    """A SQL Server table with change tracking, or one with the user's own change queries.

    The queries may hold `?` markers; their parameter lists may use the reserved words of
    `change_sql`. `feed_version` names the version column of the rows that `changes_query`, or
    `feed`, a function from `(last, current)` to query text, returns. With it the range is read
    in `num_partitions` slices, one query each, which hold about equally many changes if
    `counts_query` returns the versions and the number `n` of changes of each; as a key may then show up in several slices,
    its latest row is kept. Change tracking without a query of its own is split by the change
    key of `split_by`, which deleted rows have too.
    """

    spark: SparkSession
    options: Mapping[str, str]
    schema: str
    table: str
    keys: Sequence[str]
    custom_schema: str = ""
    split_by: str = ""
    num_partitions: int = 1
    current_version_query: str = ""
    current_version_params: Sequence[str] = field(default_factory=list)
    min_valid_version_query: str = ""
    min_valid_version_params: Sequence[str] = field(default_factory=list)
    changes_query: str = ""
    changes_params: Sequence[str] = field(default_factory=list)
    feed: Callable[[int, int], str] | None = None
    feed_version: str = ""
    counts_query: str = ""
    counts_params: Sequence[str] = field(default_factory=list)

    def _render(
        self, query: str, params: Sequence[str], last: int | None, current: int | None
    ) -> str:
        bound = change_sql.bind_version_params(params, self.schema, self.table, last, current)
        return change_sql.render_call(query, bound)

    def _scalar(self, query: str) -> int:
        return scalar_version(jdbc_scan(self.spark, self.options, query))

    def current_version(self) -> int:
        query = self.current_version_query or change_sql.current_version_query()
        return self._scalar(self._render(query, self.current_version_params, None, None))

    def min_valid_version(self) -> int:
        default = change_sql.min_valid_version_query(self.schema, self.table)
        query = self.min_valid_version_query or default
        return self._scalar(self._render(query, self.min_valid_version_params, None, None))

    def snapshot(self) -> DataFrame:
        return self._scan(change_sql.table_query(self.schema, self.table), self.split_by)

    def changes(self, last: int, current: int) -> DataFrame:
        feed = self.feed
        if feed is None and self.changes_query:
            feed = self._rendered_changes
        if feed is None:
            query = change_sql.changes_query(self.schema, self.table, self.keys, last, current)
            split_by = self.split_by.strip('"[]`')
            keyed = split_by.lower() in {key.lower() for key in self.keys}
            return self._scan(query, change_key(split_by) if keyed else self.split_by)
        slices = self.num_partitions if self.feed_version else 1
        rows = with_change_names(
            jdbc_version_range_scan(
                self.spark, self.options, feed, self.feed_version, last, current, slices,
                self._rendered_counts if self.counts_query else None,
            )
        )
        if not self.feed_version:
            return rows
        change_keys = [change_key(key) for key in self.keys]
        return latest_per_key(rows, change_keys, self.feed_version).drop(self.feed_version)

    def _rendered_changes(self, last: int, current: int) -> str:
        return self._render(self.changes_query, self.changes_params, last, current)

    def _rendered_counts(self, last: int, current: int) -> str:
        return self._render(self.counts_query, self.counts_params, last, current)

    def _scan(self, query: str, split_by: str) -> DataFrame:
        if not split_by:
            return jdbc_scan(self.spark, self.options, query, self.custom_schema)
        return jdbc_partitioned_scan(
            self.spark, self.options, query, split_by, self.num_partitions, self.custom_schema
        )
