"""What one sync run does: source, shaping, write mode, target; with its consistency rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import StructType, TimestampType

from tablesync.functions.names import clean_name, key_list, target_name
from tablesync.operators.predicates import date_window, replace_scope

# The zone a source is assumed to keep its clocks in, and retention times.
DEFAULT_TIMEZONE = "Europe/Kiev"
DEFAULT_RETENTION = "interval 7 days"


class SpecError(ValueError):
    """Settings of a sync that contradict each other or are incomplete."""


@dataclass(frozen=True)
class SyncSpec:
    """Settings of one sync.

    `jdbc` holds the connection options; a run may also be given its source as a frame or a
    change source. Key and column lists may be text such as `"no,[shop]"`. `column_catalog`
    names the source's own list of columns (`information_schema.columns`) for drivers that
    deliver dates as text unless told their type. `where` is in the SQL of whoever evaluates it:
    the source over JDBC, Spark over a frame. `changes_version` names the version column that
    `changes_query` returns; it is then asked for `num_partitions` parts of the range at once.
    """

    path: str
    table: str
    schema: str = "dbo"
    jdbc: Mapping[str, str] = field(default_factory=dict)
    query: str = ""
    where: str = ""
    mode: str = "errorifexists"
    num_partitions: int = 1
    split_by: str = ""
    column_catalog: str = ""
    window_column: str = ""
    window_start: str = ""
    window_end: str = ""
    exec_date: str = ""
    write_partitioned: bool = False
    partition_by: list[str] | str = field(default_factory=list)
    use_merge: bool = False
    merge_keys: list[str] | str = field(default_factory=list)
    force_partition: bool = False
    generated_name: str = ""
    generated_expression: str = ""
    generated_type: str = ""
    timezone: str = DEFAULT_TIMEZONE
    partition_date: str = "local"
    change_tracking: bool = False
    custom_ct: bool = False
    primary_key: list[str] | str = field(default_factory=list)
    parent_key: list[str] | str = field(default_factory=list)
    changes_query: str = ""
    changes_params: list[str] | str = field(default_factory=list)
    changes_version: str = ""
    changes_counts: str = ""
    changes_counts_params: list[str] | str = field(default_factory=list)
    min_valid_version_query: str = ""
    min_valid_version_params: list[str] | str = field(default_factory=list)
    current_version_query: str = ""
    current_version_params: list[str] | str = field(default_factory=list)
    ct_window: int = -1
    source_partitions_only: bool = False
    key_slices: int = 0
    zorder_by: list[str] | str = field(default_factory=list)
    database: str = ""
    database_location: str = ""
    ingestion_time: bool = True
    log_retention: str = DEFAULT_RETENTION
    deleted_file_retention: str = DEFAULT_RETENTION

    def __post_init__(self) -> None:
        for name in _LIST_FIELDS:
            object.__setattr__(self, name, key_list(getattr(self, name)))
        self._check()

    def _check(self) -> None:
        def need(condition: bool, message: str) -> None:
            if not condition:
                raise SpecError(message)

        tracked = self.change_tracking or self.custom_ct
        need(bool(self.path), "path is required")
        need(bool(self.table), "table is required")
        need(
            bool(self.window_column)
            == bool(self.exec_date or (self.window_start and self.window_end)),
            "window_column goes with exec_date, or with window_start and window_end",
        )
        need(self.use_merge == bool(self.merge_keys), "use_merge goes with merge_keys")
        need(
            self.write_partitioned == bool(self.partition_by),
            "write_partitioned goes with partition_by",
        )
        need(
            not (self.window_column and self.write_partitioned)
            or self.window_column in self.partition_by
            or self.use_merge
            or self.force_partition,
            "window_column must be one of partition_by unless use_merge or force_partition is set",
        )
        generated = [self.generated_name, self.generated_expression, self.generated_type]
        need(
            all(generated) or not any(generated),
            "a generated column needs its name, expression and type",
        )
        need(
            tracked == bool(self.primary_key),
            "primary_key goes with change_tracking or custom_ct",
        )
        need(self.custom_ct == bool(self.parent_key), "parent_key goes with custom_ct")
        need(
            self.key_slices == 0 or (self.key_slices > 0 and (self.use_merge or tracked)),
            "key_slices, a positive number, goes with use_merge, change_tracking or custom_ct",
        )
        need(
            not (self.custom_ct and self.jdbc) or bool(self.changes_query),
            "custom_ct over JDBC needs changes_query",
        )

    @property
    def target(self) -> str:
        """Name of the target table."""
        return target_name(self.schema, self.table)

    @property
    def target_path(self) -> str:
        """Directory of the target table."""
        return f"{self.path}/{self.target}"

    @property
    def window_dates(self) -> tuple[dt.date, dt.date] | None:
        """First day and the day after the last day of the window."""
        if self.window_start and self.window_end:
            return dt.date.fromisoformat(self.window_start), dt.date.fromisoformat(self.window_end)
        if self.exec_date:
            day = dt.date.fromisoformat(self.exec_date)
            return day, day + dt.timedelta(days=1)
        return None

    def window_of(self, schema: StructType) -> Column | None:
        """Condition on source rows of the window.

        Sources keep wall clocks. A column that comes as instants holds them as clocks in UTC,
        as `shape` takes them, so the days are UTC's whatever the session's zone is.
        """
        if not self.window_column or self.window_dates is None:
            return None
        instants = isinstance(schema[self.window_column].dataType, TimestampType)
        zone = "UTC" if instants else None
        return date_window(self.window_column, *self.window_dates, timezone=zone)

    def overwrite_scope(self, schema: StructType) -> Column | None:
        """Condition on the target rows that an overwrite may replace; None for all of them.

        In the target the window column may be a date or an instant; the window's days are
        those of the source's time zone either way.
        """
        if not self.where and not self.window_column:
            return None
        window = None
        if self.window_column and self.window_dates is not None:
            name = clean_name(self.window_column)
            is_instant = isinstance(schema[name].dataType, TimestampType)
            zone = self.timezone if is_instant else None
            window = date_window(name, *self.window_dates, timezone=zone)
        return replace_scope(self.where or None, window)

    @property
    def generated(self) -> tuple[str, str, str] | None:
        if not self.generated_name:
            return None
        return self.generated_name, self.generated_expression, self.generated_type

    @property
    def layout(self) -> list[str]:
        """Partition columns under their names in the target."""
        return [clean_name(name) for name in self.partition_by]

    @classmethod
    def from_options(cls, options: Mapping[str, str], **others) -> SyncSpec:
        """A spec from text settings under their job-parameter names.

        The value `None` leaves a setting at its default.
        """
        given = {name: value for name, value in options.items() if value != "None"}
        unknown = sorted(set(given) - set(_OPTION_FIELDS) - _IGNORED_OPTIONS)
        if unknown:
            raise SpecError(f"unknown settings: {unknown}")
        settings: dict = dict(others)
        for option, name in _OPTION_FIELDS.items():
            if option not in given:
                continue
            value = given[option]
            if option in _FLAG_OPTIONS:
                settings[name] = _flag(option, value)
            elif option in _NUMBER_OPTIONS:
                settings[name] = int(value)
            elif option == "jdbcUrl":
                settings["jdbc"] = {**settings.get("jdbc", {}), "url": value}
            else:
                settings[name] = value
        if "disable_platform_ingested_at" in given:
            settings["ingestion_time"] = not settings["ingestion_time"]
        if _flag("generate_column", given.get("generate_column", "false")) != bool(
            settings.get("generated_name")
        ):
            raise SpecError("generate_column goes with a generated column's name and expression")
        return cls(**settings)


_LIST_FIELDS = [
    "partition_by",
    "merge_keys",
    "primary_key",
    "parent_key",
    "zorder_by",
    "changes_params",
    "changes_counts_params",
    "min_valid_version_params",
    "current_version_params",
]

# Names of the job parameters, each with the field it sets.
_OPTION_FIELDS = {
    "path_to_save": "path",
    "tab": "table",
    "schema": "schema",
    "jdbcUrl": "jdbc",
    "query": "query",
    "where": "where",
    "mode": "mode",
    "numpart": "num_partitions",
    "splitby": "split_by",
    "dtflt": "window_column",
    "calc_min_dt": "window_start",
    "calc_max_dt": "window_end",
    "exec_date": "exec_date",
    "write_partitioned": "write_partitioned",
    "partition_col": "partition_by",
    "force_partition": "force_partition",
    "use_merge": "use_merge",
    "merge_keys": "merge_keys",
    "generated_column_name": "generated_name",
    "generated_column_exp": "generated_expression",
    "generated_column_type": "generated_type",
    "timezone": "timezone",
    "change_tracking": "change_tracking",
    "custom_ct": "custom_ct",
    "primary_key": "primary_key",
    "parent_key": "parent_key",
    "ct_changes_query": "changes_query",
    "ct_changes_query_params": "changes_params",
    "ct_changes_version": "changes_version",
    "ct_changes_counts_query": "changes_counts",
    "ct_changes_counts_query_params": "changes_counts_params",
    "ct_min_valid_version_query": "min_valid_version_query",
    "ct_min_valid_version_params": "min_valid_version_params",
    "ct_current_version_query": "current_version_query",
    "ct_current_version_params": "current_version_params",
    "ct_window": "ct_window",
    "key_slices": "key_slices",
    "zorderby_col": "zorder_by",
    "hive_db": "database",
    "hive_db_location": "database_location",
    "disable_platform_ingested_at": "ingestion_time",
    "log_retention_duration": "log_retention",
    "deleted_file_retention_duration": "deleted_file_retention",
}
_FLAG_OPTIONS = {
    "write_partitioned",
    "force_partition",
    "use_merge",
    "change_tracking",
    "custom_ct",
    "disable_platform_ingested_at",
}
_NUMBER_OPTIONS = {"numpart", "ct_window", "key_slices"}
# Settings of the launcher rather than of the data work.
_IGNORED_OPTIONS = {"generate_column", "log_lvl", "log_spark_lvl"}


def _flag(option: str, value: str) -> bool:
    if value.lower() not in ("true", "false"):
        raise SpecError(f"{option} is true or false, not {value!r}")
    return value.lower() == "true"
