"""Targets in the session catalog: database, table by name, retention properties."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tablesync.sinks.ledger import BATCH, NULL_PARTITION, SLICE, Commit
from tablesync.sinks.table import TargetTable

# Partitions named in one ALTER TABLE statement.
_PARTITIONS_PER_STATEMENT = 500


def _name(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a database unless it exists."""
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{place}")


def _partition_spec(directory: str) -> tuple[tuple[str, str | None], ...]:
    """Column-value pairs spelled by a directory name."""
    pairs = (part.partition("=")[::2] for part in directory.split("/"))
    return tuple(
        (unquote(column), None if value == NULL_PARTITION else unquote(value))
        for column, value in pairs
    )


def _render(spec: tuple[tuple[str, str | None], ...]) -> str:
    values = (
        f"{_name(column)}={'NULL' if value is None else _text(value)}" for column, value in spec
    )
    return f"PARTITION ({', '.join(values)})"


def register_table(
    target: TargetTable, database: str, table: str, database_location: str | None = None
) -> bool:
    """Make an existing target readable as `database.table`; False if there is no target.

    The catalog holds two external tables over the root, partitioned by batch and by the
    target's own partition columns, and a view of the target's name over one of them. The other
    one is brought to the directories of the latest commit, by differences, and then the view
    is pointed at it in one statement: a reader finds one commit's rows at any moment, and a
    call that stops half-way leaves the view as it was. To call again after each commit.
    """
    commit = target.ledger.latest()
    if commit is None:
        return False
    spark = target.spark
    create_database(spark, database, database_location)
    idle = _idle_files_table(spark, database, table)
    if not spark.catalog.tableExists(_name(database, idle)):
        _create_files_table(spark, database, idle, target.root, commit)
    _align_partitions(spark, database, idle, commit)
    columns = ", ".join(_name(field.name) for field in commit.struct)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_name(database, table)} AS "
        f"SELECT {columns} FROM {_name(database, idle)}"
    )
    return True


def _files_tables(table: str) -> tuple[str, str]:
    return f"{table}__files_a", f"{table}__files_b"


def _idle_files_table(spark: SparkSession, database: str, table: str) -> str:
    """The one of the two files tables that the view does not read."""
    first, second = _files_tables(table)
    if not spark.catalog.tableExists(_name(database, table)):
        return first
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(database, table)}").collect()
    text = next((row["data_type"] for row in rows if row["col_name"] == "View Text"), "")
    return second if text.endswith(f"{_name(database, first)}") else first


def _create_files_table(
    spark: SparkSession, database: str, files_table: str, root: str, commit: Commit
) -> None:
    types = {field.name: field.dataType.simpleString() for field in StructType(commit.struct.fields)}
    plain = [name for name in types if name not in commit.partition_by]
    types |= {BATCH: "string", SLICE: "int"}
    layout = [BATCH, *commit.layout]
    columns = [f"{_name(name)} {types[name]}" for name in [*plain, *layout]]
    partitions = ", ".join(_name(name) for name in layout)
    spark.sql(
        f"CREATE TABLE {_name(database, files_table)} ({', '.join(columns)}) USING PARQUET "
        f"PARTITIONED BY ({partitions}) LOCATION {_text(root)}"
    )


def _align_partitions(
    spark: SparkSession, database: str, files_table: str, commit: Commit
) -> None:
    """Add and drop partitions until the catalog lists the commit's directories."""
    name = _name(database, files_table)
    wanted = {_partition_spec(directory) for directory in commit.dirs}
    listed = {
        _partition_spec(row[0]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()
    }
    for action, separator, specs in (
        ("ADD IF NOT EXISTS", " ", sorted(wanted - listed, key=str)),
        ("DROP IF EXISTS", ", ", sorted(listed - wanted, key=str)),
    ):
        for start in range(0, len(specs), _PARTITIONS_PER_STATEMENT):
            chunk = separator.join(
                _render(spec) for spec in specs[start : start + _PARTITIONS_PER_STATEMENT]
            )
            spark.sql(f"ALTER TABLE {name} {action} {chunk}")


def table_properties(
    spark: SparkSession, database: str, table: str, names: list[str]
) -> dict[str, str]:
    """Those of the named properties that the table has."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_name(database, table)}").collect()
    present = {row["key"]: row["value"] for row in rows}
    return {name: present[name] for name in names if name in present}


def set_retention(
    target: TargetTable,
    database: str,
    table: str,
    log: str = "interval 7 days",
    deleted_files: str = "interval 7 days",
) -> bool:
    """Bring the retention durations of a registered table to the wanted ones.

    Nothing is altered if they are already set. Returns whether something changed.
    """
    wanted: Mapping[str, str] = {
        "logRetentionDuration": log,
        "deletedFileRetentionDuration": deleted_files,
    }
    spark = target.spark
    present = [t for t in _files_tables(table) if spark.catalog.tableExists(_name(database, t))]
    outdated = [t for t in present if table_properties(spark, database, t, list(wanted)) != wanted]
    settings = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in wanted.items())
    for files_table in outdated:
        spark.sql(f"ALTER TABLE {_name(database, files_table)} SET TBLPROPERTIES ({settings})")
    return target.set_retention(log, deleted_files) is not None or bool(outdated)
