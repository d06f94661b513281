"""A target table: parquet directories, and the ledger that says which of them count.

Layout: `root/_batch=<id>/<partition directories>/_slice=<n>/*.parquet` and
`root/_ledger/<n>.json`. Every write goes to a new batch directory and becomes visible with
the ledger file written last, so a crash leaves the table as it was, and readers keep the
commit they started from.

A write replaces only the directories that hold affected rows; all others are carried over by
name. Slices keep those directories small: each holds what some neighbouring tasks wrote, a few
gigabytes, so a change of few rows does not rewrite a partition that holds a third of a table,
nor an unpartitioned table as a whole. A merge writes what it keeps and what it adds together,
and joins a partition's small slices once there are many, so directories do not pile up.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tablesync.functions.cursor import cursor_text
from tablesync.operators import predicates
from tablesync.operators.layout import ZVALUE, zorder
from tablesync.operators.merge import (
    DuplicateKeyError,
    SourceKeys,
    delete_keys,
    drop_change_columns,
    each_once,
    inserted_rows,
    measure_keys,
    require_in_scope,
    updated_rows,
    value_bytes,
)
from tablesync.operators.predicates import (
    CHANGE_KEY_PREFIX,
    as_column,
    is_delete,
    is_write,
    touched_partitions,
)
from tablesync.operators.schema import require_same_columns
from tablesync.operators.shape import actual_names, quoted
from tablesync.sinks.files import shuffles_removed, stage, staging_scope
from tablesync.sinks.ledger import BATCH, OPTIMIZE, SLICE, Commit, Ledger

# Checksum of the path of a row's file; it stands for the directory, whose name is long.
_DIR = "_dir"
# Marks of target rows: the parent is deleted, the primary key is written.
_GONE, _HIT = "_gone", "_hit"

# Neighbouring tasks that share a slice directory. Tasks write some 64 to 128 MB each.
TASKS_PER_SLICE = 64

# Key types whose bounds serve to skip files.
_BOUNDED_TYPES = (IntegralType, DecimalType, DateType, StringType)

# A slice with less than this is small; a merge that leaves more small slices than
# SMALL_SLICES in a partition it wrote to joins them.
SMALL_SLICE_BYTES = 64 * 1024 * 1024
SMALL_SLICES = 8

# Rows that a join must shuffle take turns, in passes over parts of their keys, and the shuffle files of a
# pass go when it ends: about PASS_BYTES of rows at once, as `value_bytes` counts them. Each pass reads all
# rows, so there are at most MAX_PASSES; SENT_PASSES if that makes keys few enough to be sent to all tasks,
# so that nothing is shuffled. Each writes directories of its own, so it has PLACE_BYTES for each partition.
PASS_BYTES = 4 * 1024 * 1024 * 1024
MAX_PASSES = 4
SENT_PASSES = 8
PLACE_BYTES = 1536 * 1024 * 1024

# Key types of which equal values of one type have equal hashes; strings too, if they compare as bytes.
_HASHED_TYPES = (IntegralType, DecimalType, DateType, TimestampType, TimestampNTZType)

# Directories whose sizes are asked for one by one; more are listed by a Spark job.
FEW_DIRS = 32

# Most of a clustered file, and of its rows in memory, where one task sorts them.
TARGET_FILE_BYTES = 256 * 1024 * 1024
SORTED_BYTES = 256 * 1024 * 1024


class TableExistsError(RuntimeError):
    """The target exists and the write mode does not allow that."""


class TargetTable:
    """One target table under `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.ledger = Ledger(spark, path)
        self.root = self.ledger.files.root
        self._dirs_by_sum: dict[int, set[str]] = {}

    # reading ---------------------------------------------------------------------------

    def exists(self) -> bool:
        """Whether the table has a commit."""
        return bool(self.ledger.numbers())

    def read(self) -> DataFrame:
        """The table as of its latest commit."""
        return self._scan(self._require(), None)

    def history(self) -> DataFrame:
        """One row per commit."""
        return self.ledger.history()

    def cursor(self) -> int | None:
        """Version of the last sync, or None if its commit carries none."""
        commit = self.ledger.last_sync()
        return None if commit is None else commit.version

    def _require(self) -> Commit:
        commit = self.ledger.latest()
        if commit is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return commit

    def _scan(
        self, commit: Commit, dirs: Sequence[str] | None, with_dir: bool = False
    ) -> DataFrame:
        """Rows of some (default: all) directories of a commit, optionally with a number that `_collect_dirs`
        knows the directory by."""
        wanted = commit.dirs if dirs is None else list(dirs)
        schema = commit.struct
        if not wanted:
            extra = [StructField(_DIR, LongType())] if with_dir else []
            return self.spark.createDataFrame([], StructType(schema.fields + extra))
        hidden = [StructField(BATCH, StringType()), StructField(SLICE, IntegerType())]
        full = StructType(schema.fields + hidden[: 2 if commit.sliced else 1])
        rows = (
            self.spark.read.schema(full)
            .option("basePath", self.root)
            .parquet(*[f"{self.root}/{name}" for name in wanted])
        )
        columns = [quoted(field.name) for field in schema]
        if with_dir:
            depth = 2 + len(commit.layout)  # the batch, what is below it, the file
            for path in rows.inputFiles():
                inner = path.split("/")[-depth:]
                names = self._dirs_by_sum.setdefault(zlib.crc32("/".join(inner).encode()), set())
                names.add(unquote("/".join(inner[:-1])))
            inner = F.substring_index("_metadata.file_path", "/", -depth)
            columns.append(F.crc32(inner.cast("binary")).alias(_DIR))
        return rows.select(columns)

    # plain writes ----------------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        mode: str = "errorifexists",
        partition_by: Sequence[str] = (),
        scope: Column | str | None = None,
        version: int | None = None,
        sliced: bool = True,
        slice_by: Sequence[str] = (),
        slices: int = 0,
    ) -> Commit | None:
        """Write a frame: append, overwrite (within `scope`), errorifexists or ignore.

        A table is created with `partition_by` and, unless it will never be merged into, with
        slices; later writes follow the table's own layout. With `slice_by`, columns of its merge
        key, a row's slice is one of `slices` by a hash of those columns, so a merge opens only the
        slices that its keys fall into.
        Returns None when `ignore` left an existing table alone.
        """
        chosen = mode.lower()
        if chosen not in ("append", "overwrite", "error", "errorifexists", "ignore"):
            raise ValueError(f"unknown write mode {mode!r}")
        before = self.ledger.latest()
        if before is None:
            return self._create(df, partition_by, version, sliced, slice_by, slices)
        require_same_columns(df.columns, before.struct.names)
        if chosen == "ignore":
            return None
        if chosen in ("error", "errorifexists"):
            raise TableExistsError(f"a table exists at {self.root}")
        if chosen == "overwrite":
            return self.replace_where(df, scope, version)
        new_dirs = self._put(df, before, redistribute=True)
        return self._commit(before, "WRITE", set(), new_dirs, version)

    def _create(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        version: int | None,
        sliced: bool,
        slice_by: Sequence[str] = (),
        slices: int = 0,
    ) -> Commit:
        if bool(slice_by) != (slices > 0) or (slice_by and not sliced):
            raise ValueError("slice_by goes with a number of slices, in a sliced table")
        taken = {BATCH, SLICE} & {name.lower() for name in df.columns}
        if taken:
            raise ValueError(f"column names used by the layout: {sorted(taken)}")
        planned = self.ledger.next(
            None,
            op="WRITE",
            schema=_nullable(df.schema).jsonValue(),
            partition_by=actual_names(partition_by, df.columns),
            sliced=sliced,
            slice_by=actual_names(slice_by, df.columns),
            slices=slices,
            dirs=[],
            user_metadata=cursor_text(version),
        )
        new_dirs = self._put(df, planned, redistribute=True)
        return self.ledger.append(replace(planned, dirs=new_dirs))

    def replace_where(
        self, df: DataFrame, scope: Column | str | None = None, version: int | None = None
    ) -> Commit:
        """Replace the rows in `scope` (default: all); in a partitioned table only where the
        source has rows.

        "Where the source has rows" goes by the last partition column, read off the names of
        the directories the source was written to. Other directories, and those without a row
        in scope, are carried over; without a scope nothing of the target is read.
        """
        before = self._require()
        require_same_columns(df.columns, before.struct.names)
        if scope is not None:
            scope = F.coalesce(as_column(scope), F.lit(False))
            require_in_scope(df, scope)
        new_dirs = self._put(df, before, redistribute=True)
        replaced = _same_partitions(before, new_dirs)
        if scope is not None:
            located = self._scan(before, sorted(replaced), with_dir=True)
            replaced = self._collect_dirs(located.where(scope), before)
            kept = self._scan(before, sorted(replaced)).where(~scope)
            new_dirs += self._put(kept, before, redistribute=False) if replaced else []
        return self._commit(before, "WRITE", replaced, new_dirs, version)

    # merges ----------------------------------------------------------------------------

    def upsert(
        self,
        source: DataFrame,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        version: int | None = None,
        source_partitions_only: bool = False,
        stage_source: bool = True,
        slices: int = 0,
    ) -> Commit | None:
        """Update matched rows, insert the others; the first run is a plain write, with `slices` by the keys."""
        before = self.ledger.latest()
        if before is None:
            by = list(keys) if slices else []
            return self.write(source, "errorifexists", partition_by, version=version, slice_by=by, slices=slices)
        require_same_columns(source.columns, before.struct.names)
        return self._merge(
            before, source, keys, "", version, source_partitions_only, stage_source=stage_source
        )

    def apply_changes(
        self,
        changes: DataFrame,
        keys: Sequence[str],
        version: int | None = None,
        source_partitions_only: bool = False,
        stream: str | None = None,
        batch: int | None = None,
        stage_source: bool = True,
    ) -> Commit:
        """Apply I, U and D rows by their `_pk_<key>` columns."""
        before = self._require()
        require_same_columns(drop_change_columns(changes).columns, before.struct.names)
        return self._merge(
            before, changes, keys, CHANGE_KEY_PREFIX, version, source_partitions_only, stream, batch, stage_source
        )

    def apply_parent_child_changes(
        self,
        changes: DataFrame,
        primary_key: Sequence[str],
        parent_key: Sequence[str],
        version: int,
        last_version: int | None = None,
        stage_source: bool = True,
    ) -> Commit:
        """Delete the rows of deleted parents, then upsert I and U rows by primary key.

        These are two commits. The first keeps the old cursor unless there is nothing to
        upsert, so a crash in between makes the next run repeat the whole range.
        """
        before = self._require()
        require_same_columns(drop_change_columns(changes).columns, before.struct.names)
        with staging_scope(self.spark), shuffles_removed(self.spark):
            changes = stage(changes, "merge-source", "zstd") if stage_source else changes
            old = self.cursor() if last_version is None else last_version
            parents = _Side(changes.where(is_delete()), parent_key, before)
            writes = _Side(changes.where(is_write()), primary_key, before)
            if writes.facts.max_per_key > 1:
                raise DuplicateKeyError(f"source rows are not unique on {list(primary_key)}")
            found = self._located_by_both(before, parents, writes)
            if not writes.facts.n_rows:
                return self._delete(before, parents, found, version)
            after = self._delete(before, parents, found, old) if parents.facts.n_rows else before
            # rows of the directories that the first commit replaced are where it wrote them
            rest = found.where(F.col(_HIT) & ~F.col(_GONE))
            fresh = sorted(set(after.dirs) - set(before.dirs))
            moved = set(before.dirs) - set(after.dirs)
            dirs = self._collect_dirs(rest, before)
            if dirs & moved:
                dirs |= self._followed(after, dirs & moved, fresh, writes)
            commit, new_dirs = self._write_merge(
                after, writes.source, writes.facts, writes.keys, CHANGE_KEY_PREFIX, dirs - moved, rest, version, {}
            )
        self._compact(commit, new_dirs)
        return commit

    def _followed(self, after: Commit, moved: set[str], fresh: Sequence[str], writes: _Side) -> set[str]:
        """Of the directories just written, those that took over rows with written keys from `moved` ones.

        Rows stay in their partition. Where that leaves a choice, few keys are looked for again; many are
        in nearly every directory, and looking for them costs more than writing all of these.
        """
        places = {_place(after, name) for name in moved}
        near = [name for name in fresh if _place(after, name) in places]
        told = len(near) == len(places) or not writes.facts.few_keys
        if told and {_place(after, name) for name in near} == places:
            return set(near)
        again = _matched_rows(self._scan(after, fresh, with_dir=True), writes.sent_keys(), writes.keys)
        return self._collect_dirs(again, after)

    def _located_by_both(self, before: Commit, parents: _Side, writes: _Side) -> DataFrame:
        """Keys and directory of the target rows whose parent is deleted (`_gone`) or whose primary key is
        written (`_hit`), from one scan of the key columns."""
        names = [quoted(name) for name in dict.fromkeys([*writes.keys, *parents.keys])]
        sides = [(side, mark) for side, mark in ((parents, _GONE), (writes, _HIT)) if side.facts.n_rows]
        located = self._scan(before, None, with_dir=True)
        inside = F.lit(False)
        for side, _ in sides:
            inside = inside | _within_bounds(located, side.keys, side.facts)
        located = located.where(inside).select(*names, _DIR)
        many = [side for side, _ in sides if not side.facts.few_keys]
        by = [key for key in writes.keys if many and all(key in side.keys for side in many)]
        passes = 1
        if by and all(side.hashed_alike(before, by) for side in many):
            passes = _passes(_value_bytes(located) + sum(side.facts.key_bytes for side in many))
        found = []
        for number in range(passes):
            rows = _part(located, by, number, passes)
            for side, mark in sides:
                # keys that may be sent as a whole need not have the columns that tell passes apart
                parts = passes if side in many else 1
                marked = _part(side.all_keys(), by, number, parts).withColumn(mark, F.lit(True))
                rows = rows.join(F.broadcast(marked) if side.few_keys(parts) else marked, list(side.keys), "left")
            marks = [
                F.coalesce(F.col(mark), F.lit(False)).alias(mark) if any(mark == m for _, m in sides) else F.lit(False).alias(mark)
                for mark in (_GONE, _HIT)
            ]
            rows = rows.select(*names, _DIR, *marks).where(F.col(_GONE) | F.col(_HIT))
            found.append(stage(rows, "matched", "zstd"))
        return reduce(DataFrame.unionByName, found)

    def _merge(
        self,
        before: Commit,
        source: DataFrame,
        keys: Sequence[str],
        prefix: str,
        version: int | None,
        source_partitions_only: bool = False,
        stream: str | None = None,
        batch: int | None = None,
        stage_source: bool = True,
    ) -> Commit:
        """Find the directories with matched rows, rewrite those together with the source's rows.

        The source is read several times, so unless the caller says that it is stable and cheap
        to read again, it is staged first.
        """
        prefixed = actual_names([prefix + key for key in keys], source.columns)
        keys = actual_names(keys, before.struct.names)
        source = source.withColumnsRenamed(dict(zip(prefixed, [prefix + key for key in keys])))
        prefixed = [prefix + key for key in keys]
        with staging_scope(self.spark), shuffles_removed(self.spark):
            source = stage(source, "merge-source") if stage_source else source
            facts = measure_keys(source, prefixed)
            marks = {"stream": stream, "batch": batch, "changes": facts.counts}
            if facts.max_per_key > 1:
                raise DuplicateKeyError(f"source rows are not unique on {list(keys)}")
            if facts.n_rows == 0:
                return self._commit(before, "MERGE", set(), [], version, **marks)
            source_keys = _merge_keys(source, prefixed, keys, facts.few_keys)
            dirs = None
            if before.partition_by and (source_partitions_only or before.partition_by[-1] in keys):
                column = before.partition_by[-1]
                named = prefix + column if column in keys else column
                dirs = self._dirs_of(before, touched_partitions(source, named).toDF(column), column)
            dirs = self._touched_slices(before, source, keys, prefix, dirs)
            located = _skip_by_bounds(self._scan(before, dirs, with_dir=True), keys, facts)
            matched = stage(_matched_rows(located, source_keys, keys), "matched")
            commit, new_dirs = self._write_merge(
                before, source, facts, keys, prefix, self._collect_dirs(matched, before), matched, version, marks
            )
        self._compact(commit, new_dirs)
        return commit

    def _write_merge(
        self,
        before: Commit,
        source: DataFrame,
        facts: SourceKeys,
        keys: Sequence[str],
        prefix: str,
        replaced: set[str],
        matched: DataFrame,
        version: int | None,
        marks: dict,
    ) -> tuple[Commit, list[str]]:
        """Rewrite the directories with matched rows together with the source's new rows; the commit and
        the directories written."""
        prefixed, deletes = [prefix + key for key in keys], bool(facts.counts.get("D"))
        passes = 1
        if not facts.few_rows and _hashed_alike(facts.types, before, keys):
            n_bytes = facts.row_bytes + (_value_bytes(self._scan(before, sorted(replaced))) if replaced else 0)
            passes = _passes(n_bytes, _places(before))
        new_dirs = []
        for number in range(passes):
            part = _part(source, prefixed, number, passes)
            hits = each_once(_part(matched, keys, number, passes), keys)
            rows = inserted_rows(part, hits, keys, prefix, facts.few_keys)
            if replaced:
                old = _part(self._scan(before, sorted(replaced)), keys, number, passes)
                rows = updated_rows(old, part, keys, prefix, facts.few_rows, deletes).unionByName(rows)
            new_dirs += self._put(rows, before, redistribute=True)
        # a slice never changes, so its size is asked for once and kept in the commits
        dirs = [name for name in before.dirs if name not in replaced] + new_dirs
        unknown = {n for names in self._crowded(before, dirs, new_dirs) for n in names if n not in before.sizes}
        marks = {"changes": facts.counts, "sizes": {**before.sizes, **self._sizes(sorted(unknown))}, **marks}
        return self._commit(before, "MERGE", replaced, new_dirs, version, **marks), new_dirs

    def _delete(self, before: Commit, parents: _Side, found: DataFrame, version: int | None) -> Commit:
        """Remove the rows of deleted parents from the directories that hold any."""
        if not parents.facts.n_rows:
            return self._commit(before, "MERGE", set(), [], version)
        replaced = self._collect_dirs(found.where(_GONE), before)
        new_dirs = []
        if replaced:
            old = self._scan(before, sorted(replaced))
            passes = 1
            if not parents.facts.few_keys and parents.hashed_alike(before, parents.keys):
                n_bytes, places = _value_bytes(old), _places(before)
                most = min(SENT_PASSES, n_bytes // (places * PLACE_BYTES))
                passes = next((n for n in range(1, most + 1) if parents.few_keys(n)), _passes(n_bytes, places))
            for number in range(passes):
                few, gone = parents.few_keys(passes), _part(parents.all_keys(), parents.keys, number, passes)
                rows = _part(old, parents.keys, number, passes)
                kept = delete_keys(rows, F.broadcast(gone) if few else gone, parents.keys)
                new_dirs += self._put(kept, before, redistribute=not few)
        return self._commit(before, "MERGE", replaced, new_dirs, version, changes=parents.facts.counts)

    # upkeep ----------------------------------------------------------------------------

    def zorder(
        self,
        columns: Sequence[str],
        changed_since: int | None = None,
        num_files: int | None = None,
    ) -> Commit | None:
        """Cluster the table, or only what was written after commit `changed_since`.

        Of a partitioned table that is the partitions written to, which go by the last partition
        column, as directory names tell it; of an unpartitioned one the new directories alone.
        """
        before = self._require()
        dirs = set(before.dirs)
        if changed_since is not None:
            dirs -= set(self.ledger.read(changed_since).dirs)
            dirs = _same_partitions(before, dirs) if before.partition_by else dirs
        if not dirs:
            return None
        n_files = num_files or self._files_for(before, sorted(dirs))
        columns = actual_names(columns, before.struct.names)
        position = F.xxhash64(F.col("_metadata.row_index"))
        rows = self._scan(before, sorted(dirs)).select("*", position.alias("_position"))
        clustered = zorder(
            rows, columns, n_files, before.partition_by, salt=F.col("_position"), sort=False
        )
        new_dirs = self._put(clustered, before, redistribute=False, order=ZVALUE)
        return self._commit(before, OPTIMIZE, dirs, new_dirs, None)

    def _files_for(self, commit: Commit, dirs: Sequence[str]) -> int:
        """Files that the rows of some directories are clustered into: as few as stay below both sizes.

        Files are compressed, so their rows may take many times as much memory.
        """
        in_memory = _value_bytes(self._scan(commit, dirs))
        return max(1, -(-self._size(dirs) // TARGET_FILE_BYTES), -(-in_memory // SORTED_BYTES))

    def set_retention(self, log: str, deleted_files: str) -> Commit | None:
        """Record retention durations if they differ; the commit keeps the sync cursor."""
        wanted = {"log": log, "deleted_files": deleted_files}
        before = self._require()
        if before.retention == wanted:
            return None
        commit = self.ledger.next(
            before, op="SET RETENTION", retention=wanted, user_metadata=cursor_text(self.cursor())
        )
        return self.ledger.append(commit)

    # commit machinery ------------------------------------------------------------------

    def _collect_dirs(self, located: DataFrame, commit: Commit) -> set[str]:
        """Distinct directories of some rows of a commit; bounded by its files.

        Files with equal checksums stand for each other's directories, so one that holds none of
        the rows may be among them; that is rewritten as it is.
        """
        found = [self._dirs_by_sum[row[0]] for row in located.select(_DIR).distinct().collect()]
        return set().union(*found) & set(commit.dirs)

    def _dirs_of(self, commit: Commit, touched: DataFrame, column: str) -> list[str]:
        """Directories of a commit whose value of a partition column is touched.

        Told from their names alone, so nothing else is listed or opened. The names become a
        frame, whose values are joined with the touched ones: any number of them, of any type.
        """
        named = [(name, commit.value_of(name, column)) for name in commit.dirs]
        frame = self.spark.createDataFrame(named, "dir string, value string")
        kind = commit.struct[column].dataType
        values = touched.select(quoted(column).cast(kind).alias("_touched")).distinct()
        found = frame.join(values, F.col("value").cast(kind).eqNullSafe(F.col("_touched")), "left_semi")
        return [row["dir"] for row in found.select("dir").collect()]

    def _touched_slices(
        self, before: Commit, source: DataFrame, keys: Sequence[str], prefix: str, dirs: list[str] | None
    ) -> list[str] | None:
        """Of the directories, those of slices that the source's keys fall into, by their names."""
        if not before.slice_by or not set(before.slice_by) <= set(keys):
            return dirs
        named = [quoted(prefix + name).cast(before.struct[name].dataType) for name in before.slice_by]
        # no more rows than slices
        touched = {row[0] for row in source.select(_slice_number(named, before.slices).alias("s")).distinct().collect()}
        return [name for name in (before.dirs if dirs is None else dirs) if before.slice_of(name) in touched]

    def _compact(self, commit: Commit, written: Sequence[str]) -> None:
        """Join the small slices of the partitions just written to, where they are many."""
        crowded = self._crowded(commit, commit.dirs, written)
        small: set[str] = set()
        for names in crowded:
            few = [name for name in names if commit.sizes[name] < SMALL_SLICE_BYTES]
            small.update(few if len(few) > SMALL_SLICES else [])
        if small:
            rows = self._scan(commit, sorted(small))
            self._commit(commit, OPTIMIZE, small, self._put(rows, commit, redistribute=True), None)

    def _crowded(self, before: Commit, dirs: Sequence[str], written: Sequence[str]) -> list[list[str]]:
        """The slices of partitions written to that have many of them."""
        if not before.sliced:
            return []
        touched = {_place(before, name) for name in written}
        by_partition: dict[str, list[str]] = {}
        for name in dirs:
            partition = _place(before, name)
            if partition in touched:
                by_partition.setdefault(partition, []).append(name)
        return [names for names in by_partition.values() if len(names) > SMALL_SLICES]

    def _sizes(self, dirs: Sequence[str]) -> dict[str, int]:
        """Bytes of each directory; many are listed by Spark, not one by one."""
        paths = {f"{self.root}/{name}": name for name in dirs}
        if len(dirs) <= FEW_DIRS:
            return {name: self.ledger.files.size([path]) for path, name in paths.items()}
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
        parent = F.regexp_extract("path", f"({BATCH}=.*)/[^/]+$", 1)
        rows = files.groupBy(parent.alias("dir")).agg(F.sum("length").alias("bytes")).collect()
        found = {unquote(row["dir"]): row["bytes"] for row in rows}
        return {name: int(found.get(name, found.get(unquote(name), 0))) for name in dirs}

    def _size(self, dirs: Sequence[str]) -> int:
        """Bytes of some directories."""
        return sum(self._sizes(dirs).values())

    def _put(
        self, df: DataFrame, before: Commit, redistribute: bool, order: str | None = None
    ) -> list[str]:
        """Write rows in the table's types and layout to a new batch; its directories.

        Rows that lie mixed (`redistribute`) are first gathered by partition with a REBALANCE
        hint: adaptive execution then splits a partition value that holds much of the data
        over several tasks and joins small ones, so neither one huge task nor many tiny files
        result. Rows that come straight out of directories of this table need no gathering:
        each task holds few partitions already. `order` names a further column to sort files by.

        The batch gets a name that no other attempt uses, so leftovers of a crash are never
        mixed in.
        """
        columns = [quoted(f.name).cast(f.dataType).alias(f.name) for f in before.struct]
        rows = df.select(*columns, *([order] if order else []))
        if before.slice_by:
            rows = rows.withColumn(SLICE, _slice_number([quoted(name) for name in before.slice_by], before.slices))
        gathered = [*before.partition_by, *([SLICE] if before.slice_by else [])]
        if gathered and (redistribute or before.slice_by):
            rows = rows.hint("rebalance", *[quoted(name) for name in gathered])
        if before.sliced and not before.slice_by:
            number = F.floor(F.spark_partition_id() / TASKS_PER_SLICE).cast("int")
            rows = rows.withColumn(SLICE, number)
        if order:
            rows = rows.sortWithinPartitions(*[quoted(n) for n in before.layout], order).drop(order)
        name = f"{BATCH}={uuid.uuid4().hex}"
        writer = rows.write.partitionBy(*before.layout) if before.layout else rows.write
        with shuffles_removed(df.sparkSession):
            writer.parquet(f"{self.root}/{name}")
        if not before.layout:
            return [name]
        found = self.ledger.files.directories(f"{self.root}/{name}" + "/*=*" * len(before.layout))
        return sorted(path[len(self.root) + 1 :] for path in found)

    def _commit(
        self,
        before: Commit,
        op: str,
        replaced: set[str],
        new_dirs: list[str],
        version: int | None,
        **marks,
    ) -> Commit:
        """List the new directories instead of the replaced ones."""
        unknown = replaced - set(before.dirs)
        if unknown:
            raise RuntimeError(f"directories not in commit {before.commit}: {sorted(unknown)[:3]}")
        dirs = [name for name in before.dirs if name not in replaced] + new_dirs
        sizes = marks.get("sizes", before.sizes)
        marks["sizes"] = {name: sizes[name] for name in dirs if name in sizes}
        if marks.get("stream") is not None:
            marks["streams"] = {**before.streams, marks["stream"]: marks["batch"]}
        commit = self.ledger.next(
            before, op=op, dirs=dirs, user_metadata=cursor_text(version), **marks
        )
        return self.ledger.append(commit)


class _Side:
    """The D rows, or the I and U rows, of a batch, by a key of the target."""

    def __init__(self, source: DataFrame, keys: Sequence[str], before: Commit):
        self.prefixed = actual_names([CHANGE_KEY_PREFIX + key for key in keys], source.columns)
        self.keys = actual_names(keys, before.struct.names)
        named = dict(zip(self.prefixed, [CHANGE_KEY_PREFIX + key for key in self.keys], strict=True))
        self.source = source.withColumnsRenamed(named)
        self.prefixed = list(named.values())
        self.facts = measure_keys(self.source, self.prefixed)

    def sent_keys(self) -> DataFrame:
        return _merge_keys(self.source, self.prefixed, self.keys, self.facts.few_keys)

    def all_keys(self) -> DataFrame:
        """Each of the keys once."""
        keys = _merge_keys(self.source, self.prefixed, self.keys, False)
        return keys if self.facts.max_per_key == 1 else keys.distinct()

    def few_keys(self, passes: int) -> bool:
        """Whether the keys of one of some passes may be sent to all tasks; parts are only about equal."""
        return self.facts.few_keys if passes == 1 else self.facts.key_bytes * 4 // (3 * passes) <= predicates.BROADCAST_BYTES

    def hashed_alike(self, before: Commit, by: Sequence[str]) -> bool:
        types = dict(zip(self.keys, self.facts.types))
        return _hashed_alike([types[key] for key in by], before, by)


def _merge_keys(
    source: DataFrame, prefixed: Sequence[str], keys: Sequence[str], small: bool
) -> DataFrame:
    """Non-NULL keys of a source under the target's names, for broadcast if measured small."""
    named = source.select([quoted(p).alias(k) for p, k in zip(prefixed, keys)]).dropna()
    return F.broadcast(named) if small else named


def _skip_by_bounds(located: DataFrame, keys: Sequence[str], facts: SourceKeys) -> DataFrame:
    """Target rows within the range of the source's keys.

    The constants reach the scan, which skips files and row groups outside the range; a load
    of recent keys then does not read the keys of the whole table.
    """
    return located.where(_within_bounds(located, keys, facts))


def _within_bounds(located: DataFrame, keys: Sequence[str], facts: SourceKeys) -> Column:
    types = {field.name: field.dataType for field in located.schema}
    inside = F.lit(True)
    for key, source_type, (low, high) in zip(keys, facts.types, facts.bounds):
        if low is not None and _same_order(source_type, types[key]):
            inside = inside & (quoted(key) >= F.lit(low)) & (quoted(key) <= F.lit(high))
    return inside


def _same_order(source: DataType, target: DataType) -> bool:
    """Whether source values, as literals, compare with target values as they do in the source."""
    return any(isinstance(source, t) and isinstance(target, t) for t in _BOUNDED_TYPES)


def _matched_rows(located: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key and directory of every target row whose key the source has.

    Reads key columns only. Nothing follows the join, so with a broadcast there is no shuffle,
    and otherwise adaptive execution may split a key that many target rows share.
    """
    return located.select([quoted(key) for key in keys] + [_DIR]).join(
        source_keys, list(keys), "left_semi"
    )


def _value_bytes(df: DataFrame) -> int:
    """About the size of a frame's values in memory."""
    return int(df.agg(F.sum(value_bytes(df.schema))).first()[0] or 0)


def _hashed_alike(types: Sequence[DataType], commit: Commit, keys: Sequence[str]) -> bool:
    """Whether source keys of these types have the hashes of the target keys that they equal."""
    return all(
        kind == commit.struct[key].dataType and (isinstance(kind, _HASHED_TYPES) or kind == StringType())
        for kind, key in zip(types, keys)
    )


def _passes(n_bytes: int, places: int = 0) -> int:
    """Passes in which rows of some bytes are shuffled, and written to some partitions."""
    wanted = min(MAX_PASSES, -(-n_bytes // PASS_BYTES))
    return max(1, min(wanted, n_bytes // (places * PLACE_BYTES)) if places else wanted)


def _part(df: DataFrame, by: Sequence[str], number: int, passes: int) -> DataFrame:
    """The rows of one of several passes: equal values of the columns `by` are in the same one."""
    return df if passes == 1 else df.where(_slice_number([quoted(name) for name in by], passes) == number)


def _slice_number(columns: Sequence[Column], slices: int) -> Column:
    """The slice of a row by its key."""
    return F.pmod(F.xxhash64(*columns), F.lit(slices)).cast("int")


def _place(commit: Commit, directory: str) -> str:
    """What a row does not leave when it is rewritten: its partition, and its slice if that is hashed."""
    partition = commit.partition_of(directory) if commit.partition_by else ""
    return f"{partition}/{commit.slice_of(directory)}" if commit.slice_by else partition


def _places(commit: Commit) -> int:
    """How many places a commit has."""
    return max(1, len({_place(commit, name) for name in commit.dirs}))


def _same_partitions(before: Commit, written) -> set[str]:
    """Directories of a commit whose last partition value occurs among the written ones."""
    if not before.partition_by:
        return set(before.dirs)
    values = {before.partition_of(name) for name in written}
    return {name for name in before.dirs if before.partition_of(name) in values}


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema])
