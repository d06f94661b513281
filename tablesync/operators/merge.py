"""Merges as joins over whole frames.

A merge never needs a full outer join here. The source is staged and measured first: one
aggregation tells whether a key repeats, which raises `DuplicateKeyError`, and whether its rows are
few enough to be sent to the target. A keys-only pass then writes down which source keys the
target has. The merged rows follow from one scan of the target, left-joined with the source, so
a source row that matches several target rows replaces each of them, and from the source rows
whose key was not written down. A key on many target rows is spread by adaptive execution like any
skewed join. `target_keys_unique=True` states that no key repeats; then the target just loses the
touched keys and gains the source's rows, without the pass over its keys.

NULL keys match nothing on either side: such target rows stay, such source rows are inserted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType, VariantType

from tablesync.operators import predicates
from tablesync.operators.predicates import (
    CHANGE_KEY_PREFIX,
    CHANGE_OP,
    as_column,
    broadcast_if_small,
    in_touched_partitions,
    is_delete,
    is_write,
    not_in_touched_partitions,
    touched_partitions,
)
from tablesync.operators.shape import actual_names, quoted
from tablesync.sinks.files import stage


class DuplicateKeyError(ValueError):
    """Several source rows carry the same merge key."""


class ReplaceScopeError(ValueError):
    """A source row lies outside the predicate of a selective overwrite."""


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once, with their `count`.

    Counts are combined before the shuffle, so a key with very many rows is cheap.
    """
    complete = source.select([quoted(key) for key in keys]).dropna()
    return complete.groupBy([quoted(key) for key in keys]).count().where("count > 1")


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise `DuplicateKeyError` when a merge from `source` would be ambiguous."""
    example = duplicate_keys(source, keys).limit(1).collect()
    if example:
        raise DuplicateKeyError(f"source rows are not unique on {list(keys)}, e.g. {example[0]}")


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key: the one with the highest `version` (rows with a NULL key all stay).

    Hash aggregates with map-side combine, and a join, rather than a window: one hot key does
    not put all its rows into one task, and full-width rows are not sorted. Only rows that tie
    for the highest version are compared as a whole, maps by their JSON text: the greatest in
    column order wins.
    """
    keys = actual_names(keys, df.columns)
    version = actual_names([version], df.columns)[0]
    names = [quoted(key) for key in keys]
    columns = [quoted(name) for name in df.columns]
    keyless = " or ".join(f"`{key}` is null" for key in keys)
    keyed = df.where(f"not ({keyless})")
    counts = keyed.groupBy(*names, quoted(version).alias("_top")).agg(F.count(F.lit(1)).alias("_rows"))
    top = counts.groupBy(names).agg(F.max("_top").alias("_top"), F.max_by("_rows", "_top").alias("_rows"))
    found = keyed.join(top, keys).where(quoted(version).eqNullSafe(F.col("_top")))
    # a key whose versions are all NULL has no count
    single = F.coalesce(F.col("_rows"), F.lit(2)) == 1
    tied = found.where(~single).select(*columns, _comparable(df).alias("_whole"))
    greatest = tied.groupBy(names).agg(F.max("_whole").alias("_greatest"))
    settled = tied.join(greatest, keys).where("_whole = _greatest")
    settled = settled.groupBy(columns).agg(F.count(F.lit(1))).select(columns)
    return found.where(single).select(columns).unionByName(settled).unionByName(df.where(keyless))


def _comparable(df: DataFrame) -> Column:
    """The row as a struct that can be ordered."""
    return F.struct(
        *[
            (F.to_json(F.struct(quoted(field.name))) if _has_map(field.dataType) else quoted(field.name))
            .alias(field.name)
            for field in df.schema
        ]
    )


def _has_map(data_type: DataType) -> bool:
    if isinstance(data_type, ArrayType):
        return _has_map(data_type.elementType)
    if isinstance(data_type, StructType):
        return any(_has_map(field.dataType) for field in data_type)
    return isinstance(data_type, MapType)


def _renamed_keys(source: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return source.select([quoted(prefix + key).alias(key) for key in keys])


@dataclass(frozen=True)
class SourceKeys:
    """Measured facts about a merge source and its keys."""

    n_rows: int
    max_per_key: int
    key_bytes: int
    row_bytes: int
    counts: dict[str, int]
    bounds: list[tuple]
    types: list[DataType]

    @property
    def few_keys(self) -> bool:
        """Whether the keys may be sent to all tasks."""
        return self.key_bytes <= predicates.BROADCAST_BYTES

    @property
    def few_rows(self) -> bool:
        """Whether whole rows may be."""
        return self.row_bytes <= predicates.BROADCAST_BYTES


def measure_keys(source: DataFrame, keys: Sequence[str]) -> SourceKeys:
    """Rows, highest count of a non-NULL key, size of keys and rows, bounds of the keys and, for change
    rows, the number of rows per operation, in one aggregation.

    The per-key facts are combined before the shuffle. Sizes are those of `value_bytes`.
    """
    operations = ("I", "U", "D") if CHANGE_OP in source.columns else ()
    names = [quoted(key) for key in keys]
    any_null = F.lit(False)
    for name in names:
        any_null = any_null | name.isNull()
    per_key = source.groupBy(names).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(value_bytes(source.schema)).alias("_row_bytes"),
        *[F.count_if(F.col(CHANGE_OP) == op).alias(f"_n_{op}") for op in operations],
    )
    row = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max(F.when(~any_null, F.col("_n"))), F.lit(0)).alias("max_per_key"),
        F.coalesce(F.sum(value_bytes(source.select(names).schema) * F.col("_n")), F.lit(0)).alias("key_bytes"),
        F.coalesce(F.sum("_row_bytes"), F.lit(0)).alias("row_bytes"),
        *[F.coalesce(F.sum(f"_n_{op}"), F.lit(0)).alias(f"_n_{op}") for op in operations],
        *[F.min(name).alias(f"_low_{i}") for i, name in enumerate(names)],
        *[F.max(name).alias(f"_high_{i}") for i, name in enumerate(names)],
    ).first()
    return SourceKeys(
        int(row["n_rows"]),
        int(row["max_per_key"]),
        int(row["key_bytes"]),
        int(row["row_bytes"]),
        {op: int(row[f"_n_{op}"]) for op in operations},
        [(row[f"_low_{i}"], row[f"_high_{i}"]) for i in range(len(names))],
        [field.dataType for field in source.select(names).schema],
    )


def value_bytes(schema: StructType) -> Column:
    """About the size of the values of a row in memory: 16 bytes for each, and 8 for what has a fixed
    width or else its length, as text if it is nested."""
    width = F.lit(0).cast("long")
    for field in schema:
        kind, value = field.dataType, quoted(field.name)
        if isinstance(kind, (StringType, BinaryType)):
            size = F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            size = F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
        else:
            size = F.lit(8)
        width = width + size + 16
    return width


def measured_source(source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, SourceKeys]:
    """The source staged, and its facts; raises `DuplicateKeyError` if the merge would be ambiguous."""
    source = stage(source, "merge-source")
    facts = measure_keys(source, keys)
    if facts.max_per_key > 1:
        raise DuplicateKeyError(f"source rows are not unique on {list(keys)}")
    return source, facts


def _sent(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def matched_keys(target: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key of every target row that the source touches, once per row."""
    return target.select([quoted(key) for key in keys]).join(source_keys, list(keys), "left_semi")


def _keyless(source: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Whether a source row lacks a part of its key."""
    return reduce(or_, [quoted(prefix + key).isNull() for key in keys])


def _merge_side(source: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Source rows with a whole key, in the one form that both joins of a merge take, so that Spark shuffles
    them once for the two."""
    names = sorted(drop_change_columns(source).columns if prefix else source.columns)
    extra = [F.coalesce(is_delete(), F.lit(False)).alias("_merge_gone")] if prefix else []
    return source.where(~_keyless(source, keys, prefix)).select(
        *[quoted(prefix + key).alias(f"_merge_key_{i}") for i, key in enumerate(keys)],
        *[quoted(name).alias(f"_merge_new_{name}") for name in names],
        *extra,
    )


def each_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of some rows, each once; grouped in their order, so that a join by them shuffles no more."""
    names = [quoted(key) for key in keys]
    return df.groupBy(names).agg(F.count(F.lit(1))).select(names)


def updated_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    prefix: str = "",
    small: bool = False,
    deletes: bool = True,
) -> DataFrame:
    """Target rows, each replaced by the source row of its key, if any; rows that a change row deletes go.

    `prefix` is that of the source's key columns, for change rows, of which `deletes` says whether any
    deletes; `small` says that the source was measured to be so.
    """
    side = _merge_side(source, keys, prefix)
    condition = [quoted(key) == F.col(f"_merge_key_{i}") for i, key in enumerate(keys)]
    joined = target.join(_sent(side, small), condition, "left")
    if prefix and deletes:
        joined = joined.where(~F.coalesce("_merge_gone", F.lit(False)))
    hit = F.col("_merge_key_0").isNotNull()
    return joined.select(
        *[F.when(hit, quoted(f"_merge_new_{name}")).otherwise(quoted(name)).alias(name) for name in target.columns]
    )


def inserted_rows(
    source: DataFrame, hits: DataFrame, keys: Sequence[str], prefix: str = "", small: bool = False
) -> DataFrame:
    """Source rows whose key is not among `hits`, the keys that the target has, each once; of change rows
    those that insert or update."""
    source = source.where(is_write()) if prefix else source
    names = drop_change_columns(source).columns if prefix else source.columns
    known = hits.select([quoted(key).alias(f"_hit_{i}") for i, key in enumerate(keys)])
    if small:
        condition = [quoted(prefix + key) == F.col(f"_hit_{i}") for i, key in enumerate(keys)]
        absent = source.join(F.broadcast(known), condition, "left_anti")
        return absent.select([quoted(name) for name in names])
    # an outer join, as Spark would move an anti join below the columns that the other join is to share
    condition = [F.col(f"_merge_key_{i}") == F.col(f"_hit_{i}") for i in range(len(keys))]
    absent = _merge_side(source, keys, prefix).join(known, condition, "left").where("_hit_0 is null")
    return absent.select([quoted(f"_merge_new_{name}").alias(name) for name in names]).unionByName(
        source.where(_keyless(source, keys, prefix)).select([quoted(name) for name in names])
    )


def _merged(
    target: DataFrame, source: DataFrame, facts: SourceKeys, keys: Sequence[str], prefix: str
) -> DataFrame:
    """The target after a merge with a measured source; the target's keys are read now, its rows later."""
    source_keys = _sent(_renamed_keys(source, keys, prefix), facts.few_keys)
    hits = stage(matched_keys(target, source_keys, keys).distinct(), "matched-keys")
    deletes = bool(facts.counts.get("D"))
    return updated_rows(target, source, keys, prefix, facts.few_rows, deletes).unionByName(
        inserted_rows(source, hits, keys, prefix, facts.few_keys)
    )


def drop_change_columns(changes: DataFrame) -> DataFrame:
    """Change rows reduced to the base columns."""
    extra = [name for name in changes.columns if name.startswith(CHANGE_KEY_PREFIX)]
    return changes.drop(CHANGE_OP, *extra)


def delete_keys(target: DataFrame, keys_to_delete: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not among `keys_to_delete`."""
    return target.join(keys_to_delete, list(keys), "left_anti").select(
        [quoted(name) for name in target.columns]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    target_keys_unique: bool = False,
    source_partitions_only: str | None = None,
) -> DataFrame:
    """Target after updating every matched row and inserting every unmatched source row.

    Rows are never deleted. `source_partitions_only` names a partition column and restores an
    older rule: only target rows in the partition values of the source can match, so a row
    whose partition value changed stays behind next to its new version.
    """
    if source_partitions_only:
        touched = broadcast_if_small(touched_partitions(source, source_partitions_only))
        inside = in_touched_partitions(target, touched, source_partitions_only)
        outside = not_in_touched_partitions(target, touched, source_partitions_only)
        return upsert(inside, source, keys, target_keys_unique).unionByName(outside)
    source, facts = measured_source(source, keys)
    if target_keys_unique:
        touched = _sent(_renamed_keys(source, keys, ""), facts.few_keys)
        return delete_keys(target, touched, keys).unionByName(source)
    return _merged(target, source, facts, keys, "")


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    target_keys_unique: bool = False,
) -> DataFrame:
    """Target after a batch of change rows (`_op` in I, U, D and one `_pk_<key>` per key).

    Deletes of absent rows do nothing; updates of absent rows insert.
    """
    changes, facts = measured_source(changes, [CHANGE_KEY_PREFIX + key for key in keys])
    if target_keys_unique:
        touched = _sent(_renamed_keys(changes, keys, CHANGE_KEY_PREFIX), facts.few_keys)
        return delete_keys(target, touched, keys).unionByName(drop_change_columns(changes.where(is_write())))
    return _merged(target, changes, facts, keys, CHANGE_KEY_PREFIX)


def apply_parent_child_changes(
    target: DataFrame,
    changes: DataFrame,
    primary_key: Sequence[str],
    parent_key: Sequence[str],
    target_keys_unique: bool = False,
) -> DataFrame:
    """Delete all rows of the parents that occur in D rows, then upsert the I and U rows."""
    changes = stage(changes, "merge-source")
    writes, deletes = changes.where(is_write()), changes.where(is_delete())
    facts = measure_keys(writes, [CHANGE_KEY_PREFIX + key for key in primary_key])
    if facts.max_per_key > 1:
        raise DuplicateKeyError(f"source rows are not unique on {list(primary_key)}")
    parents = broadcast_if_small(_renamed_keys(deletes, parent_key, CHANGE_KEY_PREFIX).dropna().distinct())
    left = delete_keys(target, parents, parent_key)
    if target_keys_unique:
        touched = _sent(_renamed_keys(writes, primary_key, CHANGE_KEY_PREFIX), facts.few_keys)
        return delete_keys(left, touched, primary_key).unionByName(drop_change_columns(writes))
    return _merged(left, writes, facts, primary_key, CHANGE_KEY_PREFIX)


def replace_where(
    target: DataFrame,
    source: DataFrame,
    scope: Column | str,
    partition_column: str | None = None,
    check: bool = True,
) -> DataFrame:
    """Target with the rows in `scope` replaced by the source rows.

    With a partition column, only rows in partitions that occur in the source are replaced.
    `check` raises when a source row itself lies outside the scope.
    """
    in_scope = F.coalesce(as_column(scope), F.lit(False))
    if check:
        require_in_scope(source, in_scope)
    if partition_column is None:
        return target.where(~in_scope).unionByName(source)
    touched = broadcast_if_small(
        touched_partitions(source, partition_column).select(
            quoted(partition_column).alias("_touched"), F.lit(True).alias("_is_touched")
        )
    )
    marked = target.join(touched, quoted(partition_column).eqNullSafe(F.col("_touched")), "left")
    kept = marked.where(~(in_scope & F.coalesce("_is_touched", F.lit(False))))
    return kept.select([quoted(name) for name in target.columns]).unionByName(source)


def require_in_scope(source: DataFrame, scope: Column | str) -> None:
    """Raise `ReplaceScopeError` when a source row does not fulfil the overwrite's predicate."""
    outside = source.where(~F.coalesce(as_column(scope), F.lit(False))).limit(1).collect()
    if outside:
        raise ReplaceScopeError(f"source row outside the replaced range: {outside[0]}")
