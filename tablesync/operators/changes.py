"""Change rows: net changes of a log, the change feed, snapshot differences, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    MapType,
    StructType,
    TimestampType,
    VariantType,
)

from tablesync.operators.merge import DuplicateKeyError
from tablesync.operators.predicates import (
    CHANGE_KEY_PREFIX,
    CHANGE_OP,
    broadcast_if_small,
    is_delete,
    is_write,
)
from tablesync.operators.shape import actual_names, quoted
from tablesync.sinks.files import stage


class CursorExpiredError(ValueError):
    """The target's cursor is older than what the source can still answer."""


def change_key(name: str) -> str:
    """Name of the change column that carries key `name`."""
    return CHANGE_KEY_PREFIX + name


def pk_alias_projection(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    """The key columns under their change names, and `others` unchanged."""
    aliased = [quoted(key).alias(change_key(key)) for key in keys]
    return df.select(*[quoted(name) for name in others], *aliased)


def net_changes(
    log: DataFrame,
    keys: Sequence[str],
    version: str,
    op: str,
    last: int,
    current: int,
) -> DataFrame:
    """One row `(keys, version, _op)` per key: its latest change after `last`, up to `current`.

    The latest change is found first and compared with `current` afterwards, so a key that
    changes again later is left to the next run. Operations are I, U and D. The latest
    operation is read off three maxima of the version, which a hash aggregate keeps in fixed
    space and combines before the shuffle, however many changes one key has; should one
    version hold several changes of a key, D counts before I and I before U.
    """
    names = [quoted(key) for key in keys]
    number = quoted(version)
    latest = (
        log.where(number > last)
        .groupBy(names)
        .agg(
            F.max(number).alias("_latest"),
            F.max(F.when(quoted(op) == "D", number)).alias("_deleted"),
            F.max(F.when(quoted(op) == "I", number)).alias("_inserted"),
        )
        .where(F.col("_latest") <= current)
    )
    operation = (
        F.when(F.col("_deleted") == F.col("_latest"), "D")
        .when(F.col("_inserted") == F.col("_latest"), "I")
        .otherwise("U")
    )
    return latest.select(*names, F.col("_latest").alias(version), operation.alias(CHANGE_OP))


def change_feed(
    base: DataFrame, net: DataFrame, keys: Sequence[str], broadcast_keys: bool = False
) -> DataFrame:
    """Base columns, `_op` and `_pk_<key>` for every net change; base columns NULL if gone.

    The base is first cut down to the changed keys by a semi-join, and only what is left takes
    part in the outer join. `broadcast_keys` says that the keys were measured to be small, so
    that the base is not shuffled; otherwise Spark decides by its own estimate.
    """
    changes = pk_alias_projection(net, keys, CHANGE_OP)
    condition = [quoted(key) == quoted(change_key(key)) for key in keys]
    wanted = pk_alias_projection(net, keys)
    current = base.join(F.broadcast(wanted) if broadcast_keys else wanted, condition, "left_semi")
    joined = changes.join(current, condition, "left")
    return joined.select(
        *[quoted(name) for name in base.columns],
        quoted(CHANGE_OP),
        *[quoted(change_key(key)) for key in keys],
    )


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """256 bits that tell rows apart by the given columns, nulls included.

    Each value is written as text behind its length, so no two rows have the same text: doubles with
    -0.0 as 0.0, instants in microseconds, nested values as JSON (maps in the order of their entries).
    """
    parts = []
    for name in columns:
        kind, value = df.schema[name].dataType, quoted(name)
        if isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            spelled = F.to_json(F.struct(value), _EXACT_JSON)
        elif isinstance(kind, (DoubleType, FloatType)):
            spelled = (value + F.lit(0.0).cast(kind)).cast("string")
        elif isinstance(kind, TimestampType):
            spelled = F.unix_micros(value).cast("string")
        elif isinstance(kind, BinaryType):
            spelled = F.hex(value)
        else:
            spelled = value.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(spelled).cast("string"), F.lit(":"), spelled)))
    return F.unhex(F.sha2(F.concat(F.lit(""), *parts), 256))


_EXACT_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows that turn `old` into `new`: I, U and D with `_pk_<key>` columns.

    Both sides meet as keys and digests of the other columns, in one narrow hash aggregate. What
    differs is written down; a key that a snapshot repeats raises `DuplicateKeyError` then. Whole rows
    are read only of `new`, and only joined with the keys that differ, which are sent to it if
    measured to be few. Columns are compared null-safely, in the type that both sides have in common.
    Rows with a NULL key match nothing: they are listed as deleted and inserted, without joining.
    """
    names = new.columns
    keys = actual_names(keys, names)
    others = [name for name in names if name not in set(keys)]
    common = old.select([quoted(n) for n in names]).unionByName(new).schema
    keyless = " or ".join(f"`{key}` is null" for key in keys)
    sides = []
    for number, snapshot in enumerate((old, new)):
        alike = snapshot.where(f"not ({keyless})").select([quoted(n).cast(common[n].dataType).alias(n) for n in names])
        sides.append(alike.select(*[quoted(key) for key in keys], F.lit(number).alias("_side"), row_digest(alike, others).alias("_digest")))
    mine = [F.when(F.col("_side") == number, F.col("_digest")) for number in (0, 1)]
    met = sides[0].unionByName(sides[1]).groupBy([quoted(key) for key in keys]).agg(
        *[F.count(side).alias(f"_n{number}") for number, side in enumerate(mine)],
        *[F.max(side).alias(f"_d{number}") for number, side in enumerate(mine)],
    )
    operation = F.when(F.col("_n1") == 0, "D").when(F.col("_n0") == 0, "I").when(F.col("_d0") != F.col("_d1"), "U")
    told = met.select(*[quoted(key) for key in keys], operation.alias(CHANGE_OP), F.greatest("_n0", "_n1").alias("_rows"))
    told = stage(told.where(F.col(CHANGE_OP).isNotNull() | (F.col("_rows") > 1)), "snapshot-keys")
    repeated = told.where("_rows > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"a snapshot repeats {list(keys)}, e.g. {repeated[0]}")

    changed = told.select(*[quoted(key).alias(change_key(key)) for key in keys], quoted(CHANGE_OP))
    written = broadcast_if_small(changed.where(is_write()))
    condition = [quoted(key) == quoted(change_key(key)) for key in keys]
    order = [*[quoted(name) for name in names], quoted(CHANGE_OP), *[quoted(change_key(key)) for key in keys]]
    found = new.join(written, condition).select(order)
    nothing = [F.lit(None).cast(new.schema[name].dataType).alias(name) for name in names]
    dropped = changed.where(is_delete()).select(*nothing, quoted(CHANGE_OP), *order[-len(keys) :])
    gone, added = (
        side.where(keyless).select(*columns, F.lit(op).alias(CHANGE_OP), *[quoted(key).alias(change_key(key)) for key in keys])
        for side, columns, op in ((old, nothing, "D"), (new, [quoted(name) for name in names], "I"))
    )
    return found.unionByName(dropped).unionByName(gone).unionByName(added)


def change_counts(changes: DataFrame) -> DataFrame:
    """Number of change rows per operation."""
    return changes.groupBy(CHANGE_OP).agg(F.count(F.lit(1)).alias("n_changes"))


def source_versions(log: DataFrame, version: str, by: Sequence[str] = ()) -> DataFrame:
    """`current_version` and `min_valid_version` of a change log, overall or per group.

    The oldest change present can be answered for a cursor just before it.
    """
    return log.groupBy([quoted(name) for name in by]).agg(
        F.max(quoted(version)).alias("current_version"),
        (F.min(quoted(version)) - 1).alias("min_valid_version"),
    )


def capped_current_version(current: Column, last: Column, window: int) -> Column:
    """`current`, or `last + window` if that is lower; a negative window sets no cap.

    Without a `last` (no target yet) there is no cap either.
    """
    return F.least(current, last + window) if window >= 0 else current


def capped_version(current: int, last: int | None, window: int) -> int:
    """`capped_current_version` for driver-side scalars."""
    return current if window < 0 or last is None else min(current, last + window)


def cursor_is_valid(last: Column, min_valid: Column) -> Column:
    """Whether the source can still list the changes since `last`."""
    return last >= min_valid


def require_valid_cursor(last: int, min_valid: int) -> None:
    """Raise `CursorExpiredError` when changes since `last` are no longer all available."""
    if last < min_valid:
        raise CursorExpiredError(
            f"the target stands at version {last}, the source answers from {min_valid}: "
            "the target must be reinitialized"
        )
