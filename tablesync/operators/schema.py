"""Column-name comparison between source and target."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.shape import quoted


class SchemaMismatchError(ValueError):
    """Source and target do not have the same column names."""


def require_same_columns(source: Iterable[str], target: Iterable[str]) -> None:
    """Raise `SchemaMismatchError` unless both name sets are equal (case matters, types do not)."""
    difference = set(source) ^ set(target)
    if difference:
        raise SchemaMismatchError(f"columns on one side only: {sorted(difference)}")


def catalog_difference(
    source: DataFrame, target: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Entries found in only one of two column catalogs, with `side` source or target.

    Both catalogs are unioned and grouped once, with a map-side combine.
    """
    names = [quoted(name) for name in columns]
    sides = source.select(*names, F.lit(1).alias("_source"), F.lit(0).alias("_target")).unionByName(
        target.select(*names, F.lit(0).alias("_source"), F.lit(1).alias("_target"))
    )
    seen = sides.groupBy(names).agg(F.max("_source").alias("_s"), F.max("_target").alias("_t"))
    side = F.when(F.col("_s") > F.col("_t"), "source").otherwise("target")
    return seen.where("_s <> _t").select(*names, side.alias("side"))
