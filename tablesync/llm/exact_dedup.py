"""Exact duplicates found by comparing content-defined chunk recipes.

Every text is cut at places that its content decides. A chunk is named by its digest, a
document by the ordered list of its chunks' names (the recipe). One pass moves each distinct
chunk once and verifies that no name stands for two different chunks; from then on only
recipes are moved and compared, however long the documents are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import ascii_lower, quoted
from tablesync.sinks.files import stage

#: A chunk ends after white space or punctuation that follows a pair of these characters.
BOUNDARY = r"(?<=[aeiou0-4Ѐ-Р一-怀][b-dg-nr-t5-9С-р态-耀][\s.,;:])"


def digest(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunks(text: Column, smallest: int = 320, largest: int = 8192) -> Column:
    """The text cut into content-defined chunks; their concatenation is the text."""
    pattern = rf"(?s).{{{smallest},{largest}}}?{BOUNDARY}|(?s).{{1,{largest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def clashing_names(texts: DataFrame, name: Callable[[Column], Column] = digest) -> DataFrame:
    """Chunk names that stand for more than one chunk of the column `_norm`.

    Distinct chunks are combined before they are shuffled, so a chunk that many documents
    share costs one row per task.
    """
    pieces = texts.select(F.explode(chunks(F.col("_norm"))).alias("chunk"))
    named = pieces.select(name(F.col("chunk")).alias("name"), "chunk").distinct()
    return named.groupBy("name").count().filter("count > 1").select("name")


def recipes(texts: DataFrame, name: Callable[[Column], Column] = digest) -> DataFrame:
    """`texts` (columns `_row` and `_norm` among others) with `_recipe` in the place of `_norm`.

    A name found to stand for several chunks is followed by the chunk itself in the recipes,
    so that equal recipes always mean equal texts.
    """
    named = texts.withColumn("_recipe", F.transform(chunks(F.col("_norm")), name))
    clashes = stage(clashing_names(texts, name), "clashing-chunks")
    if clashes.isEmpty():
        return named.drop("_norm")
    steps = named.select("_row", F.posexplode(F.arrays_zip("_recipe", chunks(F.col("_norm")).alias("chunk"))).alias("at", "step"))
    steps = steps.select("_row", "at", F.col("step._recipe").alias("name"), F.col("step.chunk").alias("chunk"))
    marked = steps.join(clashes.withColumn("_clash", F.lit(True)), "name", "left")
    told = F.when(F.col("_clash"), F.concat("name", F.col("chunk").cast("binary"))).otherwise(F.col("name"))
    full = marked.groupBy("_row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", told.alias("name")))), lambda s: s["name"]).alias("_full")
    )
    return named.drop("_norm").join(full, "_row", "left").withColumn(
        "_recipe", F.coalesce("_full", "_recipe")
    ).drop("_full")


def exact_duplicates(
    docs: DataFrame,
    carry: Sequence[str] | None = None,
    name: Callable[[Column], Column] = digest,
) -> DataFrame:
    """Each row of `docs` with what became of it: keep_id, group_size, kept, text_sha256.

    `docs` needs the columns doc_id and text; `carry` names the columns to return besides
    doc_id (default: all), columns of the four names are replaced.

    Texts are equal if they are identical once A-Z are lower-cased; a null text counts as
    empty, and empty texts are equal. Of equal texts the row with the largest doc_id stays;
    a null doc_id is smaller than any. Of rows that share text and doc_id, one stays.
    An empty table gives an empty table.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    columns = [c for c in (docs.columns if carry is None else ["doc_id", *carry]) if c not in added]
    norm = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    source = docs.select(
        *quoted(columns), norm.alias("_norm"), F.monotonically_increasing_id().alias("_row")
    )
    slim = stage(
        recipes(source.withColumn("text_sha256", F.sha2("_norm", 256)), name), "recipes"
    )
    best = F.max(F.struct("doc_id", "_row"))
    groups = slim.groupBy("_recipe").agg(best.alias("_best"), F.count("*").alias("group_size"))
    several = stage(groups.filter("group_size > 1"), "recipe-groups")
    found = slim.join(several, "_recipe", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        *quoted(columns),
        F.when(alone, F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("_row") == F.col("_best._row"))).alias("kept"),
        "text_sha256",
    )
