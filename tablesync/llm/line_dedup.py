"""Lines that many documents share, dropped from all of them but one.

Only digests of lines travel. They are range-partitioned with their documents, and sorted in each
partition by digest, document and position, so that a single pass over sorted rows sees where each
document's first occurrence of a line stands: it starts documents' counts and finds the one that
keeps the line. What comes back to a document is no text but a bitmap of the lines that it keeps,
as run lengths; whoever has the text applies it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import ascii_lower, quoted
from tablesync.sinks.files import stage

#: Parts that the documents of one line are dealt to, so that a line which a third of all
#: documents hold spreads over as many ranges.
PARTS = 256
#: Shared lines that are sent to all tasks (at most about 64 bytes each); with more of them the rows are
#: joined by a shuffle.
BROADCAST_KEYS = 500_000
# Fixed value: the white space that is stripped from both ends of a line, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """What makes lines alike: blanks at both ends gone, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def text_key() -> Column:
    """Tells rows that share a doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _lines() -> Column:
    return F.split(F.coalesce("text", F.lit("")), "\n")


def line_digests(docs: DataFrame, least_chars: int) -> DataFrame:
    """digest, part, doc_id, text_key, at: one row for each line whose key is long enough.

    The digest is half of a SHA-256, so no two keys of a corpus share one, made up or not.
    """
    told = docs.select("doc_id", text_key().alias("text_key"), F.posexplode(_lines()).alias("at", "line"))
    keyed = told.select("doc_id", "text_key", "at", line_key(F.col("line")).alias("key"))
    digest = F.unhex(F.substring(F.sha2("key", 256), 1, 32))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("short")
    return keyed.filter(F.char_length("key") >= least_chars).select(
        digest.alias("digest"), part.alias("part"), "doc_id", "text_key", "at"
    )


def first_occurrences(rows: DataFrame) -> DataFrame:
    """The digest rows with `first`: whether the row is its document's first of that digest.

    Rows go to ranges of (digest, part). A range has its rows sorted by digest, part, then document,
    the largest first, then position; the window follows that order and deals nothing anew.
    """
    ranged = rows.repartitionByRange("digest", "part")
    order = Window.partitionBy("digest", "part").orderBy(F.desc_nulls_last("doc_id"), "at", "text_key")
    before = F.lag(F.struct("doc_id")).over(order)
    return ranged.withColumn("first", before.isNull() | ~before["doc_id"].eqNullSafe(F.col("doc_id")))


def shared_lines(rows: DataFrame, least_docs: int) -> DataFrame:
    """digest and best, the largest doc_id that holds it, of digests found in enough documents.

    The counts of a range are combined before they meet: one row for each digest in it.
    """
    counted = rows.groupBy("digest").agg(F.count_if("first").alias("docs"), F.max("doc_id").alias("best"))
    return counted.filter(F.col("docs") >= least_docs).select("digest", "best")


def varint(value: Column) -> Column:
    """A number below 2^35 as hex digits of 7-bit groups, highest first; all but the last group
    have their top bit set."""
    number = value.cast("bigint")
    out = F.lit("")
    for shift in (28, 21, 14, 7, 0):
        group = F.shiftright(number, shift).bitwiseAND(F.lit(127))
        byte = F.lpad(F.hex(group + (128 if shift else 0)), 2, "0")
        out = F.concat(out, F.when(number >= 2**shift, byte).otherwise(F.lit("00" if shift == 0 else "")))
    return out


def unvarint(bitmap: Column) -> Column:
    """The numbers of a binary that holds `varint` numbers one after another."""
    groups = F.regexp_extract_all(F.hex(bitmap), F.lit("(?:[89A-F].)*[0-7]."), F.lit(0))

    def number(digits: Column) -> Column:
        bytes_ = F.transform(
            F.sequence(F.lit(1), F.char_length(digits), F.lit(2)),
            lambda at: F.conv(digits.substr(at, F.lit(2)), 16, 10).cast("bigint"),
        )
        return F.aggregate(bytes_, F.lit(0).cast("bigint"), lambda sum_, byte: sum_ * 128 + byte.bitwiseAND(F.lit(127)))

    return F.transform(groups, number)


def run_lengths(dropped: Column) -> Column:
    """The bitmap of kept lines, from the ascending positions of the dropped ones: the lengths of
    runs as `varint` numbers, kept and dropped in turn, a kept run first. Lines after the last run are kept."""
    starts = F.filter(dropped, lambda p, i: (i == 0) | (F.get(dropped, i - 1) != p - 1))
    stops = F.filter(dropped, lambda p, i: F.coalesce(F.get(dropped, i + 1) != p + 1, F.lit(True)))
    before = F.transform(starts, lambda p, i: p - F.when(i == 0, 0).otherwise(F.get(stops, i - 1) + 1))
    inside = F.transform(stops, lambda p, i: p - F.get(starts, i) + 1)
    hexed = F.transform(F.arrays_zip(before.alias("b"), inside.alias("i")), lambda r: F.concat(varint(r["b"]), varint(r["i"])))
    return F.unhex(F.array_join(hexed, ""))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, text_key, n_dropped and keep (see `run_lengths`) of each document that loses lines.

    A line of at least `least_chars` code points (of its key) that is found in at least `least_docs`
    documents is dropped from all but the one with the largest doc_id. Rows that share a doc_id are one
    document here, those without one too, which is smaller than any; each row has a bitmap of its own,
    but for rows that share the text as well. An empty table gives an empty table.
    """
    rows = stage(first_occurrences(line_digests(docs.select("doc_id", "text"), least_chars)), "line-digests")
    shared = stage(shared_lines(rows, least_docs), "shared-lines")
    few = shared.count() <= BROADCAST_KEYS
    found = rows.join(F.broadcast(shared) if few else shared, "digest")
    lost = found.filter(~F.col("doc_id").eqNullSafe(F.col("best")))
    dropped = F.array_sort(F.collect_set("at"))
    listed = lost.groupBy("doc_id", "text_key").agg(dropped.alias("_dropped"))
    return listed.select(
        "doc_id", "text_key", F.size("_dropped").cast("bigint").alias("n_dropped"), run_lengths(F.col("_dropped")).alias("keep")
    )


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps; all of them if it is null."""
    runs = unvarint(keep)
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n.cast("int"))))
    # the flags are made once for each row, not once for each line
    both = F.arrays_zip(lines.alias("line"), flags.alias("kept"))
    left = F.filter(both, lambda p: p["line"].isNotNull() & F.coalesce(p["kept"], F.lit(True)))
    return F.when(keep.isNull(), lines).otherwise(F.transform(left, lambda p: p["line"]))


def drop_shared_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """The rows of `docs` with shared lines dropped from `text`, and n_lines (before), n_dropped and keep.

    `docs` needs doc_id (an integer) and text; other columns stay, but for those of the three names, which
    are replaced. A null text counts as empty, which is one empty line, and comes back empty. See
    `keep_bitmaps` for the rule, rows that share a doc_id and rows without one. A document that
    loses all its lines has an empty text. An empty table gives an empty table.
    """
    added = ["n_lines", "n_dropped", "keep", "_text_key"]
    columns = [c for c in docs.columns if c not in added]
    maps = keep_bitmaps(docs, least_chars, least_docs)
    maps = maps.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "n_dropped", "keep")
    texts = docs.select(*quoted(columns)).withColumn("_text_key", text_key())
    own = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_key") == F.col("_key"))
    # the documents that lose lines grow with the corpus, so they are never sent to all tasks
    marked = texts.join(maps, own, "left")
    text = F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(kept_lines(_lines(), F.col("keep")), "\n")
    )
    others = [c for c in columns if c != "text"]
    return marked.select(
        *quoted(others), text.alias("text"), F.size(_lines()).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), "keep",
    )
