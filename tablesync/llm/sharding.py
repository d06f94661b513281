"""Shards as the leaves of a k-d tree over document metadata.

Every node is cut at a weighted median of its widest dimension, the weight being bytes. The
medians are found by narrowing: one aggregation gives the bytes of a few thousand bins for all
nodes of a level at once, the bin that holds the median is cut into bins again. The driver sees
bin sums only, at most `nodes x BINS` of them, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.sinks.files import stage

BINS = 2048
#: A group of equal texts is only cut if its bytes exceed this share of a shard.
GROUP_SHARE = 0.02
#: Accepted distance of a cut from its median, as a share of a shard.
CUT_SHARE = 0.0005
#: Rows that one task numbers, about; more shards' worth of rows are numbered in parts.
ROWS_PER_PART = 50_000

_SCALE = 2**30
_HASHES = 2**40


def metadata(docs: DataFrame) -> DataFrame:
    """Size, checksum and split keys of each document, without its text, and a number of the row that
    tells rows apart that are equal in all else; it is fixed once the result is staged.

    The dimensions are facts of the text, so equal texts have equal keys and stay neighbours:
    length, share of multi-byte characters, line breaks, and the checksum. Each key has the
    dimension, scaled to 30 bits, above the 32 bits of the checksum.
    """
    text = F.coalesce("text", F.lit(""))
    length = F.octet_length(text)
    crc = F.crc32(text.cast("binary"))
    lines = length - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))

    def scaled(share: Column) -> Column:
        return F.least(F.floor(share * _SCALE), F.lit(_SCALE - 1)).cast("bigint")

    dimensions = [
        scaled(F.log2(length + F.lit(1.0)) / 32),
        scaled((length - F.char_length(text)) / (length + F.lit(1.0))),
        scaled(F.log2(lines + F.lit(1.0)) / 32),
        F.shiftright(crc, 2),
    ]
    return docs.withColumn("row", F.monotonically_increasing_id()).select(
        "doc_id",
        "row",
        (length + 16).cast("bigint").alias("size"),
        crc.alias("text_crc32"),
        *((d * F.lit(2**32) + crc).alias(f"k{i}") for i, d in enumerate(dimensions)),
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(_HASHES)).alias("row_hash"),
    )


DIMENSIONS = [f"k{i}" for i in range(4)]


@dataclass
class Node:
    """`leaves` shards from `first` on; rows with key below `cut`, or equal to it and row hash
    up to `row_cut`, go left."""

    first: int
    leaves: int
    dimension: str = ""
    cut: int = 0
    row_cut: int = -1
    left: Node | None = None
    right: Node | None = None

    def walk(self, pick: Callable[[Node], str]) -> str:
        """SQL for the value of `pick(leaf)` at a row's leaf: conditions nested as the tree is."""
        if self.left is None or self.right is None:
            return pick(self)
        key, cut = self.dimension, self.cut
        goes_left = f"{key} < {cut}L or ({key} = {cut}L and row_hash <= {self.row_cut}L)"
        return f"case when {goes_left} then {self.left.walk(pick)} else {self.right.walk(pick)} end"

    def leaf(self) -> Column:
        return F.expr(self.walk(lambda n: str(n.first)))


@dataclass
class Search:
    """The search for one node's median: `before` are the bytes below the bracket, `inside` those
    in it; `only` is the key whose rows are searched by row hash."""

    node: Node
    column: str
    low: int
    high: int
    goal: float
    slack: float
    before: int = 0
    inside: int = 0
    only: int | None = None
    bins: list[tuple[int, int]] = field(default_factory=list)

    @property
    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BINS))

    def place(self) -> str:
        """SQL for a row's bin, null outside the bracket."""
        here = f"{self.column} between {self.low}L and {self.high}L"
        if self.only is not None:
            here += f" and {self.node.dimension} = {self.only}L"
        return f"case when {here} then ({self.column} - {self.low}L) div {self.width}L end"

    def narrow(self) -> bool:
        """Move the bracket to the bin that holds the goal; True once the bin is one value."""
        width, before = self.width, self.before
        ordered = sorted(self.bins)
        for at, size in ordered:
            if before + size >= self.goal or at == ordered[-1][0]:
                low = self.low + at * width
                self.low, self.high, self.before, self.inside = low, min(self.high, low + width - 1), before, size
                break
            before += size
        else:
            self.inside = 0
            return True
        return self.low == self.high

    def close_edge(self) -> int | None:
        """The key before which to cut if an edge of the bracket is near enough to the goal."""
        if self.goal - self.before <= self.slack:
            return self.low
        if self.before + self.inside - self.goal <= self.slack:
            return self.high + 1
        return None


def _run(meta: DataFrame, root: Node, searches: Iterable[Search]) -> None:
    """Fill the bins of all searches by one aggregation."""
    by_leaf = {s.node.first: s for s in searches}
    for s in by_leaf.values():
        s.bins = []

    def place(leaf: Node) -> str:
        s = by_leaf.get(leaf.first)
        return s.place() if s and s.node is leaf else "cast(null as bigint)"

    placed = meta.select(root.leaf().alias("_node"), F.expr(root.walk(place)).alias("_bin"), "size")
    placed = placed.filter("_bin is not null")
    for row in placed.groupBy("_node", "_bin").agg(F.sum("size").alias("bytes")).collect():
        by_leaf[row["_node"]].bins.append((int(row["_bin"]), int(row["bytes"])))


def build_tree(meta: DataFrame, shards: int) -> Node:
    """Split until every leaf is one shard."""
    root = Node(0, shards)
    spans = [F.min(d).alias(f"low_{d}") for d in DIMENSIONS] + [F.max(d).alias(f"high_{d}") for d in DIMENSIONS]
    extent: dict[str, int] = {}
    level = [root] if shards > 1 else []
    while level:
        found = {
            r["_node"]: r
            for r in meta.groupBy(root.leaf().alias("_node")).agg(F.sum("size").alias("bytes"), *spans).collect()
        }
        if not extent and found:
            extent = {d: max(1, found[0][f"high_{d}"] - found[0][f"low_{d}"]) for d in DIMENSIONS}
        searches = []
        for node in level:
            row = found.get(node.first)
            if row is None:  # no rows: any cut will do
                _split(node, DIMENSIONS[0], 0, -1)
                continue
            node.dimension = max(DIMENSIONS, key=lambda d: (row[f"high_{d}"] - row[f"low_{d}"]) / extent[d])
            leaf = row["bytes"] / node.leaves
            searches.append(Search(node, node.dimension, row[f"low_{node.dimension}"], row[f"high_{node.dimension}"], leaf * (node.leaves // 2), leaf * CUT_SHARE))
        _cut_all(meta, root, searches)
        level = [child for node in level for child in (node.left, node.right) if child.leaves > 1]
    return root


def _split(node: Node, dimension: str, cut: int, row_cut: int) -> None:
    half = node.leaves // 2
    node.dimension, node.cut, node.row_cut = dimension, cut, row_cut
    node.left, node.right = Node(node.first, half), Node(node.first + half, node.leaves - half)


def _cut_all(meta: DataFrame, root: Node, searches: list[Search]) -> None:
    """Find the cuts of one level: by key, and inside a large group of equal keys by row hash."""
    cuts: list[tuple[Node, int, int]] = []
    while searches:
        _run(meta, root, searches)
        again = []
        for s in searches:
            one_value, edge = s.narrow(), None
            if s.only is None:
                edge = s.close_edge()
                if edge is not None:
                    cuts.append((s.node, edge, -1))
                elif not one_value:
                    again.append(s)
                elif s.inside > s.slack / CUT_SHARE * GROUP_SHARE:
                    again.append(Search(s.node, "row_hash", 0, _HASHES - 1, s.goal, s.slack, s.before, s.inside, s.low))
                else:
                    after = s.before + s.inside - s.goal < s.goal - s.before
                    cuts.append((s.node, s.low + int(after), -1))
            else:
                edge = s.close_edge()
                if edge is None and one_value:
                    edge = s.low + int(s.before + s.inside - s.goal < s.goal - s.before)
                if edge is None:
                    again.append(s)
                else:
                    cuts.append((s.node, s.only, edge - 1))
        searches = again
    for node, cut, row_cut in cuts:
        _split(node, node.dimension, cut, row_cut)


def number_rows(rows: DataFrame, parts: int) -> DataFrame:
    """`slot`: gapless numbers from 0 in each shard.

    Rows are numbered inside `parts` hashed parts of a shard; the parts' sizes, added up, give
    the number at which each part begins. No task holds a whole shard.
    """
    parted = rows.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = parted.groupBy("shard", "_part").agg(F.count("*").alias("_rows"))
    begins = counts.selectExpr(
        "shard", "_part",
        "sum(_rows) over (partition by shard order by _part rows between unbounded preceding and 1 preceding) as _begin",
    )
    inside = parted.selectExpr("*", "row_number() over (partition by shard, _part order by doc_id, text_crc32, size, row) - 1 as _at")
    return inside.join(begins, ["shard", "_part"]).withColumn(
        "slot", F.coalesce("_begin", F.lit(0)) + F.col("_at")
    ).drop("row", "_part", "_begin", "_at")


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Each document's shard and slot: doc_id, size, text_crc32, shard, slot.

    Give the number of shards, or the bytes a shard is to hold (a size is the text's UTF-8
    bytes plus 16; null texts have none). Shards differ by the size of a document or by
    GROUP_SHARE per level, whichever is more; equal texts share a shard unless their group is
    larger than that, then it is cut by a hash of doc_id and the row's number, so null and repeated
    doc_ids are cut as well. An empty table
    gives an empty table.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    meta = stage(metadata(docs), "shard-metadata")
    totals = meta.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    if shards is None:
        shards = max(1, -(-(totals["bytes"] or 0) // target_bytes))
    tree = build_tree(meta, shards)
    sharded = meta.select("doc_id", "row", "size", "text_crc32", tree.leaf().alias("shard"))
    parts = 8 + totals["rows"] // (shards * ROWS_PER_PART)
    return number_rows(sharded, parts)
