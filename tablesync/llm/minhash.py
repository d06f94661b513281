"""Near duplicates by SuperMinHash signatures.

Each shingle gets a random permutation of the signature's slots, drawn step by step; its value
in a slot is the rank of that slot in its permutation plus a random fraction. A slot keeps the
smallest value. The ranks of one shingle are correlated: no two of its slots share a rank,
which gives the signature a lower variance, and drawing stops as soon as the next rank can't be
below any kept value, for long texts after two or three of the ranks.

Bands of the signature choose candidates; every link is confirmed on the full shingle sets.
Documents with equal sets are one class with one representative. A bucket is never expanded
into all its pairs: its members are compared with one leader, different from band to band, and
the links are united into components. Only members of buckets that still span several
components are then compared with each other, as far as two exact bounds leave a link possible:
the distances to their leader (the Jaccard distance is a metric), and prefixes of their sets
with the rarest shingles first, which similar sets must share. No candidate pair is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import Words, byte_slices, map_arrow, mix64
from tablesync.sinks.files import stage

BANDS, ROWS = 32, 6
#: Ranks of a permutation found by replaying its steps; from then on it is written out.
REPLAYED = 4
#: Representatives whose ids are sent to all tasks; more of them are joined by a shuffle.
BROADCAST_NODES = 1_000_000
#: Shingles whose permutations are written out at once.
WRITTEN_OUT = 16_000
#: Bytes of text whose signatures are made at once.
SLICE = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_RANK = np.uint64(48)


def _draw(base: np.ndarray, rank: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle the value at a rank, and the position that the rank is swapped with."""
    with np.errstate(over="ignore"):
        u = mix64(base + np.uint64(2 * rank + 1) * _STEP)
    value = (np.uint64(rank) << _RANK) | (u >> np.uint64(16))
    spot = (mix64(u) >> np.uint64(32)) * np.uint64(slots - rank) >> np.uint64(32)
    return value, spot.astype(np.int64) + rank


def super_min_hash(shingles: np.ndarray, owner: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """The signatures of `texts` sets; `shingles[i]` belongs to set `owner[i]`, which ascends."""
    kept = np.full((texts, slots), np.iinfo(np.uint64).max, np.uint64)
    flat = kept.reshape(-1)
    base, spots = mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)), []
    for rank in range(min(REPLAYED, slots)):
        value, spot = _draw(base, rank, slots)
        slot = spot
        for earlier in range(rank - 1, -1, -1):
            slot = np.where(slot == spots[earlier], earlier, slot)
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = kept.max(axis=1) >= np.uint64(rank + 1) << _RANK
        more = open_sets[owner]
        spots = [s[more] for s in (*spots, spot)]
        base, owner = base[more], owner[more]
    start = 0
    while start < len(base) and slots > REPLAYED:
        stop = int(np.searchsorted(owner, owner[min(start + WRITTEN_OUT, len(owner) - 1)], side="right"))
        _written_out(kept, base[start:stop], owner[start:stop], [s[start:stop] for s in spots], slots)
        start = stop
    return kept


def _written_out(kept: np.ndarray, base: np.ndarray, owner: np.ndarray, spots: list[np.ndarray], slots: int) -> None:
    """The ranks from REPLAYED on, for whole sets."""
    flat = kept.reshape(-1)
    order = np.tile(np.arange(slots, dtype=np.int16), (len(base), 1))
    rows = np.arange(len(base))
    for rank in range(slots):
        if rank < len(spots):
            value, spot = None, spots[rank]
        else:
            value, spot = _draw(base, rank, slots)
        slot = order[rows, spot].astype(np.int64)
        order[rows, spot] = order[rows, rank]
        if value is None:
            continue
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = kept.max(axis=1) >= np.uint64(rank + 1) << _RANK
        more = open_sets[owner]
        if not more.any():
            return
        if more.sum() < 0.7 * len(more):
            base, owner, order = base[more], owner[more], order[more]
            spots = [s[more] for s in spots]
            rows = np.arange(len(base))


def _sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order text by text, their texts, and counts."""
    values, owner = Words(texts).shingles(words)
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    distinct = [np.unique(values[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    counts = np.array([len(d) for d in distinct], np.int64)
    joined = np.concatenate(distinct) if distinct else np.zeros(0, np.uint64)
    return joined, np.repeat(np.arange(len(texts)), counts), counts


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, node, n_shingles, digest of the set (null if empty), and band keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                values, owner, counts = _sets(part.column("text"), words)
                kept = super_min_hash(values, owner, part.num_rows, BANDS * ROWS)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (part.num_rows, BANDS))
                with np.errstate(over="ignore"):
                    for row in range(ROWS):
                        key = mix64(key * _STEP + kept[:, row::ROWS])
                ends = np.cumsum(counts)
                digests = [
                    hashlib.blake2b(values[e - c : e].tobytes(), digest_size=16).digest() if c else None
                    for e, c in zip(ends, counts, strict=True)
                ]
                starts = np.arange(part.num_rows + 1, dtype=np.int32) * BANDS
                keys = pa.ListArray.from_arrays(pa.array(starts), pa.array(key.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in _NODE), pa.array(counts), pa.array(digests, pa.binary()), keys],
                    [*_NODE, "n_shingles", "digest", "bands"],
                )

    schema = f"doc_id {kind}, text_key bigint, node bigint, n_shingles bigint, digest binary, bands array<bigint>"
    return map_arrow(_nodes(docs), signed, schema)


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text and node: the doc_id, or where that is null a number far below, from the text."""
    key = text_key()
    own = -F.pmod(key, F.lit(2**61)) - F.lit(2**62)
    return docs.select("doc_id", key.alias("text_key"), F.coalesce(F.col("doc_id").cast("bigint"), own).alias("node"), "text")


_NODE = ["doc_id", "text_key", "node"]


def text_key() -> Column:
    """Tells rows that share a doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _shingle_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and its full set of shingle hashes, for the nodes given (one column, distinct)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE):
                values, _, counts = _sets(part.column("text"), words)
                offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "shingles"])

    few = nodes.count() <= BROADCAST_NODES
    chosen = _nodes(docs).join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return map_arrow(chosen.select("node", "text"), listed, "node bigint, shingles array<bigint>")


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    return stage(_shingle_sets(docs, stage(nodes.distinct(), "candidates"), words), "shingle-sets")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """rep and prefix: the shingles of each set that a linked set can have as its rarest ones.

    Rarest first, ties by hash: the order is the same for all sets, so two sets that share o
    shingles share one of their first n - o + 1. Shingles of one set only stand as nulls; sets
    with nothing else in their prefix can't have a link and are left out.
    """
    listed = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = listed.groupBy("shingle").agg(F.count("*").alias("sets"))
    ranked = listed.join(counts, "shingle").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("all")
    )
    first = F.slice("all", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    shared = F.transform(first, lambda s: F.when(s["sets"] > 1, s["shingle"]))
    named = ranked.select(F.col("node").alias("rep"), shared.alias("prefix"))
    return named.filter(F.exists("prefix", lambda s: s.isNotNull()))


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their sets' intersection and union."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b")), "b")
    shared = F.size(F.array_intersect("_a", "_b"))
    sized = both.select("a", "b", shared.alias("shared"), (F.size("_a") + F.size("_b")).alias("sizes"))
    return stage(sized.selectExpr("a", "b", "shared", "sizes - shared as joined"), "measured-pairs")


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of the links (a, b).

    Alternates large-star and small-star steps until the links are stars around the roots; both
    are a minimum per node and a join, so a node with very many links costs no more than its
    links.
    """
    links = stage(links.selectExpr("greatest(a, b) as u", "least(a, b) as v").filter("u <> v").distinct(), "links")
    while True:
        both = links.union(links.selectExpr("v as u", "u as v"))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).selectExpr("u", "least(u, low) as low")
        large = both.filter("v > u").join(stage(lowest, "lowest"), "u").selectExpr("v as u", "low as v")
        links = stage(large.filter("u <> v").distinct(), "links")
        # a star has each node once, and its centre is no node of another
        lowest = stage(links.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n")), "lowest")
        chained = lowest.join(links.select(F.col("v").alias("u")), "u", "left_semi")
        if lowest.filter("n > 1").isEmpty() and chained.isEmpty():
            break
        small = links.join(lowest, "u")
        small = small.selectExpr("v as u", "low as v").union(small.selectExpr("u", "low as v"))
        links = stage(small.filter("u <> v").distinct(), "links")
    roots = links.selectExpr("v as node", "v as root").distinct()
    return stage(links.selectExpr("u as node", "v as root").union(roots), "components")


def _meetings(members: DataFrame) -> DataFrame:
    """Pairs of members of a bucket (columns with a and b behind their names) from different components.

    Members of a bucket's largest component (`most`) meet the others, never each other.
    """
    left, right = (members.select("key", *(F.col(c).alias(c + side) for c in members.columns if c != "key")) for side in "ab")
    pairs = left.filter("roota <> mosta").join(right, "key")
    return pairs.filter("roota <> rootb and (rootb = mostb or repa < repb)")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, text_key (see `text_key`), n_shingles, component_id, kept.

    A document's set holds its distinct shingles of `words` words (A-Z lower-cased, cut at
    ASCII white space); with fewer words the whole sequence is the only shingle, without words
    or text the set is empty and links with nothing. Documents are linked if
    100 * intersection >= percent * union; component_id is the smallest doc_id that can be
    reached, kept tells whether it is the document's own. The bands miss a pair at a similarity
    of 0.8 with probability 6e-5, at 0.9 with 3e-11.

    doc_id is an integer above -2^62 and should be unique: rows that share one may count as
    linked. Rows with a null doc_id stand for themselves, equal texts among them for each
    other; they are kept only if no document with an id is linked to them, and all of them then.
    An empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    signed = stage(signatures(docs, words), "signatures")
    classes = stage(
        signed.filter("digest is not null").groupBy("digest").agg(F.min("node").alias("rep")), "classes"
    )
    own = signed.withColumnRenamed("node", "rep").join(classes, ["digest", "rep"])
    own = own.dropDuplicates(["digest", "rep"])
    banded = own.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    leader = F.min(F.struct(F.xxhash64("key", "rep").alias("h"), "rep", "n")).alias("leader")
    buckets = banded.groupBy("key").agg(F.count("*").alias("members"), leader).filter("members > 1")
    buckets = stage(buckets.selectExpr("key", "members", "leader.rep as leader", "leader.n as leader_n"), "buckets")
    members = stage(banded.join(buckets, "key"), "bucket-members")

    fits = f"100 * least({{0}}, {{1}}) >= {percent} * greatest({{0}}, {{1}})"
    stars = members.filter("rep <> leader").filter(fits.format("n", "leader_n"))
    stars = stage(stars.selectExpr("least(rep, leader) as a", "greatest(rep, leader) as b").distinct(), "star-pairs")
    nodes = stars.select(F.col("a").alias("node")).union(stars.select("b"))
    first = _measured(stars, _sets_of(docs, nodes, words))
    linked = f"100 * shared >= {percent} * joined"
    links = first.filter(linked).select("a", "b")
    grouped = components(links)

    placed = members.filter("members > 2").join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("root", F.coalesce("root", "rep"))
    placed = placed.withColumn("a", F.least("rep", "leader")).withColumn("b", F.greatest("rep", "leader"))
    placed = stage(placed.join(first, ["a", "b"], "left").selectExpr(
        "key", "rep", "n", "root", "case when rep = leader then 0d else 1 - shared / joined end as far"
    ), "placed-members")
    mixed = stage(placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("key"), "mixed-buckets")
    rest = stage(placed.join(mixed, "key", "left_semi"), "mixed-members")
    sets = _sets_of(docs, rest.select(F.col("rep").alias("node")), words)
    own_keys = rest.groupBy("rep").agg(F.collect_set("key").alias("keys"))
    rest = rest.join(own_keys, "rep").join(_prefixes(sets, percent), "rep")
    roots = rest.groupBy("key", "root").agg(F.count("*").alias("of_root"))
    most = roots.groupBy("key").agg(F.max_by("root", F.struct("of_root", "root")).alias("most"))
    rest = stage(rest.join(most, "key"), "members-with-prefixes")
    near = f"coalesce(abs(fara - farb) <= {1 - percent / 100 + 1e-9}, true)"
    shared = f"cast(ceil({percent} * (na + nb) / {100 + percent}) as int)"
    heads = (f"slice(prefix{side}, 1, cast(greatest(n{side} - {shared} + 1, 0) as int))" for side in "ab")
    pairs = _meetings(rest)
    pairs = pairs.filter(near).filter(fits.format("na", "nb"))
    pairs = pairs.filter(f"coalesce(arrays_overlap({', '.join(heads)}), false)")
    # a pair that meets in several buckets is named in one of them
    pairs = pairs.filter("key = array_min(array_intersect(keysa, keysb))")
    pairs = pairs.selectExpr("least(repa, repb) as a", "greatest(repa, repb) as b").distinct().join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = _measured(stage(pairs, "candidate-pairs"), sets)
    more = second.filter(linked).select("a", "b")
    if not more.isEmpty():
        grouped = components(grouped.filter("node <> root").selectExpr("node as a", "root as b").union(more))

    rooted = classes.join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("root", "rep").alias("root")
    )
    joined = signed.drop("bands").join(stage(rooted, "class-roots"), "digest", "left")
    smallest = joined.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(stage(smallest, "component-ids"), "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
