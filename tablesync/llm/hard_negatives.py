"""Hard negatives by bounds along spanning trees of anchors.

Anchors are put into blocks of near ones, and each block is spanned by its shortest tree. A
candidate's score with a child differs from its score with the parent by at most the edge's length
times the candidate's norm, so a tile of candidates is scored with the tree's root only; down the
tree each anchor gets bounds from its parent's scores and bounds, and only candidates whose
bounds overlap a score window of the anchor are scored with it, which makes their bounds exact for its
children. The windows are "among the best so far" for positives, and a share of a positive's score for
negatives.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import map_arrow
from tablesync.sinks.files import stage

#: Anchors in a block, about, and candidates in a tile at most.
BLOCK, TILE = 512, 2048
#: Anchors around which blocks are formed, at most: the ones with the smallest hashes of their ids.
PIVOTS = 64
#: Slack of bounds for rounding: of an edge's reach, and of the largest score possible.
SLACK, ROUNDING = 1e-9, 1e-12
_MOST = 2**62


def labelled_vectors(table: DataFrame, label: Column | str = "label", scale: int = 256) -> DataFrame:
    """vec_id, label and x, the components as floor(scale * component); rows without an id or a label, or
    with a null vector or a null or non-finite component, are left out."""
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(value, lambda v: F.floor(v * scale))
    named = F.col(label) if isinstance(label, str) else label
    made = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), named.cast("bigint").alias("label"),
        F.when(value.isNotNull() & finite, whole).alias("x"),
    )
    return made.filter("x is not null and vec_id is not null and label is not null")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(**arrays: np.ndarray) -> bytes:
    body = io.BytesIO()
    np.savez(body, **arrays)
    return body.getvalue()


def _unpacked(body: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(body)) as arrays:
        return {name: arrays[name] for name in arrays.files}


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shortest spanning tree of the rows: an order with parents first, each row's parent (-1 for
    the root, the row nearest to the mean), and the length of the edge to it."""
    points = x.astype(np.float64)
    root = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    away = np.full(len(points), np.inf)
    parent, done = np.full(len(points), -1), np.zeros(len(points), bool)
    order, length, here = [root], np.zeros(len(points)), root
    done[root] = True
    while len(order) < len(points):
        to_here = np.sqrt(((points - points[here]) ** 2).sum(axis=1))
        nearer = (to_here < away) & ~done
        away[nearer], parent[nearer] = to_here[nearer], here
        here = int(np.argmin(np.where(done, np.inf, away)))
        length[here] = away[here]
        done[here] = True
        order.append(here)
    return np.array(order), parent, length


class Candidates:
    """A tile of candidates and what the anchors of one block know of their scores with them."""

    def __init__(self, tile: dict[str, np.ndarray], block: dict[str, np.ndarray], exact: type):
        self.ids, self.labels, self.x = tile["ids"], tile["labels"], tile["x"].astype(exact)
        self.anchors, self.order = block["x"].astype(exact), block["order"]
        self.parent, self.length = block["parent"], block["length"]
        norm = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        largest = np.sqrt((block["x"].astype(np.float64) ** 2).sum(axis=1).max())
        self._reach = norm * (1 + SLACK)
        self._rounding = ROUNDING * largest * norm + 1e-6
        self._low = np.empty((len(self.order), len(self.ids)))
        self._high = np.empty_like(self._low)
        self.scored = 0

    def bounds(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest possible scores of all candidates with an anchor, parents asked first."""
        low, high = self._low[anchor], self._high[anchor]
        above = self.parent[anchor]
        if above < 0:
            self.scored += len(self.ids)
            low[:] = high[:] = self.x @ self.anchors[anchor]
        else:
            reach = self.length[anchor] * self._reach + self._rounding
            np.subtract(self._low[above], reach, out=low)
            np.add(self._high[above], reach, out=high)
        return low, high

    def score(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        """The scores of the rows, which are their bounds from now on."""
        self.scored += len(rows)
        scores = self.x[rows] @ self.anchors[anchor]
        self._low[anchor, rows] = self._high[anchor, rows] = scores
        return scores.astype(np.int64)


class Best:
    """The k best (score, then smaller id) that a list has seen."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int:
        """The score that a further one must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else -_MOST

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        kept = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[kept], ids[kept]


def _kth(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def find_positives(tile: Candidates, block: dict[str, np.ndarray], best: list[Best]) -> None:
    """Bring each anchor's best candidates of its own label up to date with a tile."""
    for anchor in tile.order:
        low, high = tile.bounds(anchor)
        like = np.flatnonzero((tile.labels == block["labels"][anchor]) & (tile.ids != block["ids"][anchor]))
        least = max(best[anchor].floor(), _kth(low[like], best[anchor].k))
        rows = like[high[like] >= least]
        if len(rows):
            best[anchor].add(tile.score(anchor, rows), tile.ids[rows])


def find_negatives(tile: Candidates, block: dict[str, np.ndarray], best: list[list[Best]]) -> None:
    """The same for the candidates of other labels in the windows of each anchor."""
    edges = np.searchsorted(block["window_of"], np.arange(len(tile.order) + 1))
    for anchor in tile.order:
        low, high = tile.bounds(anchor)
        windows = range(edges[anchor], edges[anchor + 1])
        other = np.flatnonzero(tile.labels != block["labels"][anchor])
        low, high = low[other], high[other]
        wanted = np.zeros(len(other), bool)
        for w in windows:
            least, most = block["least"][w], block["most"][w]
            mine = best[anchor][w - edges[anchor]]
            inside = (low >= least) & (high <= most)
            floor = max(least, mine.floor(), _kth(low[inside], mine.k))
            wanted |= (high >= floor) & (low <= most)
        rows = other[wanted]
        if not len(rows):
            continue
        scores, ids = tile.score(anchor, rows), tile.ids[rows]
        for w in windows:
            fits = (scores >= block["least"][w]) & (scores <= block["most"][w])
            best[anchor][w - edges[anchor]].add(scores[fits], ids[fits])


def _tiles(vectors: DataFrame, width: int) -> DataFrame:
    """The candidates packed into tiles: a number that names it, and its body."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                ids, x = part.column("vec_id").to_numpy(), _matrix(part.column("x"), width)
                small = x.astype(np.int16)
                body = _packed(ids=ids, labels=part.column("label").to_numpy(), x=small if (small == x).all() else x)
                yield pa.RecordBatch.from_arrays([pa.array(ids[:1]), pa.array([body], pa.binary())], ["tile", "body"])

    return stage(map_arrow(vectors.select("vec_id", "label", "x"), packed, "tile bigint, body binary"), "candidate-tiles")


def _dealt(anchors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The anchors with the number of their block, near ones together, and how many blocks there are."""
    spark = anchors.sparkSession
    pivots = min(PIVOTS, -(-anchors.count() // BLOCK))
    if not pivots:
        return anchors.withColumn("block", F.lit(0).cast("bigint")), 0
    seeds = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("x").toArrow().combine_chunks()
    centres = spark.sparkContext.broadcast(_matrix(seeds.column("x").combine_chunks(), width).astype(np.float64))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = centres.value
        half = (points**2).sum(axis=1) / 2
        for batch in batches:
            pivot = np.argmax(_matrix(batch.column("x"), width) @ points.T - half, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], [*batch.schema.names, "pivot"])

    near = stage(map_arrow(anchors, nearest, "vec_id bigint, label bigint, x array<bigint>, pivot bigint"), "anchors-by-pivot")
    counts = {r["pivot"]: -(-r["count"] // BLOCK) for r in near.groupBy("pivot").count().collect()}
    first = np.r_[0, np.cumsum([counts.get(p, 0) for p in range(pivots)])].tolist()
    at = F.col("pivot").cast("int") + 1
    begin = F.element_at(F.array(*map(F.lit, first)), at)
    parts = F.element_at(F.array(*(F.lit(counts.get(p, 1)) for p in range(pivots))), at)
    block = (begin + F.pmod(F.xxhash64("vec_id"), parts)).cast("bigint")
    return stage(near.select("vec_id", "label", "x", block.alias("block")), "anchors-in-blocks"), first[-1]


def _searched(anchors: DataFrame, tiles: DataFrame, blocks: int, width: int, k: int, exact: type) -> DataFrame:
    """anchor_id, positive_id, positive_score, vec_id, score: the k best of each anchor, or of each of its
    windows, in each stripe of tiles.

    `anchors` are vec_id, label, x, block, and for windows also lists of positives, their scores, and the
    least and most scores.
    A task reads a block and then a stripe of tiles one by one, and knows the best so far of each anchor.
    """
    windowed = "positives" in anchors.columns
    none = np.zeros(0, np.int64)

    def joined(frame: pd.DataFrame, name: str) -> np.ndarray:
        return np.concatenate([none, *(np.asarray(v, np.int64) for v in frame[name])]) if windowed else none

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", ignore_index=True)
        x = _matrix(pa.array(frame["x"].tolist(), pa.list_(pa.int64())), width)
        order, parent, length = spanning_tree(x)
        counts = [len(v) for v in frame["positives"]] if windowed else np.zeros(len(frame), np.int64)
        body = _packed(
            ids=frame["vec_id"].to_numpy(), labels=frame["label"].to_numpy(), x=x, order=order, parent=parent, length=length,
            window_of=np.repeat(np.arange(len(frame)), counts), positives=joined(frame, "positives"),
            scores=joined(frame, "scores"), least=joined(frame, "least"), most=joined(frame, "most"),
        )
        return pd.DataFrame([{"block": frame["block"].iloc[0], "tree": body}])

    trees = stage(anchors.groupBy("block").applyInPandas(built, "block bigint, tree binary"), "anchor-trees")
    slots = anchors.sparkSession.sparkContext.defaultParallelism
    stripes = F.lit(max(1, min(tiles.count(), -(-4 * slots // blocks))))
    one, every = F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")
    # the stated query set against all rows, in blocks: a tile meets each block once
    work = tiles.select(
        F.explode(F.sequence(one, every)).alias("block"), F.pmod(F.xxhash64("tile"), stripes).cast("bigint").alias("stripe"),
        F.lit(1).alias("kind"), "tile", "body",
    ).union(
        trees.select("block", F.explode(F.sequence(one, stripes.cast("bigint") - 1)).alias("stripe"), F.lit(0).alias("kind"), one.alias("tile"), F.col("tree").alias("body"))
    )

    def told(block: dict[str, np.ndarray], best: list) -> pa.RecordBatch:
        lists = []
        for anchor, found in zip(block["ids"], best, strict=True):
            lists += [(anchor, b) for b in found] if windowed else [(anchor, found)]
        sizes = [len(b.ids) for _, b in lists]
        columns = {
            "anchor_id": np.repeat(np.array([a for a, _ in lists], np.int64), sizes),
            "positive_id": np.repeat(block["positives"], sizes) if windowed else np.zeros(sum(sizes), np.int64),
            "positive_score": np.repeat(block["scores"], sizes) if windowed else np.zeros(sum(sizes), np.int64),
            "vec_id": np.concatenate([none, *(b.ids for _, b in lists)]),
            "score": np.concatenate([none, *(b.scores for _, b in lists)]),
        }
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, own = None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("block")[row].as_py()
                body = _unpacked(batch.column("body")[row].as_py())
                if batch.column("kind")[row].as_py() == 0:
                    if block is not None:
                        yield told(block, best)
                    block, own = body, here
                    windows = np.bincount(block["window_of"], minlength=len(block["ids"]))
                    best = [[Best(k) for _ in range(n)] for n in windows] if windowed else [Best(k) for _ in block["ids"]]
                elif here == own:  # a number that no anchor fell to has tiles only
                    (find_negatives if windowed else find_positives)(Candidates(body, block, exact), block, best)
        if block is not None:
            yield told(block, best)

    sorted_work = work.repartition("block", "stripe").sortWithinPartitions("block", "stripe", "kind", "tile")
    return map_arrow(sorted_work, searched, "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint")


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `vectors` are vec_id, label and x (integers); `anchors` selects the anchors among them. An anchor's
    positives are its `positives` best other rows of the same label by inner product, ties by smaller vec_id;
    for each, the first `negatives` rows of other labels, in the same order, are returned whose score s
    satisfies low * positive_score <= 100 * s <= high * positive_score.

    With fewer rows all are returned; a positive with a negative score has none if low < high.
    Shorter vectors count as ended by zeros. Repeated rows are candidates each, but a positive that is
    repeated with the same score has its negatives once; of rows that share an anchor's id, the one with
    the least label and vector is the anchor, and none is its own positive. An empty table, or one without anchors, gives an empty table. Scores must stay below
    2^62: larger components raise an error.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), "x", anchors.alias("asked")), "vectors")
    largest = F.max(F.coalesce(F.array_max(F.transform("x", lambda v: F.abs(v.cast("double")))), F.lit(0.0)))
    facts = vectors.agg(F.max(F.size("x")).alias("width"), largest.alias("largest")).first()
    width = max(1, facts["width"] or 0)
    most = width * float(facts["largest"] or 0) ** 2
    if most * max(low, high) >= 2**62:
        raise ValueError("the components are too large for scores in 64 bits")
    exact = np.float64 if most < 2**53 else np.int64

    one = F.min(F.struct("label", "x")).alias("v")
    asked = vectors.filter("asked").groupBy("vec_id").agg(one).select("vec_id", "v.label", "v.x")
    asked, blocks = _dealt(stage(asked, "anchors"), width)
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not blocks:
        return spark.createDataFrame([], result)
    tiles = _tiles(vectors, width)

    def first(found: DataFrame, k: int, *names: str) -> DataFrame:
        order = Window.partitionBy(*names).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    liked = stage(first(_searched(asked, tiles, blocks, width, positives, exact), positives, "anchor_id"), "positives")
    least = F.ceil(F.col("score") * low / F.lit(100).cast("decimal(3,0)")).cast("bigint")
    top = F.floor(F.col("score") * high / F.lit(100).cast("decimal(3,0)")).cast("bigint")
    one_window = F.struct("vec_id", "score", least.alias("least"), top.alias("most"))
    windows = liked.groupBy("anchor_id").agg(F.sort_array(F.collect_set(one_window)).alias("w")).select(
        F.col("anchor_id").alias("vec_id"), F.col("w.vec_id").alias("positives"), F.col("w.score").alias("scores"),
        F.col("w.least").alias("least"), F.col("w.most").alias("most"),
    )
    windowed = stage(asked.join(windows, "vec_id"), "anchors-with-windows")
    found = _searched(windowed, tiles, blocks, width, negatives, exact)
    return first(found, negatives, "anchor_id", "positive_id", "positive_score").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
