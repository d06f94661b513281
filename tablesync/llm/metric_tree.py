"""Exact top-k inner products by best-first search in paged M-trees.

Vectors get one more component that gives all of them the same norm; the largest inner products
of a query (with 0 there) are then its smallest Euclidean distances, a metric. Around pivots the
vectors are put into groups of bounded size, each an M-tree: pages with a routing object, a
covering radius and the distance to the group's pivot, and in them entries with their distance
to the page's routing object. A query goes through a group's pages in order of their least
possible distance and stops when that exceeds its k-th best; pages and entries that the stored
distances rule out by the triangle inequality are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import map_arrow
from tablesync.sinks.files import stage

#: Pivots: this many vectors with the smallest hashes of their ids, whatever the number of rows.
PIVOTS = 64
#: Vectors in a group, about, and in a page at most.
GROUP, PAGE = 4096, 128
#: Queries in a block.
BLOCK = 512
#: Relative slack of a bound, for rounding.
SLACK = 1e-9


def integer_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and x, the components as floor(scale * component); rows with a null vector or a
    null or non-finite component are left out."""
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(value, lambda x: F.floor(x * scale))
    return table.select("vec_id", F.when(value.isNotNull() & finite, whole).alias("x")).filter("x is not null and vec_id is not null")


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = flat
    return out


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """The vectors with the component that makes all norms `norm`, a squared norm."""
    points = x.astype(np.float64)
    return np.c_[points, np.sqrt(np.maximum(norm - (points**2).sum(axis=1), 0))]


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def _unpack(blob: bytes, kind: type, width: int = 1) -> np.ndarray:
    values = np.frombuffer(blob, kind)
    return values.reshape(-1, width) if width > 1 else values


def build_group(ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, norm: float) -> dict[str, bytes]:
    """The M-tree of a group as byte columns, its entries page by page.

    Pages are cut by distance from the pivot, then by distance from the farthest vector of each
    ring, so that a page's vectors are close to each other. The routing object is the page's
    vector with the smallest covering radius among a few.
    """
    points = _lifted(x, norm)
    rings = max(1, int(np.sqrt(-(-len(ids) // PAGE))))
    order = np.lexsort((ids, _distances(points, pivot)))
    pages = []
    for ring in np.array_split(order, rings):
        far = points[ring[-1]] if len(ring) else pivot
        ring = ring[np.lexsort((ids[ring], _distances(points[ring], far)))]
        pages += [ring[a : a + PAGE] for a in range(0, len(ring), PAGE)]
    routing, radius, parent, sizes, far = [], [], [], [], []
    for page in pages:
        tried = page[:: max(1, len(page) // 8)]
        away = [_distances(points[page], points[t]) for t in tried]
        best = int(np.argmin([a.max() for a in away]))
        routing.append(points[tried[best]])
        radius.append(away[best].max())
        parent.append(np.sqrt(((points[tried[best]] - pivot) ** 2).sum()))
        sizes.append(len(page))
        far.append(away[best])
    entries = np.concatenate(pages)
    return {
        "pivot": pivot.tobytes(), "routing": np.array(routing).tobytes(), "radius": np.array(radius).tobytes(),
        "parent": np.array(parent).tobytes(), "sizes": np.array(sizes, np.int64).tobytes(), "ids": ids[entries].tobytes(),
        "x": x[entries].tobytes(), "far": np.concatenate(far).tobytes(),
    }


_GROUP_SCHEMA = "grp bigint, pivot binary, routing binary, radius binary, parent binary, sizes binary, ids binary, x binary, far binary"


def search_group(group: dict, queries: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, norm: float, width: int):
    """For each query (ids, vectors, scores that the k-th best reaches at least) the best of the
    group that may be among its k best: lists of query id, vector id, score."""
    pivot, routing = _unpack(group["pivot"], np.float64), _unpack(group["routing"], np.float64, width + 1).reshape(-1, width + 1)
    radius, parent, sizes = (_unpack(group[c], t) for c, t in (("radius", np.float64), ("parent", np.float64), ("sizes", np.int64)))
    ids, x, far = _unpack(group["ids"], np.int64), _unpack(group["x"], np.int64).reshape(-1, width), _unpack(group["far"], np.float64)
    begin = np.r_[0, np.cumsum(sizes)]
    out: list[tuple[int, int, int]] = []
    for query, vector, floor in zip(*queries, strict=True):
        point = np.r_[vector.astype(np.float64), 0.0]
        square = float((point**2).sum())
        slack = SLACK * np.sqrt(norm + square)

        def reach(score: float) -> float:
            """The distance within which a vector's score is at least this."""
            return np.sqrt(max(norm + square - 2 * score, 0)) + slack

        to_pivot = np.sqrt(((point - pivot) ** 2).sum())
        least = np.abs(to_pivot - parent) - radius
        limit = reach(floor)
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for page in np.argsort(least, kind="stable"):
            if least[page] > limit:
                break
            to_page = np.sqrt(((point - routing[page]) ** 2).sum())
            if to_page - radius[page] > limit:
                continue
            rows = np.arange(begin[page], begin[page + 1])
            rows = rows[np.abs(to_page - far[rows]) <= limit]
            rows = rows[ids[rows] != query]
            if not len(rows):
                continue
            best = np.r_[best, x[rows] @ vector]
            best_ids = np.r_[best_ids, ids[rows]]
            if len(best) > k:
                order = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[order], best_ids[order]
            if len(best) == k:
                limit = reach(max(floor, int(best.min())))
        out += [(int(query), int(i), int(s)) for i, s in zip(best_ids, best, strict=True)]
    return out


def top_k(vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of `vectors` (vec_id, x: integers)
    that `queries` selects, the k other rows with the largest integer inner products.

    Ties go to the smaller vec_id; with fewer other rows all are returned. A row is no answer
    to the query with its own vec_id. Shorter vectors count as ended by zeros. Repeated rows
    are answers each, and a repeated query id is answered once for its first vector. An empty table
    gives an empty table.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x"), "vectors")
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v)
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(square).alias("norm")).first()
    width, norm = max(1, facts["width"] or 0), float(facts["norm"] or 0.0)

    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, 1 + facts["n"] // PAGE)).toArrow().combine_chunks()
    seeds = sample.column("x").combine_chunks() if len(sample) else pa.array([], pa.list_(pa.int64()))
    seed_x = _rows(seeds, width)
    seed_ids = sample.column("vec_id").to_numpy()
    pivots = spark.sparkContext.broadcast((seed_ids, seed_x, _lifted(seed_x, norm)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = pivots.value[2]
        half = (points**2).sum(axis=1) / 2
        for batch in batches:
            x = _rows(batch.column("x"), width)
            closest = np.argmax(_lifted(x, norm) @ points.T - half, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(closest)], ["vec_id", "x", "pivot"])

    dealt = map_arrow(vectors, nearest, "vec_id bigint, x array<bigint>, pivot bigint")
    dealt = stage(dealt, "vectors-by-pivot")
    parts = {r["pivot"]: max(1, round(r["count"] / GROUP)) for r in dealt.groupBy("pivot").count().collect()}
    first, last = {}, 0
    for pivot, count in sorted(parts.items()):
        first[pivot], last = last, last + count
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    begin = F.element_at(F.array(*(F.lit(first.get(p, 0)) for p in range(PIVOTS))), F.col("pivot").cast("int") + 1)
    count = F.element_at(F.array(*(F.lit(parts.get(p, 1)) for p in range(PIVOTS))), F.col("pivot").cast("int") + 1)
    dealt = dealt.withColumn("grp", (begin + F.pmod(F.xxhash64("vec_id", "x"), count)).cast("bigint"))

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        x = _rows(pa.array(frame["x"].tolist(), pa.list_(pa.int64())), width)
        group = build_group(frame["vec_id"].to_numpy(), x, pivots.value[2][frame["pivot"].iloc[0]], norm)
        return pd.DataFrame([{"grp": frame["grp"].iloc[0], **group}])

    groups = stage(dealt.groupBy("grp").applyInPandas(built, _GROUP_SCHEMA), "metric-tree")

    asked = stage(vectors.filter(queries).groupBy("vec_id").agg(F.min("x").alias("x")), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))

    def bounded(frame: pd.DataFrame) -> pd.DataFrame:
        """A block of queries with the scores that their k best reach among the pivots alone."""
        x = _rows(pa.array(frame["x"].tolist(), pa.list_(pa.int64())), width)
        ids = frame["vec_id"].to_numpy()
        scores = x @ pivots.value[1].T
        least = np.iinfo(np.int64).min // 4
        scores[ids[:, None] == pivots.value[0][None, :]] = least
        floor = np.full(len(ids), least)
        if scores.shape[1] >= k:
            floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        return pd.DataFrame([{"block": frame["block"].iloc[0], "q_ids": ids.tobytes(), "q_x": x.tobytes(), "floor": floor.tobytes()}])

    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asked = asked.groupBy("block").applyInPandas(bounded, "block bigint, q_ids binary, q_x binary, floor binary")
    # every block of queries meets every group: the query set against all rows, in blocks
    asked = asked.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last - 1).cast("bigint"))))
    units = asked.repartition("grp", "block").join(groups.hint("shuffle_hash"), "grp")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = (_unpack(row["q_ids"], np.int64), _unpack(row["q_x"], np.int64).reshape(-1, width), _unpack(row["floor"], np.int64))
                found = np.array(search_group(row, block, k, norm, width), np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], ["query_id", "vec_id", "score"])

    found = map_arrow(units, searched, "query_id bigint, vec_id bigint, score bigint")
    # the best of each task are kept before they meet, so no query's answers of all groups come to one task
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
