"""Sources mixed to target weights by Poisson replication.

The rate of a source is its target share of the output over its size; each document is
repeated as often as a Poisson draw says, the draw being the inverse distribution function at
a number hashed from the seed and the document. The copies are then shuffled globally by a
second hash. No state is kept between rows, so a lost task is simply run again.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import quoted, unit_interval

#: Weight given to each of the named sources by the registered query; all others share REST.
SOURCE_WEIGHTS = {
    "src0": 0.10, "src1": 0.09, "src2": 0.08, "src3": 0.07, "src4": 0.06, "src5": 0.06,
    "src6": 0.05, "src7": 0.05, "src8": 0.05, "src9": 0.05, "src10": 0.05, "src11": 0.05,
}
REST = 0.24
SEED = 20


def poisson_steps(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it is 1 to double precision."""
    if rate <= 0:
        return [1.0]
    steps, total, k = [], 0.0, 0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        steps.append(min(total, 1.0))
        if k > rate and (1 - total < 1e-16 or total == steps[-2]):
            return steps
        k += 1


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], rest: float, size: Column, total: float | None = None
) -> dict[str | None, float]:
    """The mean number of copies for each named source, and under None for all others.

    One aggregation over the named sources and the pooled rest: its result has at most
    `len(weights) + 1` rows, however many sources there are.
    """
    pool = F.when(F.col("source").isin(*weights), F.col("source")) if weights else F.lit(None).cast("string")
    sizes = {r["pool"]: int(r["size"] or 0) for r in docs.groupBy(pool.alias("pool")).agg(F.sum(size).alias("size")).collect()}
    shares = {**weights, None: rest}
    live = sum(w for s, w in shares.items() if sizes.get(s))
    wanted = float(sum(sizes.values()) if total is None else total)
    return {s: w / live * wanted / sizes[s] for s, w in shares.items() if sizes.get(s) and live}


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] = SOURCE_WEIGHTS,
    rest: float = REST,
    seed: int = SEED,
    total: float | None = None,
) -> DataFrame:
    """`docs` with each row repeated to meet the weights, in a global random order.

    `weights` maps values of the column source to shares of the output's size in bytes; all
    other sources, null among them, share `rest` in proportion to their sizes. `total` is the
    output's size (default: the input's). Added columns, replacing columns of these names:
    repeat_rate, n_copies, copy (from 0) and shuffle_key, a random number: it decides the
    partition of a copy and its place there, so the order is random without a global sort.

    A document counts the bytes of its text plus 1, so that null and empty texts, which are
    repeated like others, have a size. The draw depends on seed, doc_id, source and text:
    equal rows are repeated equally often, and rows with a null doc_id still differ. A source
    of weight 0 goes. An empty table gives an empty table.
    """
    added = ["repeat_rate", "n_copies", "copy", "shuffle_key"]
    columns = [c for c in docs.columns if c not in added]
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint") + 1
    rates = source_rates(docs, weights, rest, size, total)
    rate, steps = _by_source(rates)
    identity = (F.col("doc_id"), F.col("source"), F.md5(F.coalesce("text", F.lit(""))))
    draw = unit_interval(F.lit(seed), *identity)
    counted = (
        docs.select(*quoted(columns), rate.alias("repeat_rate"), draw.alias("_draw"), steps.alias("_steps"))
        .withColumn("n_copies", F.size(F.filter("_steps", lambda p: p < F.col("_draw"))))
        .filter("n_copies > 0")
    )
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    key = F.xxhash64(F.lit(seed), F.lit("order"), F.col("_draw"), F.col("copy"))
    keyed = copies.withColumn("shuffle_key", key)
    return keyed.select(*quoted(columns), *added).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _by_source(rates: Mapping[str | None, float]) -> tuple[Column, Column]:
    """Rate and distribution steps of a row's source, as expressions over literals."""
    rate = F.lit(rates.get(None, 0.0))
    steps = F.lit(poisson_steps(rates.get(None, 0.0)))
    for source, value in rates.items():
        if source is not None:
            own = F.col("source") == source
            rate = F.when(own, F.lit(value)).otherwise(rate)
            steps = F.when(own, F.lit(poisson_steps(value))).otherwise(steps)
    return rate, steps
