"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a list of sums, one per shard. The two partial partitions of the largest spread
are combined again and again, one in descending and one in ascending order, until one is left.

More than ``BUCKET`` groups are first dealt to buckets by a hash. Each bucket, in a task of its own, is
differenced into ``BINS`` bins, and its smallest groups, ``FINE`` of its weight, into as many fine ones; the
bins are the indivisible items of the next round, in which the fine ones even out what the others
leave. The last round differences at most ``BUCKET`` items into the shards, in one task. The driver sees
neither groups nor bins.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise, shuffle_partitions, small

BUCKET, BINS, FINE = 20_000, 96, 0.05


def difference(weights: list[int], k: int) -> list[int]:
    """The part, 0 to ``k - 1``, of each weight. Ties go to the earlier item, so the result is determined."""
    n = len(weights)
    sums = {i: [w] + [0] * (k - 1) for i, w in enumerate(weights)}
    made: list[tuple[int, int, list[int]]] = []
    heap = [(-w if k > 1 else 0, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        met = sorted(((x + y, j) for j, (x, y) in enumerate(zip(sums.pop(a), reversed(sums.pop(b)), strict=True))), reverse=True)
        node = n + len(made)
        made.append((a, b, [j for _, j in met]))
        sums[node] = [s for s, _ in met]
        heapq.heappush(heap, (met[-1][0] - met[0][0], node))
    parts = [0] * n
    open_ = [(heap[0][1], list(range(k)))] if heap else []
    while open_:  # what stands at a place of a node goes to the part that the list has there
        node, at = open_.pop()
        if node < n:
            parts[node] = at[0]
            continue
        a, b, order = made[node - n]
        left = [0] * k
        for place, j in enumerate(order):
            left[j] = at[place]
        open_ += [(a, left), (b, left[::-1])]
    return parts


def _round(items: DataFrame, buckets: int, shards: int) -> DataFrame:
    """``item, weight`` with ``parent``: the bin that each goes to, or the shard if there is one bucket."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "item"], ascending=[False, True])
        weights = group["weight"].tolist()
        if buckets == 1:
            group["parent"] = difference(weights, shards)
        else:
            fine = int((group["weight"][::-1].cumsum() <= FINE * group["weight"].sum()).sum())
            coarse = len(weights) - fine
            parts = difference(weights[:coarse], BINS) + [BINS + p for p in difference(weights[coarse:], BINS)]
            group["parent"] = group["bucket"] * 2 * BINS + parts
        return group[["item", "weight", "parent"]]

    dealt = items.withColumn("bucket", F.expr(f"pmod(xxhash64(item, 7), {buckets})"))
    return materialise(dealt.groupBy("bucket").applyInPandas(run, "item long, weight long, parent long"), "bins")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    Documents of equal text stay together; sizes are UTF-8 bytes plus one. Null texts count as empty
    ones, and with them. A group larger than a fair share is alone in its shard as far as that goes.
    Slots run from 0 in each shard by ascending id (null first). Rows that repeat an id have slots of their own; an
    empty table gives no rows; other columns are not read; texts count whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text, F.octet_length(text)).alias("item"))
    base = materialise(base.withColumn("row", F.monotonically_increasing_id()), "sizes")
    rows = base.count()
    items = base.groupBy("item").agg(F.sum("size").alias("weight"))
    rounds, count = [], rows
    while not rounds or buckets > 1:
        buckets = max(1, -(-count // BUCKET))
        rounds.append(_round(items, buckets, shards))
        items = rounds[-1].groupBy(F.col("parent").alias("item")).agg(F.sum("weight").alias("weight"))
        count = buckets * 2 * BINS
    at = rounds.pop().select("item", F.col("parent").cast("int").alias("shard"))
    while rounds:
        at = rounds.pop().join(at.withColumnRenamed("item", "parent"), "parent").select("item", "shard")
    # a group of many rows is split by the skew handling of the join
    sharded = base.join(at, "item").select("doc_id", "size", "text_crc32", "shard", "row")

    # slots: places in each range of a shard, and the rows of the shard in the ranges before
    order = ["shard", F.col("doc_id").asc_nulls_first(), "text_crc32", "row"]
    parts = max(shuffle_partitions(docs.sparkSession), rows // 200_000)
    ranged = materialise(sharded.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    before = small(materialise(before, "before"))  # a row for each range, and one more for each shard
    own = Window.partitionBy("part", "shard").orderBy(*order[1:])
    return ranged.join(before, ["part", "shard"]).select("doc_id", "size", "text_crc32", "shard", (F.row_number().over(own) - 1 + F.col("before")).alias("slot"))
