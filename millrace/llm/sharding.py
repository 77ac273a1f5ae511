"""Sharding by Karmarkar-Karp differencing over indivisible groups of equal texts."""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import salted_rank, salts_for, stored

#: A group over 1/BIG_SHARE of all bytes is an item of its own, so there are fewer than BIG_SHARE of them.
BIG_SHARE = 16_384
#: The other groups are hashed into this many bundles, each an item.
BUNDLES = 4_096


def karmarkar_karp(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item, by differencing: the two partial partitions with the largest spreads are
    combined, one in falling and the other in rising order, until one is left. Ties go to the earlier item."""
    if not sizes:
        return []
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(shards, np.int64)
        sums[0] = s
        heap.append((-int(s) if shards > 1 else 0, i, sums, [i, *[None] * (shards - 1)]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        (_, _, a, a_in), (_, _, b, b_in) = heapq.heappop(heap), heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        both = [x if y is None else y if x is None else (x, y) for x, y in zip(a_in, reversed(b_in), strict=True)]
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), made, sums, [both[k] for k in order]))
        made += 1
    shard_of = [0] * len(sizes)
    for shard, tree in enumerate(heap[0][3]):
        todo = [] if tree is None else [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                shard_of[x] = shard
    return shard_of


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Each row's shard and place in it, all rows of equal text in one shard and the shards' bytes near equal.

    Large groups (over total/BIG_SHARE bytes: fewer than BIG_SHARE) and BUNDLES hash bundles of the small ones
    are the items of the differencing; so the driver's work and what it broadcasts are bounded whatever the
    input, and the balance is as fine as a bundle. Bundles never cut a group.

    A null text counts as an empty one: size `overhead`, crc32 0. Null or repeated ids are kept, each row with a
    slot of its own. An empty table gives an empty result.
    Returns doc_id, size, text_crc32, shard, slot (gapless from 0 in its shard).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("_group"),
        ),
        "sized",
    )
    n, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    bundle = F.pmod(F.xxhash64("_group"), F.lit(BUNDLES)).cast("int")
    least = total // BIG_SHARE + 1
    groups = stored(sized.groupBy("_group").agg(F.sum("size").alias("bytes")), "groups")
    big = groups.filter(F.col("bytes") >= least).orderBy("_group").collect()  # fewer than BIG_SHARE rows
    rest = groups.filter(F.col("bytes") < least).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes")).orderBy("bundle").collect()  # BUNDLES rows at most
    put = karmarkar_karp([r["bytes"] for r in big] + [r["bytes"] for r in rest], shards)
    of_bundle = [0] * BUNDLES
    for r, s in zip(rest, put[len(big) :], strict=True):
        of_bundle[r["bundle"]] = s
    large = spark.createDataFrame([(r["_group"], s) for r, s in zip(big, put, strict=False)], "_group string, _big int")
    small = spark.createDataFrame(list(enumerate(of_bundle)), "_bundle int, _small int")
    placed = (
        sized.withColumn("_bundle", bundle)
        .join(F.broadcast(large), "_group", "left")
        .join(F.broadcast(small), "_bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("_big", "_small").cast("int").alias("shard"))
    )
    return salted_rank(placed, ["shard"], ["doc_id", "text_crc32", "size"], salts_for(n // max(1, shards)), "slot")
