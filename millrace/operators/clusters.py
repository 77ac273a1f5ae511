"""Greedy leader clustering in rounds: leaders of a bounded stretch at a time, all other work in pairs of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.operators.staging import staged

#: Undecided rows of a block that a task goes through in order, at most about; rows that it compares at once.
STRETCH, SLICE = 16_384, 1_024
#: Rows of either side of a pair of blocks.
BLOCK_ROWS = 8_192
#: Rows whose undecided ones are counted together when the next stretch is chosen.
BUCKET = 512
#: Places that similarities are rounded to, so that equal ones are ties however products are blocked.
PLACES = 12


def ranked_in(df: DataFrame, key: str, order: list[str], name: str = "k") -> DataFrame:
    """df, sorted by ranges of the key and `order`, with each row's place in its key, from 0 without gaps.

    Only counts by partition and key are added up, so a key's rows may lie in many partitions. Null keys are a key; rows
    that tie in the order are exchangeable."""
    part, own = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_own")
    cut = staged(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select("*", part, own))
    counts = cut.groupBy(F.struct("_part", F.struct(key).alias("key")).alias("_at")).agg(F.min("_own").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_at.key").orderBy("_at._part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("_at", (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_add"))
    return cut.withColumn("_at", F.struct("_part", F.struct(key).alias("key"))).join(first, "_at").select(*df.columns, (F.col("_own") + F.col("_add")).alias(name))


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    one = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(one):
        return np.zeros((0, 0))
    return one.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(one), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(a @ b.T, PLACES)


class _Leaders:
    """Leaders of a stretch of a block so far, in a growing array."""

    def __init__(self):
        self.names: list = []
        self.rows = np.zeros((0, 0))

    def take(self, names: list, vectors: np.ndarray, limits: np.ndarray) -> tuple[list, list[float]]:
        """Leaders and similarities of the next rows in order.

        Similarities to all earlier leaders come from one matrix product, those among the rows from another; what is
        left to do row by row is to choose."""
        used = len(self.names)
        best, at = np.full(len(names), -np.inf), np.zeros(len(names), np.int64)
        if used:
            sims = _products(vectors, self.rows[:used])
            at = sims.argmax(1)
            best = sims[np.arange(len(names)), at]
        own = _products(vectors, vectors)
        lead, found, new = [], [], []
        for r, name in enumerate(names):
            score, leader = best[r], self.names[at[r]] if used else None
            if new and (mine := own[r, new]).max() > score:  # of equals the earlier leader
                score, leader = mine.max(), names[new[int(mine.argmax())]]
            if score >= limits[r]:
                lead.append(leader)
                found.append(float(score))
            else:
                new.append(r)
                lead.append(name)
                found.append(1.0)
        if used + len(new) > len(self.rows):
            grown = np.zeros((2 * (used + len(new)), vectors.shape[1]))
            if used:
                grown[:used] = self.rows[:used]
            self.rows = grown
        self.rows[used : used + len(new)] = vectors[new]
        self.names += [names[r] for r in new]
        return lead, found


def _along(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Clusters stretches of blocks that stream in order: at, o, k, v, limit in; leader and similarity added, v kept for leaders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, leaders = object(), _Leaders()
        for batch in batches:
            ats = [x["block"] for x in batch.column("at").to_pylist()]
            names, lead, sims, lo = batch.column("o").to_pylist(), [], [], 0
            vectors, limits = batch.column("v"), batch.column("limit").to_numpy()
            while lo < len(ats):
                if ats[lo] != block:
                    block, leaders = ats[lo], _Leaders()
                hi = lo + 1
                while hi < min(len(ats), lo + SLICE) and ats[hi] == block:
                    hi += 1
                got = leaders.take(names[lo:hi], _vectors(vectors.slice(lo, hi - lo)), limits[lo:hi])
                lead += got[0]
                sims += got[1]
                lo = hi
            leads = pa.array([a == b for a, b in zip(names, lead, strict=True)])
            kept = pa.compute.if_else(leads, vectors, pa.scalar(None, vectors.type))
            columns = [batch.column("at"), batch.column("o"), batch.column("k"), kept, pa.array(lead, batch.column("o").type), pa.array(sims, pa.float64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _declared(ddl: str) -> pa.Schema:
    """The Arrow schema of a declared result. Spark compares nested types to the letter: blocks or vectors of the input that
    can't be null have other types than the declared ones, so results are cast."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def _fallen(rows: pa.Table, leaders: pa.Table, schema: pa.Schema) -> pa.Table:
    """Rows with a mark: whether a leader of the last stretch takes them."""
    v, limit = _vectors(rows.column("v")), rows.column("limit").to_numpy()
    others, hit = _vectors(leaders.column("v")), np.zeros(rows.num_rows, bool)
    for at in range(0, len(v) if len(others) else 0, SLICE):
        hit[at : at + SLICE] = _products(v[at : at + SLICE], others).max(1) >= limit[at : at + SLICE]
    return rows.select(["at", "o", "k", "v", "limit"]).append_column("fallen", pa.array(hit)).cast(schema)


def _nearest(rows: pa.Table, leaders: pa.Table, schema: pa.Schema) -> pa.Table:
    """The best earlier leader of a block for each row, the first of equals: at, o, similarity, nth, leader."""
    if not rows.num_rows or not leaders.num_rows:
        return schema.empty_table()
    leaders = leaders.sort_by("k")
    v, k, others, places = _vectors(rows.column("v")), rows.column("k").to_numpy(), _vectors(leaders.column("v")), leaders.column("k").to_numpy()
    best, which = np.full(len(v), -np.inf), np.zeros(len(v), np.int64)
    for at in range(0, len(v), SLICE):
        part = slice(at, at + SLICE)
        sims = np.where(places[None, :] < k[part, None], _products(v[part], others), -np.inf)
        which[part] = sims.argmax(1)
        best[part] = sims.max(1)
    some = pa.array(np.flatnonzero(best > -np.inf))
    at_leader = pa.array(which[best > -np.inf])
    columns = [rows.column("at").take(some), rows.column("o").take(some), pa.array(best[best > -np.inf]), leaders.column("k").take(at_leader), leaders.column("o").take(at_leader)]
    return pa.table(columns, names=schema.names).cast(schema)


def _sliced(df: DataFrame, parts: DataFrame, n: str, name: str) -> DataFrame:
    """df with a slice `name` of its block, of about BLOCK_ROWS rows; parts: at and the number of slices n."""
    return df.join(parts, "at").withColumn(name, F.pmod(F.xxhash64("o"), F.col(n)).cast("int")).drop(n)


def _slices(df: DataFrame, n: str) -> DataFrame:
    return df.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(n))


def _every(df: DataFrame, parts: DataFrame, n: str, name: str) -> DataFrame:
    """df's rows once for each slice of their block."""
    return df.join(parts, "at").select(*df.columns, F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name))


def leader_clusters(rows: DataFrame, block: str, order: str, vector: str, threshold: float | str) -> DataFrame:
    """Greedy leader clustering of unit vectors within blocks: block, order, leader (an order value) and similarity.

    In order, a row joins the leader most similar to it if that is `threshold` (a number or a column) or more,
    the earlier of equals, else it leads a new cluster; leaders never change. Similarities are rounded to PLACES.

    So the leaders are the first maximal set of rows that take none of each other, and are found in rounds. A round goes
    through the next stretch of each block's undecided rows in order, STRETCH of them at most, in one task a block; its
    leaders are then compared with all undecided rows behind it in pairs of blocks of BLOCK_ROWS, and the rows that they
    take are decided. The next stretch follows what is left, so rounds grow with the number of leaders of the largest
    block, not with its rows. Rows that were taken so choose among all leaders before them, in pairs of blocks too. No
    task holds a block or its leaders; tables between rounds are checkpoints in the shared folder.

    A row without a vector leads itself alone, with a null similarity; null blocks are a block; order values have to be
    different within a block; an empty table gives an empty result. Other columns' names don't matter."""
    limit: Column = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    one = rows.select(F.col(block).alias("block"), F.col(order).alias("o"), F.col(vector).alias("v"), limit.cast("double").alias("limit"))
    kinds = dict(one.dtypes)
    alone = one.filter("v is null").select(F.col("block").alias(block), F.col("o").alias(order), F.col("o").alias("leader"), F.lit(None).cast("double").alias("similarity"))
    open_ = ranked_in(one.filter("v is not null"), "block", ["o"]).select(F.struct("block").alias("at"), "o", "k", "v", "limit")
    ddl = f"at struct<block:{kinds['block']}>, o {kinds['o']}, k bigint, v {kinds['v']}"
    clustered, marked = f"{ddl}, leader {kinds['o']}, similarity double", f"{ddl}, limit double, fallen boolean"
    schema, marked_schema = _declared(clustered), _declared(marked)
    decided, taken = [], []
    open_ = staged(open_)
    while True:
        buckets = open_.groupBy("at", F.floor(F.col("k") / BUCKET).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        so_far = F.sum("n").over(Window.partitionBy("at").orderBy("bucket"))
        first = F.row_number().over(Window.partitionBy("at").orderBy("bucket")) == 1
        bounds = buckets.select("at", "bucket", ((so_far <= STRETCH) | first).alias("near")).filter("near").groupBy("at").agg(F.max("bucket").alias("upto"))
        cut = open_.join(bounds, "at").withColumn("near", F.floor(F.col("k") / BUCKET) <= F.col("upto")).drop("upto")
        stretch = cut.filter("near").select("at", "o", "k", "v", "limit").repartition("at").sortWithinPartitions("at", "k")
        found = staged(stretch.mapInArrow(_along(schema), clustered))
        decided.append(found)
        rest = cut.filter("not near").drop("near")
        if not rest.limit(1).count():
            break
        leaders = found.filter("v is not null").select("at", "o", "k", "v")
        rest = staged(rest)
        parts = _slices(rest, "n")
        left, right = _sliced(rest, parts, "n", "slice"), _every(leaders, parts, "n", "slice")
        met = staged(left.groupBy("at", "slice").cogroup(right.groupBy("at", "slice")).applyInArrow(lambda a, b: _fallen(a, b, marked_schema), marked))
        taken.append(met.filter("fallen").drop("fallen"))
        open_ = met.filter("not fallen").drop("fallen")
        if not open_.limit(1).count():
            break
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    result = out.select("at", "o", "leader", "similarity")
    if taken:
        leaders, followers = out.filter("v is not null").select("at", "o", "k", "v"), taken[0]
        for more in taken[1:]:
            followers = followers.unionByName(more)
        mine, theirs = _slices(followers, "n"), _slices(leaders, "m")
        left = _every(_sliced(followers.drop("limit"), mine, "n", "slice"), theirs, "m", "other")
        right = _every(_sliced(leaders, theirs, "m", "other"), mine, "n", "slice")
        best = f"at struct<block:{kinds['block']}>, o {kinds['o']}, similarity double, nth bigint, leader {kinds['o']}"
        best_schema = _declared(best)
        pairs = left.groupBy("at", "slice", "other").cogroup(right.groupBy("at", "slice", "other")).applyInArrow(lambda a, b: _nearest(a, b, best_schema), best)
        chosen = pairs.groupBy("at", "o").agg(F.max_by(F.struct("leader", "similarity"), F.struct("similarity", -F.col("nth"))).alias("b"))
        result = result.unionByName(chosen.select("at", "o", "b.leader", "b.similarity"))
    return result.select(F.col("at.block").alias(block), F.col("o").alias(order), "leader", "similarity").unionByName(alone)
