"""An approximate index: layered neighbour graphs of parts of the vectors, searched best first, answers merged."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Vectors of a part, about; rows of it that are compared with all others at once.
PART_ROWS, SLICE = 20_000, 1_024

#: A row a vector: its part, its place in it, the highest layer that it is in, its neighbours (places) in each layer.
GRAPH = "part int, place int, pos bigint, vector array<float>, top int, neighbours array<array<int>>"


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    one = column.combine_chunks()
    return one.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(one), -1) if len(one) else np.zeros((0, 0), np.float32)


def chosen(place: int, near: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> list[int]:
    """Of candidates, nearest first, those that are nearer to the row than to any chosen before, then the nearest others."""
    kept: list[int] = []
    for c, s in zip(near.tolist(), sims.tolist(), strict=True):
        if len(kept) == most:
            break
        if c != place and (not kept or float((vectors[kept] @ vectors[c]).max()) < s):
            kept.append(c)
    for c in near.tolist():
        if len(kept) == most:
            break
        if c != place and c not in kept:
            kept.append(c)
    return kept


def layer_graph(members: np.ndarray, vectors: np.ndarray, m: int, construction: int) -> dict[int, list[int]]:
    """Neighbours of a layer's members: `m` chosen of the `construction` nearest, and the reverse of these links, 2 m at most."""
    links: dict[int, list[int]] = {int(i): [] for i in members}
    if len(members) < 2:
        return links
    own = vectors[members]
    width = min(construction + 1, len(members))
    back: dict[int, list[int]] = {int(i): [] for i in members}
    for at in range(0, len(members), SLICE):
        sims = own[at : at + SLICE] @ own.T
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        some = np.take_along_axis(sims, near, 1)
        order = np.argsort(-some, axis=1, kind="stable")
        near, some = np.take_along_axis(near, order, 1), np.take_along_axis(some, order, 1)
        for r in range(len(near)):
            i = int(members[at + r])
            links[i] = chosen(i, members[near[r]], some[r], vectors, m)
            for j in links[i]:
                back[j].append(i)
    for i, more in back.items():
        extra = [j for j in more if j not in links[i]]
        if len(extra) > 2 * m - len(links[i]):
            extra = [extra[k] for k in np.argsort(-(vectors[extra] @ vectors[i]), kind="stable")[: 2 * m - len(links[i])]]
        links[i] = links[i] + extra
    return links


def build_graph(index: DataFrame, pos: str = "pos", vector: str = "embedding", m: int = 32, construction: int = 200, part_rows: int = PART_ROWS) -> DataFrame:
    """The index's graph as rows (GRAPH): a hash of the position deals vectors to parts of about `part_rows`, and each
    part is one task, which compares its vectors in blocks and keeps `m` neighbours of the `construction` nearest in each
    layer. A vector is in layer 0, and in each higher one with a probability of 1 / m, by a hash.

    Rows without a vector or position take no part; equal vectors are all in; an empty table gives an empty graph."""
    rows = index.select(F.col(pos).cast("bigint").alias("pos"), F.col(vector).cast("array<float>").alias("vector")).filter("pos is not null and vector is not null")
    parts = max(1, math.ceil(rows.count() / part_rows))
    unit = (F.pmod(F.xxhash64(F.lit("level"), "pos"), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30))
    dealt = rows.select(F.pmod(F.xxhash64("pos"), F.lit(parts)).cast("int").alias("part"), "pos", "vector", F.floor(-F.log(unit) / math.log(m)).cast("int").alias("top"))
    schema = to_arrow_schema(StructType.fromDDL(GRAPH))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        vectors, top = _vectors(table.column("vector")), table.column("top").to_numpy()
        layers = [layer_graph(np.flatnonzero(top >= k), vectors, m, construction) for k in range(int(top.max()) + 1)]
        neighbours = [[layers[k][i] for k in range(int(t) + 1)] for i, t in enumerate(top.tolist())]
        columns = [table.column("part"), pa.array(np.arange(len(top)), pa.int32()), table.column("pos"), table.column("vector"), table.column("top"), pa.array(neighbours)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return dealt.groupBy("part").applyInArrow(build, GRAPH)


def best_first(query: np.ndarray, vectors: np.ndarray, neighbours: list[list[list[int]]], entry: int, top: int, width: int) -> list[tuple[float, int]]:
    """The `width` best places that a search finds: greedy steps down the layers, then a frontier in layer 0."""
    at, best = entry, float(vectors[entry] @ query)
    for layer in range(top, 0, -1):
        while near := neighbours[at][layer]:
            sims = vectors[near] @ query
            k = int(sims.argmax())
            if sims[k] <= best:
                break
            at, best = near[k], float(sims[k])
    seen, frontier, found = {at}, [(-best, at)], [(best, at)]
    while frontier:
        s, i = heapq.heappop(frontier)
        if -s < found[0][0] and len(found) >= width:
            break
        near = [j for j in neighbours[i][0] if j not in seen]
        if not near:
            continue
        seen.update(near)
        for s, j in zip((vectors[near] @ query).tolist(), near, strict=True):
            if len(found) < width or s > found[0][0]:
                heapq.heappush(frontier, (-s, j))
                heapq.heappush(found, (s, j))
                if len(found) > width:
                    heapq.heappop(found)
    return found


def search_graph(queries: DataFrame, graph: DataFrame, k: int, query_id: str = "query_id", query_vector: str = "vector", width: int = 64) -> DataFrame:
    """About the k vectors with the greatest inner products for each query: query_id, pos, score, rank; ties to the smaller pos.

    Each query meets each part of the graph in a task of the part and a slice of the queries; a part gives its k best of
    the `width` that its search keeps, and these are merged. Queries without a vector get no rows; fewer than k rows give
    all that a search reaches; an empty graph or query set gives an empty result."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<float>").alias("q")).filter("q is not null")
    slices = max(1, math.ceil(asked.count() / 4_096))
    parts = graph.select(F.expr("part + 0").alias("part")).distinct()
    left = asked.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int"))
    left = parts.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).join(left, "slice")
    right = graph.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    kind = dict(asked.dtypes)["query_id"]
    ddl = f"query_id {kind}, pos bigint, score double"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def search(q: pa.Table, rows: pa.Table) -> pa.Table:
        if not q.num_rows or not rows.num_rows:
            return schema.empty_table()
        rows = rows.sort_by("place")
        vectors, top, neighbours, places = _vectors(rows.column("vector")), rows.column("top").to_numpy(), rows.column("neighbours").to_pylist(), rows.column("pos").to_numpy()
        entry = int(top.argmax())
        out: list[tuple] = []
        for i, v in zip(q.column("query_id").to_pylist(), _vectors(q.column("q")), strict=True):
            found = best_first(v, vectors, neighbours, entry, int(top[entry]), max(width, k))
            exact = sorted(((float(np.float64(v) @ np.float64(vectors[j])), int(places[j])) for _, j in found), key=lambda x: (-x[0], x[1]))
            out += [(i, p, s) for s, p in exact[:k]]
        return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else schema.empty_table()

    by = ("part", "slice")
    hits = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, ddl)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "pos"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)
