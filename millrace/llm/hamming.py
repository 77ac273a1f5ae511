"""Exact top-k search over binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

BITS = 64
#: Least bits of a segment; more where the index has more codes.
LEAST_BITS = 4


def sign_code(vector: Column) -> Column:
    """The signs of up to 64 dimensions as a 64-bit code, the first dimension the highest bit; null for null."""
    bit = lambda x: F.when(x > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.slice(vector, 1, BITS), F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(bit(x)))


def segments_for(codes: int) -> list[tuple[int, int]]:
    """Places and widths of the segments of a code, of about log2(codes) bits each: so a bucket holds about one code."""
    many = -(-BITS // max(LEAST_BITS, math.floor(math.log2(max(codes, 2)))))
    ends = [BITS * i // many for i in range(many + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _coded(rows: DataFrame, id_col: str, code: Column, k: int | None) -> DataFrame:
    """Different codes with all ids, or their k smallest and how many those are."""
    coded = rows.select(F.col(id_col).cast("long").alias("id"), code.alias("code")).filter("code is not null and id is not null")
    if k is None:
        return coded
    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    return coded.withColumn("_nth", nth).filter(F.col("_nth") <= k).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _segment(code: Column, span: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, span[0]).bitwiseAND(F.lit((1 << span[1]) - 1))


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _flips(width: int, radius: int) -> Column:
    """The patterns of a segment with `radius` bits, as one constant in the plan."""
    masks = [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>") if masks else F.array().cast("array<bigint>")


def probe(state: DataFrame, index: DataFrame, radius: int, k: int, spans: list[tuple[int, int]]) -> DataFrame:
    """The k nearest codes of each query among those not met before: code, new (distance, first, other, n).

    Each segment of a query is varied in `radius` bits, and the patterns are joined to the segments of the index. A
    code is verified where its nearest segment, the first of them, is met, so only once, and is kept if it isn't
    farther than the query's `most`."""
    parts = lambda c: F.posexplode(F.array(*[_segment(F.col(c), x) for x in spans])).alias("i", "part")
    flips = reduce(lambda rest, x: F.when(F.col("i") == x[0], _flips(x[1][1], radius)).otherwise(rest), list(enumerate(spans))[1:], _flips(spans[0][1], radius))
    asked = state.repartition("code").select("code", "most", parts("code"))
    asked = asked.select("code", "most", "i", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("part")))).alias("part"))
    entries = index.select(F.col("code").alias("other"), F.element_at("ids", 1).alias("first"), F.size("ids").alias("n"), parts("code"))
    # few rows become very many here, which the planner doesn't foresee: it must not broadcast them
    met = asked.hint("merge").join(entries, ["i", "part"]).filter(_apart(F.col("code"), F.col("other")) <= F.col("most"))
    apart = F.array(*[_apart(_segment(F.col("code"), x), _segment(F.col("other"), x)) for x in spans])
    met = met.withColumn("apart", apart).filter((F.array_min("apart") == radius) & (F.array_position("apart", radius) == F.col("i") + 1))
    met = met.select("code", _apart(F.col("code"), F.col("other")).alias("distance"), "first", "other", "n")
    rank = F.row_number().over(Window.partitionBy("code").orderBy("distance", "first"))
    best = met.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return best.groupBy("code").agg(F.collect_list(F.struct("distance", "first", "other", "n")).alias("new"))


HITS = "array<struct<distance:int,first:bigint,other:bigint,n:int>>"


def _grown(state: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """state (code, hits, most) with the hits found; most: the kth smallest distance so far, copies counted."""
    nothing = F.array().cast(HITS)
    merged = F.slice(F.array_sort(F.concat("hits", F.coalesce(F.col("new").cast(HITS), nothing))), 1, k)
    joined = state.join(found, "code", "left").select("code", "most", merged.alias("hits"))
    start = F.struct(F.lit(0).alias("seen"), F.lit(BITS).alias("kth"))
    step = lambda acc, h: F.struct((acc["seen"] + h["n"]).alias("seen"), F.when((acc["seen"] < k) & (acc["seen"] + h["n"] >= k), h["distance"]).otherwise(acc["kth"]).alias("kth"))
    return joined.select("code", "hits", F.least("most", F.aggregate("hits", start, step)["kth"]).alias("most"))


def searched(index: DataFrame, codes: DataFrame, k: int) -> DataFrame:
    """code, hits, most (the kth verified distance, copies counted) and radius (that of the round that covered it) of
    each query code.

    After radius r every code that differs in at most `segments * (r + 1) - 1` bits has been verified: of that many
    bits some segment has r at most. A query ends as soon as this covers its kth verified distance, and the largest
    radius, all patterns of a segment, ends every query."""
    n_index = index.count()
    spans = segments_for(n_index)
    state = stored(codes.select("code", F.array().cast(HITS).alias("hits"), F.lit(BITS).alias("most")), "state")
    ended = state.limit(0).withColumn("radius", F.lit(0))
    for radius in range(max(w for _, w in spans) + 1):
        if not n_index or not state.limit(1).count():
            break
        state = stored(_grown(state, probe(state, index, radius, k, spans), k), "state")
        last = radius == max(w for _, w in spans)
        over = F.lit(last) | (F.col("most") < len(spans) * (radius + 1))
        ended = ended.unionByName(state.filter(over).withColumn("radius", F.lit(radius)))
        state = state.filter(~over)
    return ended


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to each query by Hamming distance of their sign codes, ties to the smaller id.

    Equal codes are searched once, as index (with their k smallest ids, which is all that a top k can hold) and
    as query. The index is a table of segments and patterns, its segments of about log2(codes) bits; each round joins
    to it the patterns that differ from the queries' segments in one bit more, so a query meets only the buckets that it
    probes, until its kth verified distance is covered (`searched`). A bucket with very many codes is split by adaptive
    execution's skewed joins.

    Rows with a null id or vector (and queries alike) take no part; with fewer than k rows a query gets all; a row
    may find itself; repeated rows are hits each; an empty table or query set gives an empty result; other columns'
    names don't matter. Returns query_id, rank (from 1), neighbor_id, distance.
    """
    index = stored(_coded(rows, id_col, sign_code(F.col(vector_col)), k), "codes")
    asked = stored(_coded(queries, id_col, sign_code(F.col(vector_col)), None), "asked")
    state = searched(index, asked.select("code").distinct(), k)
    hits = state.select(F.col("code").alias("q"), F.explode("hits").alias("h")).select("q", "h.distance", F.col("h.other").alias("code")).join(index, "code")
    each = hits.select("q", "distance", F.explode("ids").alias("neighbor_id"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("distance", "neighbor_id"))
    best = each.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor_id", "distance"))).alias("hits"))
    answered = asked.join(best, asked["code"] == best["q"]).select(F.col("id").alias("query_id"), F.explode("hits").alias("hit"))
    return answered.select("query_id", F.col("hit.rank").alias("rank"), F.col("hit.neighbor_id").alias("neighbor_id"), F.col("hit.distance").alias("distance"))
