"""Embedding hooks, similarity operators, calibration and exact inner-product search."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.functions import classify as C
from millrace.operators.clusters import _vectors as flat
from millrace.operators.clusters import ranked_in
from millrace.operators.staging import staged

Embedder = Callable[[list[str]], np.ndarray]

#: Bytes of a block of query vectors and of index vectors, and scores that are held at once when two blocks meet.
QUERY_BYTES, INDEX_BYTES, SCORES = 64 << 20, 64 << 20, 1 << 21
#: Places of a block that are worked on together.
CHUNK = 4_096


def hashing_embedder(dimension: int = 256) -> Embedder:
    """A deterministic embedder without a model: signed hashed counts of words and word pairs, unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension), np.float32)
        for i, t in enumerate(texts):
            words = t.lower().split()
            for w in [*words, *map(" ".join, zip(words, words[1:], strict=False))]:
                h = zlib.crc32(w.encode())
                out[i, (h >> 1) % dimension] += 1 if h & 1 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return embed


def model_embedder(name: str, normalize: bool = True, batch: int = 8, device: str = "cpu") -> Callable[[], Embedder]:
    """A maker of embedders for `embed` on a sentence-transformers model, which has to be installed on the workers."""

    def make() -> Embedder:
        from sentence_transformers import SentenceTransformer

        model = SentenceTransformer(name, device=device)
        return lambda texts: model.encode(texts, batch_size=batch, normalize_embeddings=normalize, show_progress_bar=False)

    return make


def embed(df: DataFrame, text: str, make: Callable[[], Embedder] = hashing_embedder, output: str = "embedding", batch: int = 8) -> DataFrame:
    """df with the vectors of a text column; `make` builds the embedder once a task, null texts count as empty."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in parts:
            texts = s.fillna("").tolist()
            vectors = [v for at in range(0, len(texts), batch) for v in np.asarray(model(texts[at : at + batch]), np.float32)]
            yield pd.Series(vectors)

    return df.withColumn(output, run(F.col(text)))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def _haloed(df: DataFrame, before: int, after: int) -> DataFrame:
    """df (at, k, ...) with the stretch of CHUNK places (as many as before and after at least) that a row is needed in: its own (`own`), the one behind if it is
    among the last `before` places of its own, the one ahead if it is among the first `after`."""
    chunk, place = F.floor(F.col("k") / CHUNK).cast("long"), F.pmod("k", F.lit(CHUNK))
    also = [F.when(place < after, chunk - 1), F.when(place >= CHUNK - before, chunk + 1)]
    each = F.explode(F.array_compact(F.array(chunk, *also)))
    return df.withColumn("_own", chunk).withColumn("chunk", each).filter("chunk >= 0").withColumn("own", F.col("_own") == F.col("chunk")).drop("_own")


def _similarities(rows: DataFrame, block: str, order: str, vector: str, half_width: int = 2) -> DataFrame:
    """at (struct of the block), o, k (place in the block from 0), similarity to the next row, smooth; no block is one task.

    Rows are sorted by ranges and numbered; stretches of CHUNK places get the rows at their ends twice, so that each can
    compute what it has: the product with the next row, then the moving average."""
    ranked = ranked_in(rows.select(F.col(block).alias("block"), F.col(order).alias("o"), F.col(vector).alias("v")), "block", ["o"]).select(F.struct("block").alias("at"), "o", "k", "v")
    w = Window.partitionBy("at", "chunk").orderBy("k")
    pairs = _haloed(ranked, 0, 1).select("at", "chunk", "own", "o", "k", "v", F.lead("v").over(w).alias("_next")).filter("own and _next is not null")
    pairs = pairs.select("at", "o", "k", dot(F.col("v"), F.col("_next")).alias("similarity"))
    smooth = F.avg("similarity").over(w.rowsBetween(-half_width, half_width))
    return _haloed(pairs, half_width, half_width).withColumn("smooth", smooth).filter("own").select("at", "o", "k", "similarity", "smooth")


def adjacent_similarity(rows: DataFrame, block: str, order: str, vector: str, half_width: int = 2) -> DataFrame:
    """Each row's similarity to the next of its block and its moving average: block, order, similarity, smooth.

    A block may be long: it is worked on in stretches (`_similarities`). Rows that tie in the order are exchangeable; null
    blocks are a block; a block's last row has none; an empty table gives an empty result. Other columns' names don't matter."""
    return _similarities(rows, block, order, vector, half_width).select(F.col("at.block").alias(block), F.col("o").alias(order), "similarity", "smooth")


def topic_spans(sims: DataFrame, sizes: DataFrame, thresholds: list[float], least: int = 5) -> DataFrame:
    """at, threshold, n, start, end: the spans between the places at which topics end.

    sims: as `_similarities` gives them; sizes: at and n, the rows of each block. A topic ends at a place where the smoothed
    similarity is under the threshold, if the span since the last end and what is left have `least` rows. Whether a place
    may end a span depends on what came before only by the places still to be skipped, fewer than `least`. So each stretch
    of CHUNK places is folded once for each such number, in parallel; what a stretch hands on, `least` numbers, is put
    together along a block; then each stretch takes the fold that holds."""
    steps = sims.withColumn("chunk", F.floor(F.col("k") / CHUNK).cast("long"))
    chunks = steps.groupBy("at", "chunk").agg(F.array_sort(F.collect_list(F.struct("k", "smooth"))).alias("s")).join(sizes, "at")
    chunks = chunks.select("at", "chunk", "n", (F.col("chunk") * CHUNK + 1).alias("lo"), F.transform("s", lambda x: x["smooth"]).alias("x"), F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))

    def fold(skip: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            place = F.col("lo") + i
            last = F.coalesce(F.try_element_at(acc, F.lit(-1)), F.col("lo") + skip - least)
            cut = (F.get("x", i) < F.col("threshold")) & (place - last >= least) & (F.col("n") - place >= least)
            return F.when(cut, F.concat(acc, F.array(place))).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(0), F.size("x") - 1), F.array().cast("array<bigint>"), step)

    folded = staged(chunks.withColumn("cuts", F.transform(F.sequence(F.lit(0), F.lit(least - 1)), fold)).withColumn("hi", F.col("lo") + F.size("x")).drop("x"))
    # of each fold: the last end, or null if it has none, and the places that the next stretch has to skip
    last = lambda cuts: F.try_element_at(cuts, F.lit(-1))
    left = lambda cuts, skip: F.greatest(F.lit(0), F.when(last(cuts).isNull(), skip - (F.col("hi") - F.col("lo"))).otherwise(least - (F.col("hi") - last(cuts)))).cast("int")
    handed = F.transform("cuts", lambda cuts, skip: F.struct(last(cuts).alias("last"), left(cuts, skip).alias("skip")))
    along = folded.select("at", "threshold", "chunk", handed.alias("h")).groupBy("at", "threshold").agg(F.array_sort(F.collect_list(F.struct("chunk", "h"))).alias("hs"))
    start = F.struct(F.lit(least - 1).alias("skip"), F.lit(0).cast("bigint").alias("last"), F.array().cast("array<struct<chunk:bigint,skip:int,last:bigint>>").alias("out"))

    def walk(acc: Column, x: Column) -> Column:
        mine = F.get(x["h"], acc["skip"])
        entered = F.struct(x["chunk"].alias("chunk"), acc["skip"].alias("skip"), acc["last"].alias("last"))
        return F.struct(mine["skip"].alias("skip"), F.coalesce(mine["last"], acc["last"]).alias("last"), F.concat(acc["out"], F.array(entered)).alias("out"))

    walked = along.select("at", "threshold", F.aggregate("hs", start, walk).alias("w"))
    held = walked.select("at", "threshold", F.explode("w.out").alias("e")).select("at", "threshold", "e.chunk", "e.skip", "e.last")
    met = folded.join(held, ["at", "threshold", "chunk"]).select("at", "threshold", "n", F.get("cuts", F.col("skip")).alias("cuts"), "last")
    inner = met.select("at", "threshold", "n", F.explode(F.transform("cuts", lambda c, i: F.struct(F.when(i == 0, F.col("last")).otherwise(F.get("cuts", i - 1)).alias("start"), c.alias("end")))).alias("s"))
    inner = inner.select("at", "threshold", "n", "s.start", "s.end")
    ends = walked.join(sizes, "at").select("at", "threshold", "n", F.col("w.last").alias("start"), F.col("n").cast("long").alias("end"))
    single = sizes.join(walked.select("at").distinct(), "at", "left_anti").select("at", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"), "n", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end"))
    return inner.unionByName(ends).unionByName(single)


def _sizes(rows: DataFrame, block: str) -> DataFrame:
    return rows.groupBy(F.struct(F.col(block).alias("block")).alias("at")).agg(F.count(F.lit(1)).cast("int").alias("n"))


def topic_boundaries(rows: DataFrame, block: str, order: str, vector: str, threshold: float, least: int = 5) -> DataFrame:
    """block, n (its rows), ends: places at which a topic ends (`topic_spans`), as an array; a long block's similarities
    are worked on in stretches, only its ends are put together."""
    spans = topic_spans(staged(_similarities(rows, block, order, vector)), _sizes(rows, block), [threshold], least)
    ends = F.array_sort(F.collect_list(F.when(F.col("end") < F.col("n"), F.col("end").cast("int"))))
    return spans.groupBy("at", "n").agg(ends.alias("ends")).select(F.col("at.block").alias(block), "n", "ends")


def pairwise_purity(rows: DataFrame, block: str, vector: str) -> DataFrame:
    """Mean inner product over all pairs of a block: block, n, purity; 1 for fewer than two.

    Closed form: (|sum of vectors|^2 - sum of squared lengths) / (n (n - 1)); sums by dimension, no pairs."""
    each = rows.select(block, F.posexplode(vector).alias("d", "x")).groupBy(block, "d").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x")).alias("q"), F.count(F.lit(1)).alias("n"))
    total = each.groupBy(block).agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("s2"), F.sum("q").alias("q"))
    return total.select(block, "n", F.when(F.col("n") < 2, 1.0).otherwise((F.col("s2") - F.col("q")) / (F.col("n") * (F.col("n") - 1))).alias("purity"))


def window_purity(rows: DataFrame, block: str, order: str, vector: str, least: int = 5, most: int = 20) -> DataFrame:
    """Purity of a block's full windows of min(most, max(least, n // 2)) rows: block, window_no, n, purity.

    Rows are numbered by ranges, so a long block is no task of its own."""
    ranked = ranked_in(rows.select(F.col(block).alias("block"), F.col(order).alias("o"), F.col(vector).alias("v")), "block", ["o"]).select(F.struct("block").alias("at"), "k", "v")
    sized = _sizes(rows, block).withColumn("w", F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.col("n") / 2))))
    cut = ranked.join(sized, "at").withColumn("window_no", F.floor(F.col("k") / F.col("w"))).filter((F.col("window_no") + 1) * F.col("w") <= F.col("n"))
    got = pairwise_purity(cut.select(F.struct("at", "window_no").alias("_b"), "v"), "_b", "v")
    return got.select(F.col("_b.at.block").alias(block), "_b.window_no", "n", "purity")


def decimal_round(x: float, places: int) -> float:
    """x to so many decimal places, halves away from zero, as Spark rounds."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def quantiles(df: DataFrame, value: str, shares: list[float], beyond: bool = False) -> list[float | None]:
    """Values at the given shares of the way from the least to the greatest, interpolated; nulls are left out, and of
    no values there is no quantile. With `beyond`, a share under 0 or over 1 goes on along the line through the two
    values at that end.

    The values are sorted by ranges; only those next to the shares, two each, come to the driver."""
    rows = placed(df.select(F.col(value).cast("double").alias("v")).filter("v is not null"), ["v"])
    n = rows.count()
    if not n:
        return [None] * len(shares)
    exact = [x * (n - 1) if beyond else min(max(x * (n - 1), 0.0), n - 1.0) for x in shares]
    low = [min(max(math.floor(x), 0), max(n - 2, 0)) for x in exact]
    wanted = sorted({k for x in low for k in (x, min(x + 1, n - 1))})
    at = dict(map(tuple, rows.filter(F.col("pos").isin(wanted)).select("pos", "v").collect()))
    return [at[k] + (x - k) * (at[min(k + 1, n - 1)] - at[k]) for x, k in zip(exact, low, strict=True)]


def percentiles(df: DataFrame, value: str) -> DataFrame:
    """p10, p25, p50, p75, p90 (interpolated) and mean of a column; one row."""
    names = ("p10", "p25", "p50", "p75", "p90")
    found = quantiles(df, value, [0.10, 0.25, 0.50, 0.75, 0.90])
    return df.agg(*[F.lit(x).cast("double").alias(n) for n, x in zip(names, found, strict=True)], F.avg(value).alias("mean"))


def exclusive_quartiles(df: DataFrame, value: str) -> DataFrame:
    """q1, q2, q3 at places k (n + 1) / 4 of the sorted values, interpolated; null for fewer than two values.

    Place p of n is the share (p - 1) / (n - 1); beyond the ends the line through the last two values goes on."""
    n = df.filter(F.col(value).isNotNull()).count()
    found = quantiles(df, value, [(k * (n + 1) / 4 - 1) / (n - 1) for k in (1, 2, 3)], beyond=True) if n > 1 else [None] * 3
    return df.agg(*[F.lit(x).cast("double").alias(f"q{k}") for k, x in enumerate(found, 1)])


def threshold_search(rows: DataFrame, block: str, order: str, vector: str, target: float = 12.0, least: int = 5, most: int = 20) -> DataFrame:
    """Candidate thresholds (the different 5th to 95th percentiles of all adjacent similarities, to 4 places) with the
    average sentences of a chunk that each would give; `best` marks the one nearest to the target, the lowest of equals."""
    sims = staged(_similarities(rows, block, order, vector))
    found = quantiles(sims, "similarity", [i / 100 for i in range(5, 100, 5)])
    candidates = sorted({decimal_round(x, 4) for x in found if x is not None})  # 19 at most
    sizes = _sizes(rows, block).join(sims.select("at").distinct(), "at", "left_semi")
    spans = topic_spans(sims, sizes, candidates or [0.0], least)
    got = spans.groupBy("threshold").agg(F.avg(F.least(F.col("end") - F.col("start"), F.lit(most))).alias("mean_sentences"))
    rank = F.row_number().over(Window.orderBy(F.abs(F.col("mean_sentences") - target), "threshold"))
    return got.withColumn("best", rank == 1)


def recommend(rows: DataFrame, block: str, order: str, vector: str, **how) -> DataFrame:
    """Calibrated thresholds in one row: similarity from the search (else p25), boundary p75 of adjacent
    similarities, mixed p50 and floor p10 of window purities, to 3 places."""
    best = threshold_search(rows, block, order, vector, **how).filter("best").select("threshold")
    adjacent = percentiles(adjacent_similarity(rows, block, order, vector), "similarity")
    pure = percentiles(window_purity(rows, block, order, vector), "purity").select(F.col("p50").alias("m"), F.col("p10").alias("f"))
    one = adjacent.join(pure).join(best, how="left")  # one row each
    return one.select(F.round(F.coalesce("threshold", "p25"), 3).alias("similarity_threshold"), F.round("p75", 3).alias("semantic_boundary_threshold"), F.round("m", 3).alias("mixed_topic_threshold"), F.round("f", 3).alias("purity_floor"))


def best_places(scores: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k greatest scores, ties to the smaller place; a partition, then a sort of
    what reaches the kth score."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        rows, cols = np.nonzero(scores >= least[:, None])
    else:
        rows, cols = np.indices(scores.shape).reshape(2, -1)
    order = np.lexsort((place[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, "left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep]


def top_k(queries: DataFrame, index: DataFrame, k: int, query_id: str = "query_id", query_vector: str = "vector", pos: str = "pos", vector: str = "embedding", group: str | None = None) -> DataFrame:
    """The k rows of the index with the greatest inner products for each query (in each group, if given):
    query_id, group, pos, score, rank; ties to the smaller pos, fewer than k if there are fewer.

    Both sides are dealt by a hash to blocks of about QUERY_BYTES and INDEX_BYTES; each pair of blocks is one task
    that multiplies them and sends on its k best a query only. Nothing but three sums comes to the driver, and what
    is shuffled in the end is bounded by blocks, not by pairs. Rows without a vector take no part."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("q")).filter("q is not null")
    rows = index.select(*([F.col(group).alias("g")] if group else [F.lit(0).alias("g")]), F.col(pos).alias("pos"), F.col(vector).alias("v")).filter("v is not null")
    nbytes = lambda c: F.coalesce(8 * F.sum(F.size(c).cast("long")), F.lit(0))
    (asked_bytes,), (row_bytes, n_rows) = asked.agg(nbytes("q")).first(), rows.agg(nbytes("v"), F.count(F.lit(1))).first()
    # at least a block a core, as far as blocks stay large enough to be worth a task
    blocks = max(1, -(-row_bytes // INDEX_BYTES), min(index.sparkSession.sparkContext.defaultParallelism, n_rows // 10_000))
    q_blocks = max(1, -(-asked_bytes // QUERY_BYTES))
    block = lambda col, n: F.pmod(F.xxhash64(col), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("q_block", block("query_id", q_blocks)).withColumn("block", every(blocks))
    right = rows.withColumn("block", block("pos", blocks)).withColumn("q_block", every(q_blocks))
    kinds = dict(rows.dtypes) | dict(asked.dtypes)
    schema = f"query_id {kinds['query_id']}, g {kinds['g']}, pos {kinds['pos']}, score double"

    declared = to_arrow_schema(StructType.fromDDL(schema))

    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        """Vectors stay in Arrow's buffers, those of a group become one array; rows are no Python objects."""
        found = []
        if q.num_rows and r.num_rows:
            asked_, groups = flat(q.column("q")), r.column("g").combine_chunks().dictionary_encode("encode")
            for code in range(len(groups.dictionary)):
                part = r.filter(pa.compute.equal(groups.indices, code)) if len(groups.dictionary) > 1 else r
                place, vectors = part.column("pos").to_numpy(), flat(part.column("v"))
                step = max(1, SCORES // max(1, part.num_rows))
                for at in range(0, q.num_rows, step):
                    scores = asked_[at : at + step] @ vectors.T
                    at_q, at_r = best_places(scores, place, k)
                    hit = [q.column("query_id").take(pa.array(at + at_q)), part.column("g").take(pa.array(at_r)), part.column("pos").take(pa.array(at_r)), pa.array(scores[at_q, at_r])]
                    found.append(pa.table(hit, names=declared.names).cast(declared))
        return pa.concat_tables(found) if found else declared.empty_table()

    by = ("block", "q_block")
    hits = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(lambda a, b: search(a, b), schema)
    rank = F.row_number().over(Window.partitionBy("query_id", "g").orderBy(F.desc("score"), "pos"))
    best = hits.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.withColumnRenamed("g", group) if group else best.drop("g")


def route_by_index(queries: DataFrame, index: DataFrame, group: str, weak: float = 0.05, strong: float = 0.10, label: str | None = None, **how) -> DataFrame:
    """Each query's best index: query_id, predicted, score, runner_up, margin, and with a label its status.

    The best hit of each index competes; the greatest score wins, ties to the first name; without a second index
    the runner-up counts 0."""
    best = top_k(queries, index, 1, group=group, **how)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), group)
    ranked = best.select("query_id", F.col(group).alias("predicted"), "score", F.row_number().over(w).alias("_n"), F.coalesce(F.lead("score").over(w), F.lit(0.0)).alias("runner_up"))
    out = ranked.filter("_n = 1").drop("_n").withColumn("margin", F.col("score") - F.col("runner_up"))
    if label is None:
        return out
    named = queries.select(F.col(how.get("query_id", "query_id")).alias("query_id"), F.col(label).alias("label"))
    return out.join(named, "query_id").withColumn("status", C.margin_class(F.col("predicted") == F.col("label"), F.col("margin"), weak, strong))


def routing_report(hits: DataFrame, group: str, title: str | None = None, places: int = 6) -> DataFrame:
    """Of `top_k` hits by index: a query's best score in each index as a map, and its hits in order."""
    entry = F.struct("score", "rank", "pos", *([title] if title else []))
    per = hits.groupBy("query_id", group).agg(F.max("score").alias("s"), F.array_sort(F.collect_list(F.struct("rank", entry.alias("hit")))).alias("hs"))
    scores = F.map_from_entries(F.array_sort(F.collect_list(F.struct(group, F.round("s", places)))))
    top = F.map_from_entries(F.array_sort(F.collect_list(F.struct(group, F.transform("hs", lambda x: x["hit"])))))
    return per.groupBy("query_id").agg(scores.alias("scores"), top.alias("top_hits"))


def index_report(index: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Dimension and number of vectors of each index."""
    return index.groupBy(group).agg(F.max(F.size(vector)).alias("dimension"), F.count(F.lit(1)).alias("vectors"))


def placed(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """df sorted by `order`, with each row's place from 0 without gaps.

    Rows are sorted by ranges; the number of rows before each partition, one number a partition, is what the
    driver adds up."""
    part, own = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_own")
    cut = staged(df.orderBy(*order).select("*", part, own))
    before, first = 0, []
    for p, n in sorted(map(tuple, cut.groupBy("_part").count().collect())):
        first.append((p, before))
        before += n
    starts = F.broadcast(df.sparkSession.createDataFrame(first, "_part int, _first long"))  # a row a partition
    return cut.join(starts, "_part").select(*df.columns, (F.col("_first") + F.col("_own")).alias(name))


def check_dimension(found: int | None, wanted: int | None) -> None:
    """An error where an index and the model in use differ in dimension; an index without vectors fits any."""
    if found is not None and wanted is not None and found != wanted:
        raise ValueError(f"the index has vectors of {found} dimensions, the model {wanted}")


def write_index(records: DataFrame, order: list[str], path: str, vector: str = "embedding", model: str = "hashing") -> DataFrame:
    """Records written as an index table with their place in `order` (pos, from 0 without gaps); returns its build
    statistics: vectors, embedding_dim, embed_model, which are kept beside it.

    Vector and metadata are one row, so they can't drift apart."""
    spark = records.sparkSession
    placed(records, order).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    stats = rows.agg(F.count(F.lit(1)).alias("vectors"), F.max(F.size(vector)).alias("embedding_dim"), F.lit(model).alias("embed_model"))
    stats.write.mode("overwrite").parquet(f"{path.rstrip('/')}_stats")
    return build_stats(spark, path)


def build_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}_stats")


def read_index(spark: SparkSession, path: str, dimension: int | None = None) -> DataFrame:
    """The rows of an index; an error if its vectors don't have the dimension that is asked for."""
    check_dimension(build_stats(spark, path).first()["embedding_dim"], dimension)
    return spark.read.parquet(path)


def rows_at(index: DataFrame, positions: DataFrame, pos: str = "pos") -> DataFrame:
    """The index rows at the given positions; positions that the index doesn't have give no row."""
    return index.join(positions.select(pos).filter(F.col(pos) >= 0).distinct(), pos, "left_semi")
