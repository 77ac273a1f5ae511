"""Mixing sources to target weights by Pfair scheduling of source blocks."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ordered_rank, salted_rank, salts_for, stored

#: Slots of one hyperperiod: weights are multiples of 1/PERIOD, and the schedule repeats after PERIOD slots.
PERIOD = 4_096
#: Sources that are scheduled by themselves at most; those with a smaller share of the weight than its inverse go together.
MOST_SOURCES = 16_384
#: Stands for these; no source has this name, as names are text or null.
FEW = ("few",)


def whole_shares(weights: dict, period: int = PERIOD) -> dict:
    """Weights as whole numbers of slots that add up to `period`, by largest remainder, each 1 at least.

    A schedule has more slots than sources; with more than `period` sources the period grows to their number."""
    keep = {k: w for k, w in weights.items() if w and w > 0}
    if not keep:
        return {}
    period = max(period, len(keep))
    total = math.fsum(keep.values())
    spare = period - len(keep)
    exact = {k: spare * w / total for k, w in keep.items()}
    slots = {k: 1 + math.floor(x) for k, x in exact.items()}
    left = period - sum(slots.values())
    for k in sorted(keep, key=lambda k: (math.floor(exact[k]) - exact[k], str(k)))[:left]:
        slots[k] += 1
    return slots


def pfair(slots: dict) -> list:
    """The source of each slot of one hyperperiod.

    Block j of a source with weight w = a/period is released at floor(j/w) and due at ceil((j+1)/w). Of the
    released blocks the one due first goes next, ties by the source's name. As the weights add up to 1, each
    block meets its deadline, so in any prefix of t slots a source has less than one block more or less than w*t.
    """
    period = sum(slots.values())
    waiting = [(0, str(k), 0, k) for k in slots]
    heapq.heapify(waiting)
    ready: list = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, name, j, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // slots[k]), name, j, k))
        due, name, j, k = heapq.heappop(ready)
        if due < t + 1:
            raise AssertionError("a block missed its deadline")
        out.append(k)
        if j + 1 < slots[k]:
            heapq.heappush(waiting, ((j + 1) * period // slots[k], name, j + 1, k))
    return out


def tempered(counts: dict, alpha: float) -> dict:
    """Weights in proportion to counts ** alpha: 1 keeps the natural shares, 0 makes all sources equal."""
    return {k: float(n) ** alpha for k, n in counts.items() if n > 0}


def mix_sources(docs: DataFrame, weights: dict | None = None, alpha: float = 0.9, block_rows: int = 8, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All rows of docs with their place in a stream that follows the sources' target weights.

    A source's rows, in a repeatable order, form blocks of `block_rows`; block j of a source with a slots in the
    hyperperiod goes to slot (j div a) * period + offset[j mod a], where the offsets come from `pfair`, computed
    once for one hyperperiod. `weights` maps source (None for null) to its weight; sources without one, or with
    none above 0, get no slot. Left out, the weights are tempered counts. No row is repeated, so the stream
    keeps the weights until the first source lacks a block: rows before that slot are `in_mix`. The flag is no
    bound of the stream: behind that slot the slots of a source that has ended stay empty, so the sources left
    go on in proportion to their weights until each has given its last, part block.

    Adds to the columns of docs: mix_slot (long, null without weight), mix_offset (int, place in the block),
    in_mix (boolean). Columns of those names in docs are replaced. Null source is a source of its own; repeated
    rows each take a place; an empty table gives an empty result.

    Of the sources only those with a MOST_SOURCES-th of the weight or more, MOST_SOURCES at most, are scheduled by
    themselves and known to the driver. The others are scheduled as one source with the sum of their weights, whose stream
    takes their blocks earliest deadline first: block j of b at (j + 1) / b, by a sort. Its blocks may hold rows of several.
    """
    spark = docs.sparkSession
    mine = [c for c in docs.columns if c not in ("mix_slot", "mix_offset", "in_mix")]
    sources = docs.groupBy(F.col(source_col).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    if weights is not None:  # those that it names, no more of them than it has
        named = spark.createDataFrame([(k,) for k in weights], "k string").distinct()
        counts = {r[0]: r[1] for r in sources.join(F.broadcast(named), sources["k"].eqNullSafe(named["k"]), "left_semi").collect()}
        slots, least, few, most = whole_shares({k: w for k, w in weights.items() if k in counts}), None, 0, docs.count()
    else:
        sources = stored(sources.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(alpha)))), "sources")
        total, most = sources.agg(F.coalesce(F.sum("w"), F.lit(0.0)), F.coalesce(F.max("n"), F.lit(0))).first()
        least = total / MOST_SOURCES
        counts = {r[0]: r[1] for r in sources.filter(F.col("w") >= least).select("k", "n").collect()}  # MOST_SOURCES at most
        few, few_weight = sources.filter(F.col("w") < least).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0.0))).first()
        shares = {(k,): w for k, w in tempered(counts, alpha).items()} | ({FEW: few_weight} if few else {})
        slots = {k if k == FEW else k[0]: a for k, a in whole_shares(shares).items()}
        counts |= {FEW: few} if few else {}
    period = sum(slots.values())
    offsets: dict = {k: [] for k in slots}
    for t, k in enumerate(pfair(slots)):
        offsets[k].append(t)
    # the first slot that a source would have to fill without a full block
    ends = [(b := counts[k] // block_rows) // a * period + offsets[k][b % a] for k, a in slots.items()]
    end = min(ends, default=0)
    table = spark.createDataFrame([(None if k == FEW else k, k == FEW, slots[k], offsets[k]) for k in slots], "_source string, _few boolean, _share int, _offsets array<int>")
    row = F.struct(*[F.col(f"`{c}`") for c in mine])
    keyed = docs.select(row.alias("_row"), F.col(source_col).cast("string").alias("_source"), F.col(id_col).alias("_id"), F.xxhash64(*[F.col(f"`{c}`") for c in mine]).alias("_hash"))
    ranked = salted_rank(keyed, ["_source"], ["_id", "_hash"], salts_for(most), "_rank").withColumn("_few", F.lit(False))
    if few:
        small = sources.filter(F.col("w") < least).select(F.struct(F.col("k").alias("_source")).alias("_at"), "n")
        at = ranked.withColumn("_at", F.struct("_source"))
        due = (F.floor(F.col("_rank") / block_rows) + 1) / F.ceil(F.col("n") / block_rows)
        rest = ordered_rank(at.join(small, "_at").withColumn("_due", due).drop("_at", "n"), ["_due", "_source", "_rank"], "_place")
        rest = rest.select("_row", F.lit(None).cast("string").alias("_source"), F.col("_place").alias("_rank"), F.lit(True).alias("_few"))
        ranked = at.join(small, "_at", "left_anti").select("_row", "_source", "_rank", "_few").unionByName(rest)
    block = F.floor(F.col("_rank") / block_rows).cast("long")
    r = ranked.alias("r").join(F.broadcast(table).alias("t"), F.col("r._source").eqNullSafe(F.col("t._source")) & (F.col("r._few") == F.col("t._few")), "left")
    slot = F.when(F.col("_share").isNotNull(), F.floor(block / F.col("_share")).cast("long") * period + F.get("_offsets", F.pmod(block, F.col("_share")).cast("int")))
    return r.select(
        "_row.*",
        slot.alias("mix_slot"),
        F.when(slot.isNotNull(), F.pmod("_rank", F.lit(block_rows)).cast("int")).alias("mix_offset"),
        F.coalesce(slot < end, F.lit(False)).alias("in_mix"),
    )


def mixed_stream(docs: DataFrame, **how) -> DataFrame:
    """The rows of `mix_sources` that are in the mix, in stream order, with the columns of docs."""
    got = mix_sources(docs, **how)
    mine = [c for c in docs.columns if c not in ("mix_slot", "mix_offset", "in_mix")]
    return got.filter("in_mix").orderBy("mix_slot", "mix_offset").select(*mine)


def whole_stream(docs: DataFrame, **how) -> DataFrame:
    """All rows of `mix_sources` that have a slot, in stream order, with the columns of docs: without `weights`
    every row of docs, however small the smallest source is."""
    got = mix_sources(docs, **how)
    mine = [c for c in docs.columns if c not in ("mix_slot", "mix_offset", "in_mix")]
    return got.filter("mix_slot is not null").orderBy("mix_slot", "mix_offset").select(*mine)
