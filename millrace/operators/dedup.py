"""The deduplication family. Every keep-first has an explicit input order, so results don't depend on partitions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import DedupRules
from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators.clusters import leader_clusters
from millrace.operators.staging import staged
from millrace.operators.vectors import placed


#: Tokens that are frequent are fewer than so many; rows of a token of a block's prefixes that a part of it holds.
FREQUENT, HOT_PREFIX = 20_000, 2_000
#: Words of 64 bits that a token set's parities take in prefixes; a power of two. Tokens a word of those that pairs are tested by.
PARITY_WORDS, FINE_TOKENS = 4, 64
#: Sets that are prepared at once.
SLICE_SETS = 1_024


def _first_of(df: DataFrame, keys: list[Column], order: Column) -> DataFrame:
    """Of each key the row with the least `order`; of rows that tie in it the one with the least hash, so exactly one.

    One aggregation with partial results: a key with very many rows sends one of them a task, and is no task of
    its own. Columns of any names may come along."""
    kinds = dict(df.dtypes)
    hashed = F.xxhash64(*[F.to_json(F.col(f"`{c}`")) if "map<" in kinds[c] else F.col(f"`{c}`") for c in df.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    keyed = df.select(row, F.struct(order.alias("o"), hashed.alias("h")).alias("order"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    return keyed.groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.min_by("row", "order").alias("row")).select("row.*")


def keep_first(df: DataFrame, key: Column | list[Column], order: list[str], always: Column | None = None) -> DataFrame:
    """The first row of each key by `order`; rows for which `always` holds stay in any case.

    Of rows that tie in the order one stays, the same one whatever the partitions. Null keys are a key."""
    keys = key if isinstance(key, list) else [key]
    if always is None:
        return _first_of(df, keys, F.struct(*order))
    stays = F.coalesce(always, F.lit(False))
    return _first_of(df.filter(~stays), keys, F.struct(*order)).unionByName(df.filter(stays))


def title_program_key() -> list[Column]:
    """Key of the administrative pass: title and program, trimmed, in lower case."""
    return [F.lower(T.strip(F.col("section_title"))), F.lower(T.strip(F.col("program")))]


def prefix_key(content: Column, chars: int = 200) -> Column:
    return F.substring(content, 1, chars)


def content_md5(content: Column) -> Column:
    return F.md5(content)


def prefix_md5(content: Column, chars: int = 150) -> Column:
    """md5 of the first characters in lower case, trimmed."""
    return F.md5(T.strip(F.lower(F.substring(content, 1, chars))))


def stripped_md5(content: Column) -> Column:
    return F.md5(T.strip(F.coalesce(content, F.lit(""))))


def cleanup_rank(version: Column) -> Column:
    v = F.lower(F.coalesce(version, F.lit("")))
    return F.when(F.contains(v, F.lit("ollama_llm_v2")), 3).when(F.contains(v, F.lit("llm")), 2).when(F.contains(v, F.lit("rule")), 1).otherwise(0)


def worth(title: Column, content: Column, version: Column) -> Column:
    """What makes a record the better of two: a good title, then more words, then the later cleanup."""
    return F.struct((~C.is_bad_title(title)).cast("int").alias("good"), T.word_count(content).alias("words"), cleanup_rank(version).alias("rank"))


def keep_better(df: DataFrame, key: Column, title: Column, content: Column, version: Column, order: str) -> DataFrame:
    """Of each key the best row by `worth`, the earlier of equals; exactly one, also of rows that tie in all that."""
    w = worth(title, content, version)
    rank = F.struct((-w["good"]).alias("g"), (-w["words"]).alias("w"), (-w["rank"]).alias("r"), F.col(order).alias("o"))
    return _first_of(df, [key], rank)


def in_final_order(records: DataFrame, category: str = "category", title: str = "title", then: tuple[str, ...] = (), place: str | None = None) -> DataFrame:
    """Records sorted by category, then title in lower case, then the columns `then`; nulls count as empty in the first two.

    With `place` each row gets its place in the order, from 0 without gaps; rows that tie are exchangeable."""
    keys = [F.coalesce(F.col(category), F.lit("")), F.lower(F.coalesce(F.col(title), F.lit("")))]
    if place is None:
        return records.orderBy(*keys, *then)
    keyed = records.select(F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("row"), *[k.alias(f"k{i}") for i, k in enumerate([*keys, *map(F.col, then)])])
    return placed(keyed, [c for c in keyed.columns if c != "row"], "place").select("row.*", F.col("place").alias(place))


def normal_name(name: Column) -> Column:
    """Lower case, punctuation to spaces, one space between words."""
    return T.collapse(F.regexp_replace(F.lower(T.strip(name)), r"[^\w\s]", " "))


def soft_key(name: Column, program: Column, department: Column, semester: Column) -> Column:
    part = lambda c: F.lower(T.strip(F.coalesce(c, F.lit(""))))
    return F.concat_ws("|", normal_name(F.replace(F.coalesce(name, F.lit("")), F.lit("[NEEDS REVIEW]"), F.lit(""))), part(program), part(department), T.strip(F.coalesce(semester, F.lit(""))))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token sets; 0 if one is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def _hashed(value: Column) -> Column:
    """128 bits that stand for a value."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(value, F.lit(1)).alias("b"))


def token_classes(df: DataFrame, tokens: Column, block: list[Column], order: str) -> DataFrame:
    """Different token sets of each block: at (its block and hash), o (the first row that has it), set (hashed tokens,
    sorted). Rows without tokens have none."""
    hashed = F.array_sort(F.transform(F.array_distinct(tokens), lambda x: F.xxhash64(x)))
    base = df.select(F.col(order).alias("o"), hashed.alias("set"), *[b.alias(f"b{i}") for i, b in enumerate(block)]).filter(F.size("set") > 0)
    at = F.struct(F.struct(*[F.col(f"b{i}") for i in range(len(block))]).alias("block") if block else F.lit(0).alias("block"), _hashed(F.col("set")).alias("key"))
    return base.select("o", "set", at.alias("at"))


def _parities(token: np.ndarray, row: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Bits of rows of tokens, words[r] words of 64 of row r, in one array: bit b says whether an odd number of the row's tokens
    fall on it. Where two sets' bits differ, the sets differ in a token, so their number is a lower bound of what the sets
    differ in. Numbers of words are powers of two, so the bits of two halves xored are those of half as many words."""
    u = token.view(np.uint64)
    bits = np.zeros(int(words.sum()), np.uint64)
    at = (np.cumsum(words) - words)[row] + ((u >> np.uint64(6)) & (words - 1).astype(np.uint64)[row]).astype(np.int64)
    np.bitwise_xor.at(bits, at, np.uint64(1) << (u & np.uint64(63)))
    return bits.view(np.int64)


def _cut(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int64()))


def _prepared(threshold: float, common: np.ndarray, often: np.ndarray):
    """k, block, set in; PREPARED out: the set's size, its first n - ceil(t * n) + 1 tokens, rarest first by the counts of the common
    (sorted) tokens, its parities in PARITY_WORDS words, and in a word for FINE_TOKENS tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE_SETS):
                batch = whole.slice(lo, SLICE_SETS)
                sets = batch.column("set")
                n, token = np.asarray(sets.value_lengths(), np.int64), sets.flatten().to_numpy(zero_copy_only=False)
                row, count = np.repeat(np.arange(len(n)), n), np.zeros(len(token), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, token), len(common) - 1)
                    count = np.where(common[at] == token, often[at], 0)
                ranked = token[np.lexsort((token, count, row))]
                keep = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
                first = ranked[np.arange(len(token)) - (np.cumsum(n) - n)[row] < keep[row]]
                few = _parities(token, row, np.full(len(n), PARITY_WORDS)).reshape(-1, PARITY_WORDS)
                words = np.maximum(PARITY_WORDS, 2 ** np.ceil(np.log2(np.maximum(n / FINE_TOKENS, 1))).astype(np.int64))
                columns = [batch.column("k"), batch.column("block"), pa.array(n, pa.int32()), _cut(first, np.minimum(keep, n)), _cut(_parities(token, row, words), words), *[pa.array(np.ascontiguousarray(w)) for w in few.T]]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "block", "n", "tokens", "bits", *[f"w{i}" for i in range(PARITY_WORDS)]])

    return run


PREPARED = "k long, block long, n int, tokens array<long>, bits array<long>, " + ", ".join(f"w{i} long" for i in range(PARITY_WORDS))


def prepared(classes: DataFrame, threshold: float) -> DataFrame:
    """PREPARED of classes (k, at, set), the block as a hash. Rarest first goes by the counts of the tokens that make up more than a FREQUENT-th of
    all, fewer than FREQUENT of them, which are sent to all tasks; the others go by their hash."""
    counts = staged(classes.select(F.explode("set").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("often")))
    total = counts.agg(F.coalesce(F.sum("often"), F.lit(0))).first()[0]
    common = sorted(map(tuple, counts.filter(F.col("often") > total // FREQUENT).collect()))
    return classes.select("k", F.xxhash64("at.block").alias("block"), "set").mapInArrow(_prepared(threshold, np.array([t for t, _ in common], np.int64), np.array([n for _, n in common], np.int64)), PREPARED)


def candidate_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sets (PREPARED) of a block that may be similar by `threshold`: i < j (their k), m, n (sizes), each once.

    Two such sets share one of their prefixes' tokens. Before a pair is made of two prefix entries it has to pass the sizes,
    the places of the token in both (what can follow it bounds what is shared) and the bits of `_parities` (which bound what
    differs). Blocks and tokens meet by a hash; pairs of two blocks that it makes one are left out by the caller.

    A token that many prefixes of a block hold is dealt to pairs of parts: each of its rows to as many as it has parts of
    HOT_PREFIX rows. Entries of the others are shuffled once, as both sides of the join are the same."""
    words = [f"w{i}" for i in range(PARITY_WORDS)]
    each = sets.select("k", "n", *words, "block", F.posexplode("tokens").alias("p", "token"))
    prefix = each.select(F.xxhash64("block", "token").alias("meet"), "k", "n", *words, "p")
    hot = max(HOT_PREFIX, prefix.count() // FREQUENT)
    busy = prefix.groupBy("meet").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > hot)
    parts = F.broadcast(staged(busy.select("meet", F.ceil(F.col("times") / HOT_PREFIX).cast("int").alias("parts"))))
    m, n = F.col("a.n"), F.col("b.n")
    least = threshold / (1 + threshold) * (m + n) - 1e-6  # tokens that a similar pair shares
    shared = F.least(m - F.col("a.p"), n - F.col("b.p"))
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}"))) for w in words])
    near = (m >= threshold * n - 1e-6) & (n >= threshold * m - 1e-6) & (shared >= least) & (m + n - 2 * least >= apart)

    def pairs(a: DataFrame, b: DataFrame, on: Column) -> DataFrame:
        met = a.alias("a").join(b.alias("b"), on & (F.col("a.k") < F.col("b.k")) & near)
        return met.select(F.col("a.k").alias("i"), F.col("b.k").alias("j"), m.alias("m"), n.alias("n"))

    meets = F.col("a.meet") == F.col("b.meet")
    few = prefix.join(parts.select("meet"), "meet", "left_anti").repartition("meet")
    dealt = prefix.join(parts, "meet").withColumn("own", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = dealt.select("meet", "k", "n", *words, "p", F.col("own").alias("x"), every.alias("y"))
    b = dealt.select("meet", "k", "n", *words, "p", every.alias("x"), F.col("own").alias("y"))
    often = pairs(a, b, meets & (F.col("a.x") == F.col("b.x")) & (F.col("a.y") == F.col("b.y")))
    return pairs(few, few, meets).unionByName(often).distinct()


def _bits_apart(x: Column, y: Column) -> Column:
    """Bits in which parities differ; those of twice as many words are folded to as many as the others have. Sets that differ
    more in size, which can be similar by thresholds under 0.5 only, count as 0 apart."""
    short = F.least(F.size(x), F.size(y))
    xor = lambda a, b: a.bitwiseXOR(b)
    fold = lambda a: F.when(F.size(a) > short, F.zip_with(F.slice(a, F.lit(1), short), F.slice(a, short + 1, short), xor)).otherwise(a)
    apart = F.aggregate(F.zip_with(fold(x), fold(y), xor), F.lit(0), lambda n, w: n + F.bit_count(w))
    return F.when(F.greatest(F.size(x), F.size(y)) <= 2 * short, apart).otherwise(0)


def jaccard_links(df: DataFrame, tokens: Column, block: list[Column], order: str, threshold: float) -> DataFrame:
    """Pairs i < j (by order) of a block whose token sets are similar by `threshold` or more: i, j, similarity, copy.

    Equal sets are a class that its first row stands for: candidates (`candidate_pairs`) come from classes only, and each
    other member has one pair, with the first (copy), so copies make no square of pairs. Candidates have to pass parities as
    long as their sets ask for, which bound what they differ in, before whole sets are sent for them; then they are compared
    on the hashes of all their tokens. Rows with the same order value are not compared with each other, nor rows without
    tokens with any; null blocks are a block; an empty table gives an empty result. Other columns' names don't matter."""
    base = staged(token_classes(df, tokens, block, order))
    classes = staged(base.groupBy("at").agg(F.min("o").alias("o"), F.first("set").alias("set")).withColumn("k", F.monotonically_increasing_id()))
    copies = base.select("at", F.col("o").alias("j")).join(classes.select("at", F.col("o").alias("i")), "at").filter("j > i").select("i", "j", F.lit(1.0).alias("similarity"), F.lit(True).alias("copy"))
    sets = staged(prepared(classes, threshold))
    pairs = candidate_pairs(sets, threshold)
    of = lambda df, value, side, name: df.select(F.col("k").alias(side), F.col(value).alias(name))
    m, n = F.col("m"), F.col("n")
    most = m + n - 2 * (threshold / (1 + threshold) * (m + n) - 1e-6)  # tokens that a similar pair differs in
    tested = pairs.join(of(sets, "bits", "i", "x"), "i").join(of(sets, "bits", "j", "y"), "j").filter(_bits_apart(F.col("x"), F.col("y")) <= most)
    held = classes.select("k", F.struct("at.block", "o", "set").alias("held"))
    met = staged(tested.select("i", "j", "m", "n")).join(of(held, "held", "i", "x"), "i").join(of(held, "held", "j", "y"), "j")
    met = met.filter(F.col("x.block").eqNullSafe(F.col("y.block")) & (F.col("x.o") != F.col("y.o")))
    both = F.size(F.array_intersect("x.set", "y.set"))
    near = met.select(F.least("x.o", "y.o").alias("i"), F.greatest("x.o", "y.o").alias("j"), (both / (m + n - both)).alias("similarity")).filter(F.col("similarity") >= threshold)
    return near.groupBy("i", "j").agg(F.max("similarity").alias("similarity")).withColumn("copy", F.lit(False)).unionByName(copies)


def greedy_duplicates(links: DataFrame) -> DataFrame:
    """Of links i -> j (i < j, a similar pair in block order) the nodes that a greedy pass in order removes: a
    node falls if a node before it that didn't fall is linked to it. Returns removed, kept (the first such node)
    and similarity. A copy always falls: to its first, or to what that fell to.

    Decided in rounds instead of a pass: a node whose earlier neighbours have all fallen stays, one with an
    earlier neighbour that stays falls. Each round is one table of the open links; rounds follow the longest
    chain of undecided neighbours, not the data's size. Rounds are cut by checkpoints in the shared folder."""
    links = staged(links)
    near = links.filter("not copy").select("i", "j", "similarity")
    open_, gone = near, near.select(F.col("j").alias("removed")).limit(0)
    while not open_.isEmpty():
        hit = open_.join(open_.select(F.col("j").alias("i")).distinct(), "i", "left_anti")
        fallen = hit.select(F.col("j").alias("removed")).distinct()
        gone = gone.unionByName(fallen)
        open_ = open_.join(fallen.withColumnRenamed("removed", "j"), "j", "left_anti")
        open_ = staged(open_.join(fallen.withColumnRenamed("removed", "i"), "i", "left_anti"))
    gone = staged(gone)
    stays = near.join(gone.withColumnRenamed("removed", "i"), "i", "left_anti").join(gone.withColumnRenamed("removed", "j"), "j", "left_semi")
    out = stays.groupBy(F.col("j").alias("removed")).agg(F.min(F.struct("i", "similarity")).alias("by")).select("removed", F.col("by.i").alias("kept"), F.col("by.similarity").alias("similarity"))
    by = out.select(F.col("removed").alias("i"), F.col("kept").alias("_kept"), F.col("similarity").alias("_s"))
    copies = links.filter("copy").join(by, "i", "left").select(F.col("j").alias("removed"), F.coalesce("_kept", "i").alias("kept"), F.coalesce("_s", "similarity").alias("similarity"))
    return out.unionByName(copies)


def dedup_courses(courses: DataFrame, order: str, threshold: float = DedupRules.jaccard, remove: bool = True) -> DataFrame:
    """The three passes over courses: same code, same name in a program, department and semester, near titles of a
    program and department. Adds dedup_status: clean, or near_duplicate where they are only flagged."""
    code = F.upper(T.strip(F.coalesce(F.col("course_code"), F.lit(""))))
    courses = staged(courses)
    one = keep_first(courses, code, [order], always=code == "")
    two = staged(keep_first(one, soft_key(F.col("course_name"), F.col("program"), F.col("department"), F.col("semester")), [order]))
    tokens = T.words(normal_name(F.coalesce(F.col("ako_title"), F.col("course_name"))))
    links = jaccard_links(two, tokens, [F.col("program"), F.lower(F.coalesce(F.col("department"), F.lit("")))], order, threshold)
    gone = greedy_duplicates(links).select(F.col("removed").alias(order))
    clean = two.join(gone, order, "left_anti").withColumn("dedup_status", F.lit("clean"))
    return clean if remove else clean.unionByName(two.join(gone, order, "left_semi").withColumn("dedup_status", F.lit("near_duplicate")))


def removal_report(before: DataFrame, after: DataFrame, target_pct: float = 15.0) -> DataFrame:
    """total_input, total_output, total_removed, duplicate_rate_pct (null for no input), target_met; one row."""
    n = before.agg(F.count(F.lit(1)).alias("total_input")).join(after.agg(F.count(F.lit(1)).alias("total_output")))
    rate = F.round(F.try_divide(100 * (F.col("total_input") - F.col("total_output")), F.col("total_input")), 2)
    return n.select("*", (F.col("total_input") - F.col("total_output")).alias("total_removed"), rate.alias("duplicate_rate_pct")).withColumn("target_met", F.col("duplicate_rate_pct") < target_pct)


def soft_dedup(records: DataFrame, order: str, vector: str, category: str = "category", title: str = "title", content: str = "content", version: str = "cleanup_version", rules: DedupRules = DedupRules()) -> DataFrame:
    """Exact, then semantic deduplication of records.

    Equal contents keep the better record. Then clusters within categories, generic titles with the looser
    threshold, keep the better of each. Then records with generic titles that are left are clustered across
    categories. The order of passes is the corrected one: each works on what the one before has kept."""
    exact = keep_better(staged(records), stripped_md5(F.col(content)), F.col(title), F.col(content), F.col(version), order)

    def survivors(df: DataFrame, block: Column) -> DataFrame:
        limit = F.when(C.is_bad_title(F.col(title)), rules.generic).otherwise(rules.strict)
        marked = staged(df.withColumn("_block", block).withColumn("_limit", limit))
        leaders = leader_clusters(marked, "_block", order, vector, "_limit").select(F.col(order).alias("_o"), F.col("leader").alias("_leader"))
        joined = staged(marked.join(leaders, F.col(order) == F.col("_o")))
        return keep_better(joined, F.col("_leader"), F.col(title), F.col(content), F.col(version), order).select(*df.columns)

    within = staged(survivors(exact, F.coalesce(F.col(category), F.lit(""))))
    bad = C.is_bad_title(F.col(title))
    return within.filter(~bad).unionByName(survivors(within.filter(bad), F.lit("")))


def cluster_report(clusters: DataFrame, block: str, order: str, sims: int = 20, merges: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of `leader_clusters`: the first similarities of each block, the first merges, and counters in one row."""
    merged = clusters.filter(F.col(order) != F.col("leader"))
    n = F.row_number().over(Window.partitionBy(block).orderBy(order))
    first = merged.withColumn("_n", n).filter(F.col("_n") <= sims).select(block, order, "leader", F.round("similarity", 4).alias("similarity"))
    shown = merged.orderBy(block, order).limit(merges).select(block, order, "leader", F.round("similarity", 4).alias("similarity"))
    counts = clusters.agg(F.count(F.lit(1)).alias("input"), F.count_if(F.col(order) == F.col("leader")).alias("clusters"), F.count_if(F.col(order) != F.col("leader")).alias("merged"), F.countDistinct(block).alias("blocks"))
    return first, shown, counts
