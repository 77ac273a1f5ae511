"""N-gram Jaccard join: a MinHash LSH forest proposes, exact sets of word shingles decide."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHash, arrow_rows, fresh, hub_join, mix, stored, text_bytes

#: Words of a shingle; trees of the forest and the longest prefix of each; recall at the threshold to reach.
WORDS, TREES, LONGEST, RECALL = 5, 20, 6, 0.9999
#: Members of a bucket or component block that are compared in one task, and bytes of a component block.
BLOCK, BLOCK_BYTES = 2_048, 16 << 20
#: How far below the threshold a candidate pair's estimated similarity may lie: over four deviations of an estimate
#: from TREES * LONGEST values. At 0.8 it loses a pair with probability 0.000017; a slack of 1 checks all that meet.
SLACK = 0.16
#: Stands for a null id, behind all others.
NO_ID = (1 << 63) - 1

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SEEDS = np.random.RandomState(20240601).randint(1, 2**32, size=(2, TREES * LONGEST), dtype=np.uint64).astype(np.uint32)
_SEEDS[0] |= np.uint32(1)


def meeting(similarity: float, depth: int) -> float:
    """The probability that two sets share a prefix of `depth` values in one of TREES trees at least."""
    return 1 - (1 - similarity**depth) ** TREES


def prefix_depth(threshold: float, recall: float = RECALL) -> int:
    """The longest prefix at which pairs just at the threshold meet with probability `recall`: no need to go below."""
    return next((d for d in range(LONGEST, 0, -1) if meeting(threshold, d) >= recall), 1)


def estimated_recall(agreements: dict[int, int], depth: int, threshold: float, at: int | None = None) -> float:
    """The share of all links that a forest matched at prefixes of `at` values (`depth`, if not given) finds, judged
    by the links found at `depth`.

    agreements: how many found pairs agree in so many of their TREES * LONGEST values. A found pair stands for
    1 / (its probability of being found) links. Its similarity is taken a deviation lower than estimated, but for
    the threshold, so the recall is rather under- than overestimated. Without a found link it is 0."""
    found = expected = 0.0
    for agree, n in agreements.items():
        s = (agree / (TREES * LONGEST) - 1 / 256) / (1 - 1 / 256)  # values are compared by their low bytes
        if s < threshold:
            continue
        s = max(threshold, s - (s * (1 - s) / (TREES * LONGEST)) ** 0.5)
        links = n / meeting(s, depth)
        found += links * meeting(s, at or depth)
        expected += links
    return found / expected if found else 0.0


def shingle_sets(texts: list[bytes | None], memo: WordHash) -> list[np.ndarray]:
    """Sorted hashes of each text's word shingles. Words are runs without ASCII white space, A-Z in lower case
    and ASCII punctuation left out; a text of fewer words than WORDS is one shingle, one without words has none."""
    out = []
    for t in texts:
        words = (t or b"").translate(_LOWER, _PUNCTUATION).split()
        h = memo.of(words)
        n = max(1, len(h) - WORDS + 1) if len(h) else 0
        width = min(WORDS, len(h))
        acc = np.full(n, width, np.uint64)
        for k in range(width):
            acc = mix(acc ^ h[k : k + n]) + np.uint64(k)
        out.append(np.unique(acc))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * LONGEST minimum hashes of a set with members."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(len(_SEEDS[0]), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        best = np.minimum(best, (_SEEDS[0][:, None] * x[None, at : at + 1024] + _SEEDS[1][:, None]).min(1))
    return best


def node_of(shingles: np.ndarray) -> bytes:
    """A set's name: a 128-bit hash of it, so that no two different sets of any corpus share one."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def packed(values: np.ndarray) -> bytes:
    """The low bytes of all minimum hashes, then their second bytes."""
    return values.astype(np.uint8).tobytes() + (values >> np.uint32(8)).astype(np.uint8).tobytes()


def signed_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, node (null without words), n_shingles and sig (two bytes of each minimum hash, see `packed`)."""

    def make():
        memo = WordHash()

        def work(batch: pa.RecordBatch):
            sets = shingle_sets(text_bytes(batch.column(2)), memo)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([packed(signature(s)) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "node", "n_shingles", "sig"],
            )

        return work

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(arrow_rows(make), "doc_id long, text_hash long, node binary, n_shingles long, sig binary")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a partition sorted by `key`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if held and (cut or held[-1].column(key)[-1].as_py() != keys[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _spans(keys: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def _merge(labels: np.ndarray, a: int, b: int) -> None:
    if labels[a] != labels[b]:
        lo, hi = sorted((labels[a], labels[b]))
        labels[labels == hi] = lo


def link_bucket(sig: np.ndarray, tails: np.ndarray, least: float) -> np.ndarray:
    """Labels of the members of one bucket that the signatures' agreement connects.

    tails: the bytes of the tree's minimum hashes beyond the bucket's prefix. Members are sorted by them, as in
    the tree; those that agree in all of them are compared first, then the prefix is shortened step by step, and
    only members that are not connected yet are compared. Within a step each member reached takes those that
    agree with it out of the rest, so a bucket of copies costs about one comparison a member.
    """
    n = len(sig)
    labels = np.arange(n)
    order = np.lexsort(tails.T[::-1]) if tails.shape[1] else np.arange(n)
    for length in range(tails.shape[1], -1, -1):
        head = tails[order, :length]
        new = np.r_[True, (head[1:] != head[:-1]).any(1)] if length else np.r_[True, np.zeros(n - 1, bool)]
        edges = np.r_[np.flatnonzero(new), n]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            rest = order[lo:hi]
            if len(rest) < 2 or (labels[rest] == labels[rest[0]]).all():
                continue
            while len(rest):
                first = labels[rest[0]]
                reached, rest = list(rest[labels[rest] == first]), rest[labels[rest] != first]
                while reached and len(rest):
                    x = reached.pop()
                    near = (sig[rest] == sig[x]).mean(1) >= least
                    if near.any():
                        joined = np.unique(labels[rest[near]])
                        took = np.isin(labels[rest], joined)
                        reached.extend(rest[took])
                        rest = rest[~took]
                        labels[np.isin(labels, joined)] = first
    return labels


def _block_pairs(df: DataFrame, group: str, blocks: str) -> DataFrame:
    """Rows dealt to pairs of blocks of their group, `pair` = (i, j) with i <= j, and `own` the row's block.

    A group of b blocks has b * (b + 1) / 2 tasks, and each row goes to b of them."""
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    out = df.withColumn("own", own).withColumn("_other", other)
    out = out.withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other"))
    return out.withColumn("g", F.xxhash64(group, "i", "j")).drop("_other")


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node of its connected component) for all ends of edges a - b.

    Large-star and small-star steps in turn: every node's larger (then smaller) neighbours are hung on its
    smallest one, until the edges are stars. The smallest neighbours come from aggregations with partial results,
    and reach the edges by `hub_join`, so a node with very many edges is no task of its own. Nothing but a count
    and a sum a round comes to the driver; each round is a table in the shared folder.
    """
    one = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now = stored(one, "edges")
    state, n = None, now.count()
    least = lambda e, own: e.groupBy("a").agg((F.least(F.min("b"), F.first("a")) if own else F.min("b")).alias("m"), F.count(F.lit(1)).alias("_n"))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = hub_join(both, least(both, True), "a", "_n", 2 * n).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "edges")
        low = least(large, False)
        small = hub_join(large, low, "a", "_n", n).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        now = stored(small, "edges")
        n, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, total) == state:
            break
        state = n, total
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def candidate_edges(classes: DataFrame, depth: int, least: float, partitions: int) -> DataFrame:
    """Edges a - b that connect the classes which share a prefix of `depth` values in a tree and agree in `least` of
    their signatures, with the number of values in which the two agree."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    low = lambda t: F.substr("sig", t * LONGEST + 1, F.lit(depth))
    high = lambda t: F.substr("sig", t * LONGEST + TREES * LONGEST + 1, F.lit(depth))
    prefixes = F.transform(trees, lambda t: F.struct(t.alias("tree"), F.xxhash64(low(t), high(t), t).alias("bucket")))
    members = classes.select("node", F.explode(prefixes).alias("x")).select("node", "x.*")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = members.join(sizes, "bucket").select("node", "tree", "bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    signs = classes.select("node", F.substr("sig", F.lit(1), F.lit(TREES * LONGEST)).alias("sig"))
    dealt = _block_pairs(met.join(signs, "node"), "bucket", "blocks").select("g", "node", "tree", "sig")

    def link(batches):
        for table in whole_groups(batches, "g"):
            keys, trees_ = table.column("g").to_numpy(), table.column("tree").to_numpy()
            nodes = np.array(table.column("node").to_pylist(), object)
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(keys), -1)
            a, b, agree = [], [], []
            # neighbours of all groups at once: most groups have two members
            near = (keys[1:] == keys[:-1]) & ((sig[1:] == sig[:-1]).mean(1) >= least)
            for lo, hi in _spans(keys):
                if hi - lo < 2:
                    continue
                if near[lo : hi - 1].all():
                    labels = np.zeros(hi - lo, np.int64)
                elif hi - lo == 2:
                    continue
                else:
                    part, tree = sig[lo:hi], int(trees_[lo])
                    labels = link_bucket(part, part.reshape(hi - lo, TREES, LONGEST)[:, tree, depth:], least)
                for k in np.unique(labels):
                    mine = lo + np.flatnonzero(labels == k)
                    if len(mine) > 1:
                        root = mine[nodes[mine].argmin()]
                        others = mine[mine != root]
                        a.append(nodes[others])
                        b.append(np.full(len(others), nodes[root], object))
                        agree.append((sig[others] == sig[root]).sum(1))
            flat = lambda x, t: pa.array(np.concatenate(x).tolist() if x else [], t)
            yield pa.RecordBatch.from_arrays([flat(a, pa.binary()), flat(b, pa.binary()), flat(agree, pa.int32())], names=["a", "b", "agree"])

    by_group = dealt.repartition(partitions, "g").sortWithinPartitions("g")
    return by_group.mapInArrow(link, "a binary, b binary, agree int")


def forest_edges(classes: DataFrame, threshold: float, recall: float, slack: float, partitions: int) -> tuple[DataFrame, int, float]:
    """Candidate edges, the length of the prefixes matched at last, and the estimated recall there.

    The matched prefixes begin at their full length. As long as the links found let expect that less than `recall`
    of all links is among them, the prefixes get shorter, by as much as the estimate says it takes, at the most to
    where pairs just at the threshold meet so often. Each length tried is one pass over all classes; a count for
    each number of agreeing values, TREES * LONGEST at most, goes to the driver."""
    last, depth = prefix_depth(threshold, recall), LONGEST
    while True:
        edges = stored(candidate_edges(classes, depth, max(0.0, threshold - slack), partitions).distinct(), "edges")
        agreements = dict(map(tuple, edges.groupBy("agree").count().collect()))
        reached = estimated_recall(agreements, depth, threshold)
        if reached >= recall or depth <= last:
            return edges.select("a", "b"), depth, reached
        shorter = range(depth - 1, last, -1)
        depth = next((d for d in shorter if estimated_recall(agreements, depth, threshold, d) >= recall), last)


def verify_group(sets: list[np.ndarray], weights: np.ndarray, own: np.ndarray, cross: bool, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Of a component's sets: how many documents each is linked to, and labels of what the links connect.

    Intersections are counted over an inverted index of the shingles, a set at a time. With `cross` only sets of
    different blocks are linked here, the others being another task's."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, where = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(n), sizes)
    order = np.argsort(where, kind="stable")
    posting, ends = doc[order], np.searchsorted(where[order], np.arange(where.max(initial=-1) + 2))
    start = np.r_[0, np.cumsum(sizes)]
    links, labels = np.zeros(n, np.int64), np.arange(n)
    for i in range(n):
        mine = where[start[i] : start[i + 1]]
        count = ends[mine + 1] - ends[mine]
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(ends[mine], count)
        inter = np.bincount(posting[at], minlength=n)
        union = sizes + sizes[i] - inter
        near = (inter * threshold.denominator >= union * threshold.numerator) & (inter > 0)
        near[i] = False
        if cross:
            near &= own != own[i]
        links[i] = weights[near].sum()
        if near.any():
            joined = np.unique(labels[np.r_[np.flatnonzero(near), i]])
            labels[np.isin(labels, joined)] = joined[0]
    return links, labels


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rep, text_hash, text of all documents; of those without an id, whose rep is NO_ID, one a text."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    unnamed = texts.filter("rep is null").dropDuplicates(["text_hash"]).withColumn("rep", F.lit(NO_ID))
    return texts.filter("rep is not null").unionByName(unnamed)


def verified(docs: DataFrame, found: DataFrame, threshold: float, partitions: int, id_col: str, text_col: str) -> DataFrame:
    """node, links, root, whole: links of each class found in one task, and the smallest node it is connected to there.

    found: node, rep and text_hash (of a document that has it), copies, comp, blocks (of its component). A text is
    shuffled once to find the candidates' texts; only those are cut into shingles, and go to their component's tasks."""
    limit = Fraction(str(threshold))
    wanted = _texts(docs, id_col, text_col).join(found.hint("shuffle_hash"), ["rep", "text_hash"]).select("text", "node", "copies", "comp", "blocks")
    kinds = "node binary, copies long, comp binary, blocks long, shingles binary"

    def make():
        memo = WordHash()

        def work(batch: pa.RecordBatch):
            sets = shingle_sets(text_bytes(batch.column(0)), memo)
            # another text may have the same hash
            keep = [i for i, s in enumerate(sets) if len(s) and node_of(s) == batch.column(1)[i].as_py()]
            cut = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(cut.column(k) for k in range(1, 5)), pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=[x.split()[0] for x in kinds.split(", ")])

        return work

    def check(batches):
        for table in whole_groups(batches, "g"):
            out: list[tuple] = []
            columns = {c: table.column(c).to_numpy() for c in ("g", "copies", "own", "i", "j", "blocks")}
            columns["node"] = np.array(table.column("node").to_pylist(), object)
            blobs = table.column("shingles")
            for lo, hi in _spans(columns["g"]):
                _, first = np.unique(columns["node"][lo:hi], return_index=True)  # of repeated rows one
                rows = lo + np.sort(first)
                sets = [np.frombuffer(blobs[int(r)].as_py(), np.uint64) for r in rows]
                cross = bool(columns["i"][lo] != columns["j"][lo])
                nodes = columns["node"][rows]
                links, labels = verify_group(sets, columns["copies"][rows], columns["own"][rows], cross, limit)
                for k in np.unique(labels):
                    mine = np.flatnonzero(labels == k)
                    root = nodes[mine].min()
                    out += [(nodes[m], int(links[m]), root, bool(columns["blocks"][lo] == 1)) for m in mine]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary(), pa.bool_()))], names=["node", "links", "root", "whole"])

    cut = wanted.mapInArrow(arrow_rows(make), kinds)
    dealt = _block_pairs(cut, "comp", "blocks").select("g", "node", "copies", "own", "i", "j", "blocks", "shingles")
    return dealt.repartition(partitions, "g").sortWithinPartitions("g").mapInArrow(check, "node binary, links long, root binary, whole boolean")


def jaccard_join(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL, slack: float = SLACK) -> DataFrame:
    """Near-duplicate groups of whole texts: doc_id, copy_id, class_id, n_links, one row a document.

    Two documents are linked if the Jaccard similarity of their sets of 5-word shingles is `threshold` or more.
    copy_id: the smallest id with the same set; class_id: the smallest id of all documents connected by links;
    n_links: how many other documents this one is linked to, copies of its own set included.

    Equal sets become one class first. Classes meet where they share a prefix of a tree's signature, in any of
    TREES trees; the prefixes are shortened until the links found let expect `recall` of all (`forest_edges`).
    Those that meet are candidates if their whole signatures agree in threshold - slack of their values.
    Candidates' connected components then get their true similarities, all pairs of a component by way of an
    inverted index; large buckets and components are compared in pairs of blocks, so that no task holds more than
    two blocks. No pair is ever a row. For an exact join take a slack of 1 and a recall near 1.

    Null texts and texts without words are linked to none. Repeated rows are copies of each other. Null ids are
    kept and linked, but are never the smallest; a group without any id has a null class_id. Texts are compared
    whole, however long. Other columns don't matter. An empty table gives an empty result.
    """
    signed, known = _grouped(docs, threshold, id_col, text_col, recall, slack)
    worded = signed.filter("node is not null").select("doc_id", "node")
    out = hub_join(worded, known, "node", "copies", worded.count()).select("doc_id", "copy_id", "class_id", "n_links")
    lone = [F.lit(None).cast("long").alias("copy_id"), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")]
    out = out.unionByName(signed.filter("node is null").select("doc_id", *lone))
    real = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(NO_ID)), F.col("doc_id"))
    return out.select("doc_id", real("copy_id").alias("copy_id"), real("class_id").alias("class_id"), "n_links")


def _grouped(docs: DataFrame, threshold: float, id_col: str, text_col: str, recall: float, slack: float) -> tuple[DataFrame, DataFrame]:
    """The rows of `signed_docs`, and of each class node, copy_id, class_id, class_hash (the text hash of the
    group's document with the smallest id) and n_links. NO_ID stands for null ids."""
    spark = docs.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    signed = stored(signed_docs(docs, id_col, text_col), "signed")
    one = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), "text_hash", "n_shingles", "sig")).alias("x")
    classes = signed.filter("node is not null").groupBy("node").agg(one, F.count(F.lit(1)).alias("copies")).select("node", "copies", "x.*")
    classes = stored(classes, "classes")
    edges, _, _ = forest_edges(classes, threshold, recall, slack, partitions)
    grown = components(edges).join(classes.select("node", "rep", "text_hash", "copies", "n_shingles"), "node")
    sizes = grown.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(8 * F.sum("n_shingles") / BLOCK_BYTES)).alias("blocks"))
    found = grown.join(sizes, "comp").select("node", "rep", "text_hash", "copies", "comp", "blocks")
    links = stored(verified(docs, found, threshold, partitions, id_col, text_col), "links")
    total = links.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.min("whole").alias("whole"))
    parts = links.filter(~F.col("whole"))
    label = total.select("node", "links", "root")
    if parts.limit(1).count():
        joined = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
        label = label.join(joined, "node", "left").select("node", "links", F.coalesce("comp", "root").alias("root"))
    known = classes.select("node", "copies", "rep", "text_hash").join(label, "node", "left")
    known = known.select("node", "copies", "rep", "text_hash", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    first = known.groupBy("root").agg(F.min(F.struct("rep", "text_hash")).alias("first"))
    first = first.select("root", F.col("first.rep").alias("class_id"), F.col("first.text_hash").alias("class_hash"))
    known = known.join(first, "root").select("node", "copies", F.col("rep").alias("copy_id"), "class_id", "class_hash", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return signed, stored(known, "known")


def keep_one(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL, slack: float = SLACK) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; of repeated rows one.

    A group without any id keeps one of its documents too. Documents without words stay, each. Texts are shuffled
    once by (id, text hash) to meet the list of what stays, and never sorted; only where rows repeat both are those
    rows, and no others, reduced to one. Columns of any names may come along; an empty table stays empty."""
    signed, known = _grouped(docs, threshold, id_col, text_col, recall, slack)
    mine = docs.columns
    key, mark, times = fresh(docs, "_id"), fresh(docs, "_hash"), fresh(docs, "_times")
    rows = docs.withColumn(key, F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))).withColumn(mark, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    here = signed.select(F.coalesce("doc_id", F.lit(NO_ID)).alias(key), F.col("text_hash").alias(mark), "node")
    best = known.select(F.col("class_id").alias(key), F.col("class_hash").alias(mark)).distinct()
    repeats = here.filter("node is not null").groupBy(key, mark).agg(F.count(F.lit(1)).alias(times))
    wordless = here.filter("node is null").select(key, mark, F.lit(1).cast("long").alias(times)).distinct()
    kept = stored(repeats.join(best, [key, mark], "left_semi").unionByName(wordless), "kept")
    joined = rows.join(kept.hint("shuffle_hash"), [key, mark])
    out = joined.filter(F.col(times) == 1)
    if kept.filter(F.col(times) > 1).limit(1).count():
        out = out.unionByName(joined.filter(F.col(times) > 1).dropDuplicates([key, mark]))
    return out.select(*[F.col(f"`{c}`") for c in mine])
