import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, mixing, packing, sharding

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path(TOKENIZER)


def fewest_bins(sizes, capacity):
    best = len(sizes)

    def go(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] >= rest[0]:
                go(rest[1:], bins[:i] + [bins[i] - rest[0]] + bins[i + 1 :])
        go(rest[1:], [*bins, capacity - rest[0]])

    go(sorted(sizes, reverse=True), [])
    return best


def test_bin_completion_finds_the_fewest_bins():
    rng = random.Random(3)
    for trial in range(120):
        capacity = rng.choice([10, 20, 50])
        sizes = [rng.randint(1 if trial % 2 else capacity // 4, capacity if trial % 2 else capacity // 2 + 2) for _ in range(rng.randint(1, 11))]
        bins = packing.bin_completion(Counter(sizes), capacity)
        used = Counter()
        for filling, n in bins:
            assert sum(s * k for s, k in filling) <= capacity
            for s, k in filling:
                used[s] += k * n
        assert used == Counter(sizes) and sum(n for _, n in bins) == fewest_bins(sizes, capacity)
    assert packing.bin_completion(Counter(), 5) == []
    with pytest.raises(ValueError):
        packing.bin_completion(Counter([6]), 5)


def test_fillings_are_undominated():
    got = packing.fillings(Counter([6, 5, 3, 2, 2]), 7)
    assert got[0] in ((5, 2), (3, 2, 2)) and (2, 2) not in got
    assert packing.fillings(Counter([7, 3]), 7) == [(7,)] and packing.fillings(Counter([9]), 7) == [()]


def test_tokens_equal_the_tokenizer(odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    memo = packing.ChunkIds(tokenizer_path())
    rng = random.Random(1)
    texts = [r.text or "" for r in odd.collect()] + ["ÀÉ aªº don't We'LL 1a ½ Ⅷ é é <|endoftext|> İst ŉ ſ ß_x x\x1cy 　z Ω ñandú"]
    texts += ["".join(rng.choice("abÉéñ'!_1 \n<|>ǅžΣ") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    for t in texts:
        assert b"".join(memo[c] for c in t.encode().split()) == np.asarray(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_packing_whole(spark, odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack_documents(odd, tokenizer_path(), capacity=64).collect()
    want = Counter()
    for r in odd.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            part = ids[k : k + 64]
            want[r.doc_id, k // 64, k, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert sorted(bins) == list(range(len(bins))) and len(bins) <= -(-total // 64) + 1
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_differencing():
    rng = random.Random(2)
    for _ in range(40):
        sizes = [rng.randint(0, 30) for _ in range(rng.randint(0, 7))]
        put = sharding.karmarkar_karp(sizes, 2)
        got = abs(sum(s if p else -s for s, p in zip(sizes, put, strict=True)))
        best = min((abs(sum(s if p else -s for s, p in zip(sizes, c, strict=True))) for c in product((0, 1), repeat=len(sizes))), default=0)
        assert got <= best + max(sizes, default=0) // 2
    assert sharding.karmarkar_karp([8, 7, 6, 5, 4], 2).count(0) in (2, 3)
    sizes = [rng.randint(1, 1000) for _ in range(3000)]
    sums = np.bincount(sharding.karmarkar_karp(sizes, 40), sizes, minlength=40)
    assert sums.max() - sums.min() <= 2
    assert sharding.karmarkar_karp([], 3) == [] and sharding.karmarkar_karp([5], 1) == [0]


def test_shards(spark, odd, none):
    got = sharding.shard_by_bytes(odd, shards=3).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    groups = defaultdict(set)
    for r in got:
        groups[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    assert sharding.shard_by_bytes(none).count() == 0
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("int")).alias("text"))
    sums = {r.shard: r.b for r in sharding.shard_by_bytes(many).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    assert len(sums) == 40 and max(sums.values()) - min(sums.values()) <= 0.02 * max(sums.values())


def test_salted_rank(spark, monkeypatch):
    df = spark.range(1000).select(F.when(F.col("id") % 5 > 0, "hot").otherwise(F.lit(None)).alias("k"), F.col("id"))
    got = common.salted_rank(df, ["k"], ["id"], 7, "r").collect()
    for key, n in (("hot", 800), (None, 200)):
        assert sorted(r.r for r in got if r.k == key) == list(range(n))


def test_pfair_deviation():
    for weights in ({"a": 3, "b": 1, "c": 1}, {"a": 0.9, "b": 0.05, "c": 0.03, "d": 0.02}, {str(i): i + 1 for i in range(30)}):
        slots = mixing.whole_shares(weights, 1000)
        period = sum(slots.values())
        order = mixing.pfair(slots)
        assert period == 1000 and Counter(order) == Counter(slots)
        done = Counter()
        for t, k in enumerate(order, 1):
            done[k] += 1
            assert all(abs(done[x] - t * slots[x] / period) < 1 for x in slots)
    assert mixing.whole_shares({}) == {} and mixing.pfair({}) == [] and mixing.whole_shares({"a": 0}) == {}


def test_mixing(spark, odd, none):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 4 > 0, "big").when(F.col("id") % 8 == 0, "small").alias("source"))
    weights = {"big": 0.5, "small": 0.25, None: 0.25}
    got = mixing.mix_sources(docs, weights, block_rows=5)
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    blocks = Counter((r.mix_slot) for r in rows)
    assert all(n <= 5 for n in blocks.values()) and len({(r.mix_slot, r.mix_offset) for r in rows}) == 4000
    inside = Counter(r.source for r in rows if r.in_mix)
    assert inside["small"] + inside[None] >= 990 and abs(inside["big"] - inside["small"] - inside[None]) <= 20
    stream = mixing.mixed_stream(docs, weights=weights, block_rows=5)
    assert stream.columns == docs.columns and [r.doc_id for r in stream.collect()] == [r.doc_id for r in sorted((r for r in rows if r.in_mix), key=lambda r: (r.mix_slot, r.mix_offset))]
    odd_rows = mixing.mix_sources(odd).collect()
    assert len(odd_rows) == odd.count() and mixing.mix_sources(odd).columns == [*[c for c in odd.columns if c != "mix_slot"], "mix_slot", "mix_offset", "in_mix"]
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_stream(none).count() == 0
    unweighted = mixing.mix_sources(docs, {"big": 1.0}).filter("mix_slot is null")
    assert unweighted.count() == 1000 and unweighted.filter("in_mix").count() == 0


def test_a_rare_source_does_not_end_the_stream(spark):
    import corpus_pipeline as cp

    kind = F.when(F.col("id") == 7, None).when(F.col("id") % 4 == 0, "b").otherwise("a")
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), kind.alias("source"), F.lit(1).alias("n_chars"))
    rows = cp.source_mixing(spark, docs, "").collect()
    assert sorted(r.doc_id for r in rows) == list(range(40_000))
    inside = [r.doc_id for r in mixing.mixed_stream(docs).collect()]
    assert len(inside) < 32_768 and [r.doc_id for r in rows[: len(inside)]] == inside
    # sources that still have blocks keep their proportion behind the rare one's end
    share = 3**0.9 / (3**0.9 + 1)
    tail = Counter(r.source for r in rows[32_800:36_800])
    assert abs(tail["a"] / 4_000 - share) < 0.01
    weights = {"a": 1.0, "b": 0.0}
    assert mixing.whole_stream(docs, weights=weights).count() == sum(r.source == "a" for r in rows)


def test_all_fillings_come_in_the_end(monkeypatch):
    rng = random.Random(4)
    sizes = rng.sample(range(20, 90), 28)
    got = packing.fillings(Counter(sizes), 200)
    exact = [c for k in range(2, 6) for c in combinations(sorted(sizes, reverse=True), k) if sum(c) == 200]
    assert len(exact) > 100 and all(c in got or any(packing._fits(c, f) for f in got) for c in exact)
    # nodes are visited again for what a small batch leaves out
    monkeypatch.setattr(packing, "MOST_FILLINGS", 1)
    monkeypatch.setattr(packing, "STEPS", 2)
    monkeypatch.setattr(packing, "best_fit", lambda counts, capacity: [(((s, 1),), n) for s, n in counts.items()])
    for _ in range(60):
        sizes = [rng.randint(3, 14) for _ in range(rng.randint(1, 9))]
        assert sum(n for _, n in packing.bin_completion(Counter(sizes), 20)) == fewest_bins(sizes, 20)


def test_very_many_sources_are_scheduled_as_one(spark, monkeypatch):
    """Sources under a share of the weight go together, by their deadlines: all rows are placed, and the large keep their share."""
    monkeypatch.setattr(mixing, "MOST_SOURCES", 10)
    rows = [(i, "big") for i in range(800)] + [(1000 + i, f"s{i % 60}") for i in range(400)] + [(5000 + i, None) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix_sources(docs, alpha=1.0, block_rows=4).collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows) and len({(r.mix_slot, r.mix_offset) for r in got}) == len(rows)
    order = sorted(got, key=lambda r: (r.mix_slot, r.mix_offset))
    mixed = [r for r in order if r.in_mix]
    for n in range(40, len(mixed), 40):
        assert abs(sum(r.source == "big" for r in mixed[:n]) - n * 800 / 1209) <= 3 * 4
    small = [r.source for r in order if r.source not in ("big", None)]
    for n in (120, 240, 360):  # sources of 6 or 7 rows are two blocks: all have had one when half of them have come
        assert len(set(small[:n])) >= min(60, n // 4)
