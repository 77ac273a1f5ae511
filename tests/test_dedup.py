import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import clusters as K
from millrace.operators import dedup as D


def test_keep_first_and_better(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (4, None, "w"), (5, "", "v")], "o int, k string, v string")
    assert sorted(r.o for r in D.keep_first(df, F.col("k"), ["o"]).collect()) == [1, 2, 5]
    assert sorted(r.o for r in D.keep_first(df, F.col("k"), ["o"], always=F.col("k") == "").collect()) == [1, 2, 5]
    rec = spark.createDataFrame([(1, "overview", "same text here", "rule"), (2, "A good title", "same text here", "rule"), (3, "A good title", "same text here", "ollama_llm_v2"), (4, "Other good title", "else", None)], "o int, t string, c string, v string")
    assert sorted(r.o for r in D.keep_better(rec, D.stripped_md5(F.col("c")), F.col("t"), F.col("c"), F.col("v"), "o").collect()) == [3, 4]


def test_greedy_jaccard_against_the_sequential_rule(spark):
    rng = random.Random(4)
    rows = []
    for i in range(160):
        base = rng.choice([list("abcdefghij"), list("klmnopqrst"), list("abcdeklmno")])
        rows.append((i, rng.choice("xy"), " ".join(w for w in base if rng.random() > 0.12)))
    df = spark.createDataFrame(rows, "o int, b string, t string")
    links = D.jaccard_links(df, T.words(F.col("t")), [F.col("b")], "o", 0.8)
    got = {tuple(r) for r in D.greedy_duplicates(links).select("removed").collect()}
    sets = {o: (b, set(t.split())) for o, b, t in rows}
    kept, gone = [], set()
    for o, (b, s) in sorted(sets.items()):
        hit = [k for k in kept if sets[k][0] == b and s and sets[k][1] and len(s & sets[k][1]) / len(s | sets[k][1]) >= 0.8]
        gone.add(o) if hit else kept.append(o)
    assert {x[0] for x in got} == gone


def test_whole_sets_are_sent_for_similar_pairs_only(spark, monkeypatch):
    """Pairs of large sets that meet and are not similar are left out by their parities, before sets are sent."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(700)]
    texts = [" ".join([*rng.sample(base, 600 if i < 30 else 680), *(f"x{i}_{k}" for k in range(40))]) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "o int, t string")
    seen = {}

    def kept(df, real=D.staged):
        got = real(df)
        seen[tuple(got.columns)] = got.count()
        return got

    monkeypatch.setattr(D, "staged", kept)
    got = {(r.i, r.j) for r in D.jaccard_links(df, T.words(F.col("t")), [], "o", 0.8).collect()}
    sets = [set(t.split()) for t in texts]
    want = {(i, j) for j in range(40) for i in range(j) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    assert got == want and len(want) >= 45
    assert len(want) <= seen["i", "j", "m", "n"] <= 2 * len(want)


def test_three_passes(spark):
    rows = [
        (1, "A1", "Name One", "P", "D", "1", "long " + " ".join(f"t{i}" for i in range(30))),
        (2, "a1 ", "Other", "P", "D", "1", "x"),
        (3, "", "Name one!", "p", "d", "1", "y"),
        (4, "B1", "Third", "P", "D", "2", "lang " + " ".join(f"t{i}" for i in range(30))),
        (5, None, "Fourth", "P", "E", "2", "long " + " ".join(f"t{i}" for i in range(30))),
    ]
    df = spark.createDataFrame(rows, "o int, course_code string, course_name string, program string, department string, semester string, ako_title string")
    assert sorted(r.o for r in D.dedup_courses(df, "o").collect()) == [1, 5]
    flagged = {r.o: r.dedup_status for r in D.dedup_courses(df, "o", remove=False).collect()}
    assert flagged == {1: "clean", 4: "near_duplicate", 5: "clean"}
    r = D.removal_report(df, D.dedup_courses(df, "o")).first()
    assert (r.total_input, r.total_output, r.total_removed, r.duplicate_rate_pct, r.target_met) == (5, 2, 3, 60.0, False)
    assert D.removal_report(df.limit(0), df.limit(0)).first().duplicate_rate_pct is None


def sequential_leaders(rows, limits):
    """rows: (order, block, vector); the rule, one row at a time."""
    leaders, out = {}, {}
    for (i, b, x), limit in sorted(zip(rows, limits, strict=True), key=lambda r: r[0][0]):
        mine = leaders.setdefault(b, [])
        sims = [round(float(np.dot(x, y)), 12) for _, y in mine]
        if sims and max(sims) >= limit:
            out[i] = (mine[int(np.argmax(sims))][0], max(sims))
        else:
            mine.append((i, x))
            out[i] = (i, 1.0)
    return out


def cluster_rows(n, blocks, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[n - copies :] = v[rng.integers(0, max(1, n - copies), copies)]  # ties
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(float)
    rows = [(int(o), None if b == 0 else int(b), v[i]) for i, (o, b) in enumerate(zip(rng.permutation(n), rng.integers(0, blocks, n), strict=True))]
    return rows, [float(x) for x in rng.choice([0.6, 0.8, 0.9], n)]


@pytest.mark.parametrize("stretch,bucket,block_rows,slice_rows", [(16_384, 512, 8_192, 1_024), (8, 2, 7, 3), (1, 1, 3, 2)])
def test_leader_clusters_against_the_sequential_rule(spark, monkeypatch, stretch, bucket, block_rows, slice_rows):
    """One round or many, with thresholds of their own, ties, and a null block: the same clusters."""
    for name, value in (("STRETCH", stretch), ("BUCKET", bucket), ("BLOCK_ROWS", block_rows), ("SLICE", slice_rows)):
        monkeypatch.setattr(K, name, value)
    rows, limits = cluster_rows(130 if stretch > 1 else 40, 3, 3, 1, copies=15)
    df = spark.createDataFrame([(*r[:2], r[2].tolist(), x) for r, x in zip(rows, limits, strict=True)], "o int, b int, v array<float>, x double").select("*", *[F.lit(1).alias(c) for c in ("at", "k", "near", "n", "block", "_part")])
    got = {r.o: (r.leader, r.similarity) for r in D.leader_clusters(df, "b", "o", "v", "x").collect()}
    want = sequential_leaders(rows, limits)
    assert {o: a for o, (a, _) in got.items()} == {o: a for o, (a, _) in want.items()}
    assert all(abs(got[o][1] - want[o][1]) < 1e-9 for o in want)


def test_leader_clusters_odd_rows(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 1, None), (3, None, [1.0, 0.0]), (4, None, [1.0, 0.0])], "o int, b int, v array<float>")
    assert sorted(map(tuple, D.leader_clusters(df, "b", "o", "v", 0.9).select("o", "leader", "similarity").collect())) == [(1, 1, 1.0), (2, 2, None), (3, 3, 1.0), (4, 3, 1.0)]
    assert D.leader_clusters(df.limit(0), "b", "o", "v", 0.9).count() == 0


def test_no_task_clusters_a_long_block(spark, monkeypatch):
    """Of a block of 6,000 rows a task never gets more than a stretch or a pair of blocks."""
    monkeypatch.setattr(K, "STRETCH", 600)
    monkeypatch.setattr(K, "BUCKET", 50)
    monkeypatch.setattr(K, "BLOCK_ROWS", 500)
    rows, _ = cluster_rows(6000, 1, 8, 2)
    df = spark.createDataFrame([(o, 1, v.tolist()) for o, _, v in rows], "o int, b int, v array<float>")
    got = D.leader_clusters(df, "b", "o", "v", 0.75)
    want = sequential_leaders(rows, [0.75] * len(rows))
    assert {r.o: r.leader for r in got.collect()} == {o: a for o, (a, _) in want.items()}
    block = spark.range(6000).select(F.struct(F.lit(1).alias("block")).alias("at"), F.col("id").alias("o"))
    sizes = [r["count"] for r in K._sliced(block, K._slices(block, "n"), "n", "slice").groupBy("slice").count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 600


def test_clusters_of_blocks_that_are_never_null(spark, monkeypatch):
    """Blocks and vectors that can't be null, as `soft_dedup` makes them, go through rounds too."""
    monkeypatch.setattr(K, "STRETCH", 8)
    monkeypatch.setattr(K, "BUCKET", 4)
    v = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i == F.col("id") % 5, 1.0).otherwise(0.0).cast("float"))
    df = spark.range(60).select("id", F.coalesce((F.col("id") % 2).cast("string"), F.lit("")).alias("b"), v.alias("v"))
    assert not df.schema["b"].nullable and not df.schema["v"].dataType.containsNull
    got = {r.id: (r.leader, r.similarity) for r in D.leader_clusters(df, "b", "id", "v", 0.9).collect()}
    assert got == {i: (i % 10, 1.0) for i in range(60)}


def test_soft_dedup_passes(spark):
    unit = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [
        ("1", "k", "A good long title", "text one", "rule", unit(0.0)),
        ("2", "k", "Another good title", "text two with more words", "rule", unit(0.3)),
        ("3", "k", "Overview", "text three", "rule", unit(0.6)),
        ("4", "m", "Overview", "text four", "rule", unit(0.9)),
        ("5", "m", "Overview", "text four", "rule", unit(2.5)),
    ]
    df = spark.createDataFrame(rows, "id string, category string, title string, content string, cleanup_version string, v array<float>")
    # 5 equals 4; 2 is within 0.90 of 1 and has more words; 3 joins leader 1 at 0.825 (generic), 4 stays
    assert sorted(r.id for r in D.soft_dedup(df, "id", "v").collect()) == ["2", "4"]


def test_cluster_report(spark):
    df = spark.createDataFrame([(i, 0, 0, 0.91234) if i else (0, 0, 0, 1.0) for i in range(30)], "o int, b int, leader int, similarity double")
    sims, merges, counts = D.cluster_report(df, "b", "o", merges=5)
    assert (sims.count(), merges.count(), tuple(counts.first())) == (20, 5, (30, 1, 29, 1))


def test_greedy_jaccard_reads_whole_texts(spark, tmp_path):
    from millrace import queries as Q

    head = " ".join(f"h{i}" for i in range(60))
    tails = [" ".join(f"{k}{i}" for i in range(60)) for k in "abc"]
    near = " ".join(["other"] * 40 + [f"n{i}" for i in range(80)])
    texts = [f"{head} {tails[0]}", f"{head} {tails[1]}", f"{head} {tails[2]}", near, "first " * 40 + near]
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.QUERIES["greedy_jaccard"](spark, str(tmp_path)).collect()
    assert [(r.removed, r.kept) for r in got] == [(4, 3)]
