import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import audit, evaluate
from millrace.operators import vectors as V


def _frame(spark, n=80, dim=6, blocks=4, seed=0):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return v, spark.createDataFrame([(i, i % blocks, v[i].tolist()) for i in range(n)], "pos int, b int, embedding array<float>")


def test_purity_closed_form(spark):
    v, df = _frame(spark)
    for r in V.pairwise_purity(df, "b", "embedding").collect():
        w = v[r.b :: 4].astype(float)
        want = np.mean([w[i] @ w[j] for i in range(len(w)) for j in range(i + 1, len(w))])
        assert abs(r.purity - want) < 1e-6
    assert V.pairwise_purity(df.filter("pos = 0"), "b", "embedding").first().purity == 1.0


def test_top_k_and_ties(spark):
    v, df = _frame(spark)
    twice = df.unionByName(df.withColumn("pos", F.col("pos") + 1000))
    got = V.top_k(df.filter("pos < 5").select(F.col("pos").alias("query_id"), F.col("embedding").alias("vector")), twice, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.pos) for r in got if r.rank <= 2] == [x for i in range(5) for x in ((i, 1, i), (i, 2, i + 1000))]
    empty = V.top_k(df.limit(0).select(F.col("pos").alias("query_id"), F.col("embedding").alias("vector")), df, 3)
    assert empty.count() == 0 and "rank" in empty.columns


def test_query_blocks_give_the_same(spark, monkeypatch):
    _, df = _frame(spark)
    q = df.select(F.col("pos").alias("query_id"), F.col("embedding").alias("vector"))
    one = {tuple(r) for r in V.top_k(q, df, 2).select("query_id", "pos", "rank").collect()}
    monkeypatch.setattr(V, "QUERY_BYTES", 1000)
    assert one == {tuple(r) for r in V.top_k(q, df, 2).select("query_id", "pos", "rank").collect()}


def test_quartiles_and_percentiles(spark):
    for n in (2, 3, 4, 7, 20):
        x = [float((i * 37) % 11) for i in range(n)]
        df = spark.createDataFrame([(a,) for a in x], "x double")
        got = V.exclusive_quartiles(df, "x").first()
        assert np.allclose(list(got), statistics.quantiles(x, n=4))
        assert np.allclose(list(V.percentiles(df, "x").first())[:5], np.percentile(x, [10, 25, 50, 75, 90]))
    assert list(V.exclusive_quartiles(df.limit(1), "x").first()) == [None] * 3


def test_embedding_hook(spark):
    df = spark.createDataFrame([("a b",), ("a b",), (None,)], "t string")
    a, b, c = [r.embedding for r in V.embed(df, "t", lambda: V.hashing_embedder(16)).collect()]
    assert a == b and len(a) == 16 and abs(sum(x * x for x in a) - 1) < 1e-6 and not any(c)


def test_routing(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.7, 0.72], "x")], "query_id int, vector array<float>, label string")
    index = spark.createDataFrame([("x", 0, [1.0, 0.0]), ("y", 0, [0.0, 1.0])], "db string, pos int, embedding array<float>")
    got = {r.query_id: (r.predicted, r.status) for r in V.route_by_index(q, index, "db", label="label").collect()}
    assert got == {1: ("x", "GOOD_MATCH"), 2: ("y", "WRONG_DB")}
    alone = V.route_by_index(q, index.filter("db = 'x'"), "db").filter("query_id = 1").first()
    assert (alone.runner_up, alone.margin) == (0.0, 1.0)


def test_audit(spark, tmp_path):
    path = str(tmp_path / "audit")
    audit.record_stage(spark, path, "extract", 51)
    r = audit.record_stage(spark, path, "title", 41, input_count=51, extra={"a": 1}).first()
    assert (r.delta, r.delta_pct, r.alarm) == (-10, -19.6, True)
    audit.record_stage(spark, path, "dedup", 0, input_count=0)
    audit.record_stage(spark, path, "dedup", 90, input_count=100)
    h = audit.history(spark, path).collect()
    assert [(x.stage, x.delta_pct, x.alarm) for x in h] == [("extract", None, False), ("title", -19.6, True), ("dedup", None, False), ("dedup", -10.0, False)]
    m = audit.count_mismatch(spark.range(80), audit.history(spark, path), "dedup", ["seq"]).first()
    assert (m.actual, m.recorded, m.differs) == (80, 90, True)


def test_reports_on_empty_tables(spark):
    e = spark.createDataFrame([], "id string, title string, content string, category string, source string, issues array<string>, s double")
    assert evaluate.validation_summary(e, "issues").first().valid_pct is None
    assert evaluate.smoke_checks(e, "id", "content", F.col("title"), F.col("category"), "source").first().passed is False
    assert evaluate.length_buckets(e, "content").first().n == 0
    assert evaluate.purity_calibration(e, "s", 0.25).first().high_pct is None


def test_retrieval_metrics_and_coverage(spark):
    hits = spark.createDataFrame([(1, 1, 0.9, "a", "c"), (1, 2, 0.5, "a", "c"), (2, 1, 0.4, "b", None)], "query_id int, rank int, score double, title string, code string")
    r = evaluate.retrieval_metrics(hits, "title", F.col("code").isNotNull()).first()
    assert (r.good_pct, r.duplicate_pct, r.complete_pct, r.targets_met) == (50.0, 33.33, 66.67, False)
    docs = spark.createDataFrame([("one two",), ("three",)], "content string")
    assert {x.query: x.passed for x in evaluate.query_coverage(docs, "content", {"q": ["one", "two"], "r": ["one", "three"]}).collect()} == {"q": True, "r": False}
    t = evaluate.title_issues(spark.createDataFrame([("GOOD TITLE",), ("bad",), ("",)], "t string"), "t").first()
    assert (t.empty, t.short, t.mixed_case, t.verdict) == (1, 1, 1, "NEEDS WORK")
    base = evaluate.baseline_delta(docs.withColumn("k", F.lit("a")), docs.withColumn("k", F.lit("b")), "k", "content")
    assert {(x.k, x.now_n, x.before_n, x.delta) for x in base.collect()} == {("a", 2, 0, 2), ("b", 0, 2, -2)}


def test_routing_report(spark):
    hits = spark.createDataFrame([(1, "x", 5, 0.5, 1), (1, "x", 6, 0.4, 2), (1, "y", 7, 0.7, 1)], "query_id int, db string, pos int, score double, rank int")
    r = V.routing_report(hits, "db").first()
    assert r.scores == {"x": 0.5, "y": 0.7} and [h.pos for h in r.top_hits["x"]] == [5, 6]


def slow_boundaries(v, threshold, least=5):
    sims = [float(a @ b) for a, b in zip(v, v[1:], strict=False)]
    smooth = [float(np.mean(sims[max(0, i - 2) : i + 3])) for i in range(len(sims))]
    ends = []
    for i in range(1, len(v)):
        if smooth[i - 1] < threshold and i - (ends[-1] if ends else 0) >= least and len(v) - i >= least:
            ends.append(i)
    return sims, smooth, ends


@pytest.mark.parametrize("chunk", [2, 3, 7, 4096])
def test_folds_over_stretches(spark, monkeypatch, chunk):
    """Similarities, averages and boundaries of a block in stretches of any length are those of one fold."""
    monkeypatch.setattr(V, "CHUNK", chunk)
    v, df = _frame(spark, n=90, blocks=3)
    df = df.filter("b < 2 or pos = 2").withColumn("b", F.nullif(F.col("b"), F.lit(1)))
    of = {0: v[0::3], None: v[1::3], 2: v[2:3]}
    got = {(r.b, r.pos): (r.similarity, r.smooth) for r in V.adjacent_similarity(df, "b", "pos", "embedding").collect()}
    for b, w in of.items():
        w = w.astype(float)
        for threshold in (-0.2, 0.0, 0.3):
            sims, smooth, _ = slow_boundaries(w, threshold)
        first = {0: 0, None: 1, 2: 2}[b]
        assert np.allclose([got[b, first + 3 * i] for i in range(len(sims))], list(zip(sims, smooth, strict=True))) if sims else True
    assert len(got) == 58
    for threshold in (-0.2, 0.0, 0.3):
        ends = {r.b: (r.n, r.ends) for r in V.topic_boundaries(df, "b", "pos", "embedding", threshold).collect()}
        assert ends == {b: (len(w), slow_boundaries(w.astype(float), threshold)[2]) for b, w in of.items()}
    assert V.topic_boundaries(df.limit(0), "b", "pos", "embedding", 0.1).count() == 0


def test_long_blocks_are_many_tasks(spark, monkeypatch):
    """A block of 3,000 rows is dealt in stretches: no window or fold sees more than a stretch and its ends."""
    monkeypatch.setattr(V, "CHUNK", 100)
    df = spark.range(3000).select(F.lit(1).alias("b"), F.col("id").alias("o"), F.array(F.sin("id"), F.cos("id")).cast("array<float>").alias("v"))
    sims = V._similarities(df, "b", "o", "v")
    assert max(r["count"] for r in V._haloed(sims, 2, 2).groupBy("at", "chunk").count().collect()) <= 104
    assert sims.count() == 2999 and V.topic_boundaries(df, "b", "o", "v", 0.6).first().n == 3000
