"""Odd rows, the same for all: nulls in any column, empty and very long values, ties and repeated rows, empty tables."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import dedup, evaluate, segment, vectors

V = "array<float>"
ROWS = [
    (1, "a", "Title one two", "some content of a record", [1.0, 0.0]), (1, "a", "Title one two", "some content of a record", [1.0, 0.0]), (2, "a", None, "some content of a record", None),
    (3, None, "", "", [0.0, 1.0]), (None, "b", "x", None, [0.6, 0.8]), (None, "b", "x", None, [0.6, 0.8]), (5, "", "Overview", "word " * 20_000, [0.8, 0.6]), (6, "b", "Ünï", "ünï çødé. More! And? yes", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, f"id int, category string, title string, content string, embedding {V}").withColumns({"_k0": F.lit("clash"), "_row": F.lit(1)})


@pytest.fixture(scope="module", params=["rows", "none"])
def table(odd, request):
    return odd if request.param == "rows" else odd.limit(0)


def test_keeping_one(odd, table):
    first = dedup.keep_first(table, F.col("category"), ["id"])
    assert first.columns == odd.columns
    better = dedup.keep_better(table, F.col("content"), F.col("title"), F.col("content"), F.lit("rule"), "id")
    wanted = 0 if not table.limit(1).count() else None
    assert first.count() == (0 if wanted == 0 else 4) and better.count() == (0 if wanted == 0 else 5)


def test_links_and_clusters(table):
    n = table.count()
    links = dedup.jaccard_links(table, T.words(F.col("content")), [F.col("category")], "id", 0.8)
    assert {(r.i, r.j, r.copy) for r in links.collect()} == ({(1, 2, True)} if n else set())
    assert {r.removed for r in dedup.greedy_duplicates(links).collect()} == ({2} if n else set())
    got = dedup.leader_clusters(table, "category", "id", "embedding", 0.9).collect()
    assert len(got) == n and all(r.similarity is None for r in got if r.id in (2, 6))
    kept = dedup.soft_dedup(table.filter("id is not null").dropDuplicates(["id"]).withColumn("cleanup_version", F.lit(None).cast("string")), "id", "embedding")
    assert kept.count() <= n


def test_search(table):
    n = table.filter("embedding is not null").count()
    asked = table.select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    got = vectors.top_k(asked.filter("query_id = 1").dropDuplicates(), table, 3, pos="id")
    assert got.count() == min(3, n)
    assert vectors.top_k(asked, table.limit(0), 3, pos="id").count() == 0


def test_reports_and_chunks(table):
    n = table.count()
    issues = table.select("id", C.chunk_issues(F.col("content")).alias("issues"))
    assert all(r.issues for r in issues.collect())
    assert evaluate.validation_summary(issues, "issues").first().valid == 0
    assert evaluate.chunk_sizes(table, "content").first().oversized == (1 if n else 0)
    assert segment.oversize_rows(table.select("id", F.col("title").alias("section_title"), "content")).count() >= (n > 0) * 100
    markers = table.select("id", F.lit("some content").alias("m"))
    found = evaluate.marker_contamination(table, "id", "content", markers, "id", "m")
    far = evaluate.marker_contamination(table, "id", "content", markers, "id", "m", most_bytes=-1)
    assert sorted(map(str, found.collect())) == sorted(map(str, far.collect())) and (found.count() > 0) == (n > 0)
    assert table.select(C.stringify(table, "embedding").alias("s")).filter("s is null").count() == 0


def test_index(spark, table, tmp_path):
    stats = vectors.write_index(table, ["category", "id"], str(tmp_path / "index")).first()
    assert stats.vectors == table.count()
    got = vectors.read_index(spark, str(tmp_path / "index"), 2)
    assert sorted(r.pos for r in got.collect()) == list(range(stats.vectors))
    if stats.vectors:
        with pytest.raises(ValueError):
            vectors.read_index(spark, str(tmp_path / "index"), 1024)
