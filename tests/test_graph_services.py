import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, titles, vectors
from millrace.sources import readers


def _frame(spark, n, dim, seed=0):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return v, spark.createDataFrame([(i, v[i].tolist()) for i in range(n)], "pos long, embedding array<float>")


@pytest.mark.parametrize("part_rows", [5_000, 400])
def test_graph_finds_what_exact_search_finds(spark, part_rows):
    _, df = _frame(spark, 1500, 16)
    q = df.filter("pos % 30 = 0").select(F.col("pos").alias("query_id"), F.col("embedding").alias("vector"))
    g = graph.build_graph(df, m=12, construction=60, part_rows=part_rows).cache()
    assert g.select("part").distinct().count() == -(-1500 // part_rows)
    assert g.agg(F.max(F.size(F.col("neighbours")[0]))).first()[0] <= 24 and g.filter("top > 0").count() > 0
    found = {(r.query_id, r.pos) for r in graph.search_graph(q, g, 10).collect()}
    exact = {(r.query_id, r.pos) for r in vectors.top_k(q, df, 10).collect()}
    assert len(found) == len(exact) == 500 and len(found & exact) >= 0.95 * len(exact)


def test_graph_of_few_or_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0]), (None, [0.0, 1.0])], "pos long, embedding array<float>")
    g = graph.build_graph(df)
    q = spark.createDataFrame([(9, [1.0, 0.0]), (8, None)], "query_id long, vector array<float>")
    assert [(r.query_id, r.pos, r["rank"]) for r in graph.search_graph(q, g, 5).orderBy("rank").collect()] == [(9, 1, 1), (9, 3, 2)]
    assert graph.build_graph(df.limit(0)).count() == 0 and graph.search_graph(q, graph.build_graph(df.limit(0)), 5).count() == 0


def test_arrays_in_parts(spark, tmp_path):
    df = spark.range(1000).repartition(6).select("id", F.concat(F.lit("é "), F.col("id").cast("string")).alias("t"))
    readers.write_json_array(df, str(tmp_path / "many"))
    files = list((tmp_path / "many").glob("part-*"))
    assert len(files) == 6 and sum(len(json.loads(f.read_text())) for f in files) == 1000
    assert readers.read_json_array(spark, str(tmp_path / "many"), "id long, t string").exceptAll(df).count() == 0
    readers.write_json_array(df, str(tmp_path / "one"), parts=1)
    (one,) = (tmp_path / "one").glob("part-*")
    assert len(json.loads(one.read_text())) == 1000
    readers.write_json_array(df.limit(0), str(tmp_path / "none"))
    assert readers.read_json_array(spark, str(tmp_path / "none"), "id long").count() == 0


def test_no_task_of_a_lost_writer_is_seen(spark, tmp_path):
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        readers.write_json_array(bad, str(tmp_path / "a"))
    assert not list((tmp_path / "a").glob("part-*"))


@pytest.fixture
def service():
    """A title service that fails every third request, with what it was asked and what it answered."""
    lock, state = threading.Lock(), {"n": 0, "open": 0, "most": 0, "answered": Counter()}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            prompt = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["prompt"]
            with lock:
                state["n"] += 1
                state["open"] += 1
                state["most"] = max(state["most"], state["open"])
                fails = state["n"] % 3 == 0
                if not fails:
                    state["answered"][prompt] += 1
            body = json.dumps({"response": "A title for " + prompt.split("Text:\n")[1].split("\n")[0]}).encode()
            with lock:
                state["open"] -= 1
            self.send_response(500 if fails else 200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", state
    server.shutdown()


def test_services_are_asked_once(spark, tmp_path, service):
    url, state = service
    rows = spark.createDataFrame([(i, "fees", f"text {i}") for i in range(40)], "id long, category string, content string").repartition(3)
    make = lambda: titles.http_generator(url, "m", strict=True)
    ask = lambda df: titles.answered(df, "id", "category", "content", make, str(tmp_path / "answers"), in_flight=2, backoff=0.01, waves=3)
    got = {r.id: r.answer for r in ask(rows.filter("id < 25")).collect()}
    assert got == {i: f"A title for text {i}" for i in range(25)} and state["n"] > 25
    assert {r.id for r in ask(rows).collect()} == set(range(40))
    assert len(state["answered"]) == 40 and set(state["answered"].values()) == {1}
    asked = state["n"]
    assert ask(rows).count() == 40 and state["n"] == asked
    assert state["most"] <= 2 * 4  # two in flight a task, four tasks at most


def test_a_service_that_is_gone_gives_the_fallback(spark):
    rows = spark.createDataFrame([("fees", "text", "Own title")], "category string, content string, section_title string")
    got = titles.with_titles(rows, lambda: titles.http_generator("http://127.0.0.1:9/", "m", timeout=1)).first()
    assert (got.llm_title, got.title_source, got.title_reason) == ("Own title", "rule_based_fallback", "empty_response")
