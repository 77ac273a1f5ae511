from pyspark.sql import functions as F

from millrace.operators import audit, evaluate
from millrace.sources import readers


def test_labelled_queries_from_a_file(spark, tmp_path):
    rows = spark.createDataFrame([("mine", 1, "Which unit?", "syllabus"), ("mine", 2, "Fee?", None)], "set string, qid int, query string, label string")
    readers.write_json_array(rows, str(tmp_path / "q"))
    got = evaluate.labelled_queries(spark, str(tmp_path / "q")).orderBy("qid").collect()
    assert [(r.query, r.label, r.expected, r.min_score) for r in got] == [("Which unit?", "syllabus", None, None), ("Fee?", None, None, None)]


def test_many_audit_entries_at_once(spark, tmp_path):
    path = str(tmp_path / "audit")
    audit.record_stages(spark.createDataFrame([(1, "extract", None, 100), (2, "clean", 100, 90), (3, "dedup", 90, 80)], "seq long, stage string, input_count long, output_count long"), path)
    audit.record_stage(spark, path, "index", 5, input_count=0)
    assert [(r.stage, r.delta, r.alarm) for r in audit.history(spark, path).collect()] == [("extract", None, False), ("clean", -10, False), ("dedup", -10, True), ("index", 5, False)]


def test_pages_named_by_their_folder(spark, tmp_path):
    spark.createDataFrame([(1, "one\ftwo"), (2, " \f ")], "g int, value string").write.partitionBy("g").text(str(tmp_path / "f"))
    got = readers.read_pages(spark, str(tmp_path / "f"), lambda data: enumerate(data.decode().split("\f"), 1), "*.txt", name=r"g=(\d+)")
    assert sorted((r.doc, r.page_num, r.text) for r in got.collect()) == [("1", 1, "one"), ("1", 2, "two")]


def test_wrapped_rules_are_the_same_in_spark(spark):
    from millrace import wrapped

    assert spark.range(5).select(F.expr(wrapped._pick("id", ["a", None])).alias("x")).collect()[1].x is None


def test_query_modules_load_in_any_order():
    """A worker may load the module of a hook first."""
    import subprocess
    import sys

    for first in ("queries", "authored", "wrapped"):
        code = f"import millrace.{first}; import millrace.queries as q; assert len(q.QUERIES) > 110 and len(q.SQL) == len(q.QUERIES)"
        subprocess.run([sys.executable, "-c", code], check=True)


def test_files_are_read_in_blocks(spark, tmp_path):
    """Long files go to Python in blocks and come back in batches; one that fails at its end gives no page."""
    folder = tmp_path / "f"
    folder.mkdir()
    pages = [f"p\u00e9 {k} " * (k % 50) for k in range(9_000)]
    (folder / "a.txt").write_bytes("\f".join(pages).encode())
    (folder / "b.txt").write_bytes(("x\f" * 20_000 + "BAD").encode())
    (folder / "c.txt").write_bytes(b"")

    def reader(blocks):
        sizes = 0
        for n, t in readers.text_pages(map(lambda b: b[: readers.BLOCK + 1], blocks)):
            sizes += 1
            if t == "BAD":
                raise ValueError(f"after {sizes}")
            yield n, t

    got = readers.read_pages(spark, str(folder), reader, "*.txt", blocks=True)
    whole = readers.read_pages(spark, str(folder), readers.text_pages, "*.txt").filter("doc <> 'b.txt'").collect()
    rows = got.collect()
    assert [tuple(r) for r in rows if r.error] == [("b.txt", None, None, "ValueError: after 20001")]
    want = [("a.txt", n, t.strip(), None) for n, t in enumerate(pages, 1) if t.strip()]
    assert sorted(tuple(r) for r in rows if not r.error) == sorted(map(tuple, whole)) == want


def test_text_pages_of_any_blocks():
    for data in ("\u00e9\f\u20ac \U0001f600\f".encode(), b"\xff\xe2\x82\fx\xe2", b"", b"\f\f"):
        want = list(enumerate(data.decode("utf-8", "replace").split("\f"), 1))
        for size in (1, 2, 3, 100):
            assert list(readers.text_pages(data[k : k + size] for k in range(0, len(data), size))) == want
        assert list(readers.text_pages(data)) == want
