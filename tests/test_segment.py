import random

from pyspark.sql import functions as F

from millrace.operators import segment as S


def slow_boundaries(smooth, n, threshold, least):
    out = []
    for i, s in enumerate(smooth, 1):
        if s < threshold and i - (out[-1] if out else 0) >= least and n - i >= least:
            out.append(i)
    return out


def slow_spans(ends, n, least, most):
    edges, out = [0, *ends, n], []
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a < least:
            continue
        at, windows = a, []
        while at < b:
            left = b - at - most
            if 0 < left < least and windows:
                windows.append((at, b - at))
                break
            windows.append((at, min(most, b - at)))
            at += most
        out += windows
    return out


def test_boundary_and_span_folds(spark):
    rng = random.Random(2)
    cases = [([rng.random() for _ in range(rng.randint(0, 60))],) for _ in range(60)]
    df = spark.createDataFrame([(i, c[0], len(c[0]) + 1) for i, c in enumerate(cases)], "i int, s array<double>, n int")
    smooth = S.smoothed(F.col("s"))
    ends = S.boundaries(smooth, F.col("n"), 0.45)
    for r in df.select("i", "s", "n", smooth.alias("m"), ends.alias("e"), S.chunk_spans(ends, F.col("n")).alias("p")).collect():
        want = [sum(r.s[max(0, i - 2) : i + 3]) / len(r.s[max(0, i - 2) : i + 3]) for i in range(len(r.s))]
        assert all(abs(a - b) < 1e-12 for a, b in zip(r.m, want, strict=True))
        assert r.e == slow_boundaries(want, r.n, 0.45, 5)
        assert [tuple(x) for x in r.p] == slow_spans(r.e, r.n, 5, 20)


def test_cap_rule(spark):
    df = spark.createDataFrame([(n,) for n in (4, 20, 21, 24, 25, 41, 44, 45, 60)], "n int")
    got = {r.n: [tuple(x) for x in r.p] for r in df.select("n", S.chunk_spans(F.array().cast("array<int>"), F.col("n")).alias("p")).collect()}
    assert got == {n: slow_spans([], n, 5, 20) for n in got}


def test_regulation_sections(spark):
    long = "Every student of the programme follows these rules in the first year of study."
    text = f"preamble\nELIGIBILITY FOR ADMISSION\n{long}\nAB\nXYZ\n12 - 13\nAWARD OF GRADES\n{long} More.\nAWARD OF GRADES\n{long} More.\nAWARD OF GRADES\n{long} Other.\nCODE OF CONDUCT\nshort"
    docs = spark.createDataFrame([(1, text), (2, f"no header\n{long}"), (3, "tiny"), (4, None)], "doc_id int, text string")
    got = [tuple(r) for r in S.sections(docs).orderBy("doc", "section_no").collect()]
    assert got == [
        (1, 1, "ELIGIBILITY FOR ADMISSION", long),
        (1, 2, "AWARD OF GRADES", f"{long} More."),
        (1, 4, "AWARD OF GRADES", f"{long} Other."),
        (2, 0, "GENERAL REGULATIONS", f"no header {long}"),
    ]


def test_rule_sections_and_gate(spark):
    body = "word " * 120
    docs = spark.createDataFrame([(1, f"Fees:\n{body}\nHostel Rules\n{body}\nLibrary\n{body}"), (2, f"Fees:\n{body}")], "doc_id int, text string")
    got = S.rule_sections(docs)
    assert [(r.doc, r.section_title) for r in got.orderBy("doc", "section_no").collect()] == [(1, "Fees"), (1, "Hostel Rules"), (1, "Library"), (2, "Fees")]
    assert {r.doc: r.good for r in S.section_gate(got).collect()} == {1: True, 2: False}
    other = docs.select(F.col("doc_id").alias("doc"), F.lit(0).cast("long").alias("section_no"), F.lit("t").alias("section_title"), F.lit("c").alias("content"))
    assert [(r.doc, r.section_title) for r in S.hybrid_sections(got, other).orderBy("doc", "section_no").collect()] == [(1, "Fees"), (1, "Hostel Rules"), (1, "Library"), (2, "t")]


def test_bisect(spark):
    sentence = "This is one sentence with quite a number of words inside of it, number {}. "
    df = spark.createDataFrame([(1, "".join(sentence.format(i) for i in range(24))), (2, "".join(sentence.format(i) for i in range(6)))], "doc int, content string")
    got = S.bisect(df, F.lit(True)).orderBy("doc", "path").collect()
    assert [(r.doc, list(r.path), r.bisected) for r in got] == [(1, [0, 0], 2), (1, [0, 1], 2), (1, [1, 0], 2), (1, [1, 1], 2), (2, [0, 0], 0)]
    assert got[0].content.startswith("This is one sentence") and got[3].content.endswith("number 23.")


def test_oversize(apply, spark):
    text = " ".join(f"Sentence number {i} has some words." for i in range(80))
    parts = apply(S.split_oversize, text, "short", "w " * 1000, "")
    assert " ".join(parts[0]) == text and max(map(len, parts[0])) <= 800
    assert parts[1] == ["short"] and all(len(p) <= 800 for p in parts[2]) and parts[3] == [""]
    rows = S.oversize_rows(spark.createDataFrame([("T", text), ("U", "x")], "section_title string, content string")).collect()
    assert rows[0].section_title == f"T (part 1/{rows[0].chunk_total})" and rows[-1].section_title == "U"


def test_document_text(spark):
    pages = spark.createDataFrame([("d", 2, " b "), ("d", 1, "a"), ("d", 3, " ")], "doc string, page_num int, text string")
    r = S.document_text(pages).first()
    assert (r.text, r.first_page, r.last_page) == ("a\n\nb", 1, 2)
    assert S.document_text(pages, marked=True).first().text == "--- PAGE 1 ---\na\n\n--- PAGE 2 ---\nb"


def test_texts_go_through_python_in_slices(spark):
    """More texts than a slice of a batch, nulls among them, come back in order."""
    n = 3 * S.SLICE_TEXTS + 7
    texts = [None if i % 50 == 0 else f"{i} " + "A sentence of some length. " * (60 if i % 3 else 2) for i in range(n)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = {r.i: r.p for r in df.select("i", S.split_oversize(F.col("t")).alias("p")).collect()}
    assert got == {i: S._oversize_parts(t, 800, 1200, 20) for i, t in enumerate(texts)}
