from pyspark.sql import functions as F

from millrace.config import Thresholds, read_settings, write_settings
from millrace.operators import titles
from millrace.operators import vectors as V
from millrace.plans import admin, institutional, syllabus
from millrace.sources import readers as R
from millrace.streaming import ingest

RULE = "Every candidate of the programme follows these rules in the first year of study, without exception."


def test_admin_plan(spark):
    text = f"B.Tech REGULATIONS OF THE YEAR\nRegulations: 2021\nELIGIBILITY FOR ADMISSION\n{RULE}\nAWARD OF GRADES\n{RULE} Again."
    pages = spark.createDataFrame([("a.pdf", 1, text), ("a.pdf", 2, f"AWARD OF GRADES\n{RULE} Other.")], "doc string, page_num int, text string")
    got = admin.extract(pages).orderBy("section_no").collect()
    assert [(r.section_title, r.section_category, r.program, r.regulation_year, r.page_range) for r in got] == [
        ("ELIGIBILITY FOR ADMISSION", "ELIGIBILITY", "B.Tech", "2021", "1-2"), ("AWARD OF GRADES", "GRADING", "B.Tech", "2021", "1-2"), ("AWARD OF GRADES", "GRADING", "B.Tech", "2021", "1-2"),
    ]
    assert got[0].regulation_name == "B.Tech REGULATIONS OF THE YEAR"
    built = admin.build(pages).orderBy("section_no").collect()
    assert len(built) == 2 and built[0].document.startswith("ELIGIBILITY FOR ADMISSION\n\n") and len(built[0].embedding) == 256


def test_syllabus_plan(spark):
    text = "Course Code Course Name\nCSU101 Data Structures\nSemester : II 3-0-0\nUNIT I\nLists and Arrays\nPeriods : 9\nlinked lists; arrays\n"
    pages = spark.createDataFrame([("ug_btech_cse", 1, text), ("ug_btech_it", 1, text)], "doc string, page_num int, text string")
    rows = syllabus.build(pages).collect()
    assert [(r.course_code, r.page_range, r.ako_title) for r in rows] == [("CSU101", "1", "CSU101 – Data Structures (B.Tech, Sem 2)")]
    assert set(rows[0].quality_flags) == {"NO_OUTCOMES", "NO_OBJECTIVES"} and abs(rows[0].quality_score - 0.7) < 1e-9
    assert "Unit I – Lists and Arrays (9 hrs): Linked lists, Arrays" in rows[0].ako_text


def _institutional_pages(spark):
    fees = " ".join(f"The tuition fee payment of term {i} is due with the scholarship refund and the dues." for i in range(14))
    hostel = " ".join(f"Rooms of hostel block {i} are near the mess, the library and the sports ground." for i in range(14))
    return spark.createDataFrame([("a", 1, fees + " " + hostel), ("b", 1, fees), ("c", 1, "Too short a text to keep."), ("d", 1, " ")], "doc string, page_num int, text string")


def test_institutional_plan(spark):
    pages = _institutional_pages(spark)
    limits = Thresholds(similarity_threshold=0.45, purity_floor=0.1)
    found = institutional.candidates(institutional.semantic_sections(institutional.segment.document_text(pages), limits), limits)
    gated = institutional.gate(found, limits)
    reasons = {r.reason: r.n for r in gated.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert sum(reasons.values()) == found.count() and reasons.get(None, 0) >= 2
    recs = institutional.records(gated)
    assert recs.select("ako_id").distinct().count() == recs.count()
    done = institutional.build(pages, limits).collect()
    assert {"fees"} <= {r.category for r in done} and all(len(r.embedding) == 256 and r.title_source == "rule_based_fallback" for r in done)


def test_titles_never_lose_a_row(spark):
    df = spark.createDataFrame([("c", "first text", "Old Title One"), ("c", None, "Old"), ("c", "echo", "Old Three"), ("c", "long", None)], "category string, content string, section_title string")

    def make():
        return lambda c, t: {"first text": '"Title: A Fine Title"', "echo": "6-12 words", "long": "w " * 20}.get(t, "")

    got = [(r.llm_title, r.title_source, r.title_reason) for r in titles.with_titles(df, make).collect()]
    assert got == [("A Fine Title", "llm", None), ("Old", "rule_based_fallback", "empty_response"), ("Old Three", "rule_based_fallback", "generic"), (None, "rule_based_fallback", "too_long_20")]
    plain = titles.with_titles(df).collect()
    assert [r.llm_title for r in plain] == ["Old Title One", "Old", "Old Three", None]
    new = titles.rewrite(df, lambda: lambda c, t: "x" * 60 if t == "echo" else "short", "content").collect()
    assert [r.content for r in new] == ["first text", None, "x" * 60, "long"]


def test_sources(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"one\fTwo\f \fFour")
    (folder / "b.txt").write_bytes(b"x")

    def reader(data):
        if data == b"x":
            raise ValueError("broken")
        return R.text_pages(data)

    pages, errors = R.pages_and_errors(R.read_pages(spark, str(folder), reader, "*.txt"))
    assert [tuple(r) for r in pages.orderBy("page_num").collect()] == [("a.txt", 1, "one"), ("a.txt", 2, "Two"), ("a.txt", 4, "Four")]
    assert [tuple(r) for r in errors.collect()] == [("b.txt", "ValueError: broken")]
    assert R.read_pages(spark, str(tmp_path / "none"), reader).count() == 0
    out = str(tmp_path / "json")
    df = spark.createDataFrame([("é", None), ("b", 2)], "a string, b int")
    R.write_json_array(df, out)
    assert sorted(map(tuple, R.read_json_array(spark, out, "a string, b int, c string").collect()), key=str) == [("b", 2, None), ("é", None, None)]
    R.write_json(df, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2
    assert R.first_existing(spark, [str(tmp_path / "none"), out]) == out and R.first_existing(spark, []) is None
    texts, warning = R.sample_texts(spark, None, spark.createDataFrame([("t",)], "content string"))
    assert texts.count() == 1 and "1" in warning


def test_settings(spark, tmp_path):
    path = str(tmp_path / "s.yaml")
    write_settings(spark, path, Thresholds(similarity_threshold=0.464, calibrated=True))
    assert read_settings(spark, path, Thresholds) == Thresholds(similarity_threshold=0.464, calibrated=True)


def test_adapt(spark):
    df = spark.createDataFrame([("i", None, "s", "University_Club", "T", "C", None, None, None, None), ("j", "d", "s", "Other", "T", "C", (["e"], ["x"]), "h", "v", "u")], "ako_id string, domain string, source_file string, entity_type string, title string, content string, metadata struct<key_entities:array<string>,target_audience:array<string>>, content_hash string, extraction_version string, last_updated string")
    a, b = R.adapt_records(df).collect()
    assert (a.category, a.audience, a.cleanup_version, a.domain) == ("clubs", ["Students"], "v3.0_intent_aligned", "institutional")
    assert (b.category, b.audience, b.key_entities, b.content_hash) == ("general", ["x"], ["e"], "h")


def test_index_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", [1.0, 2.0]), ("a", [3.0, 4.0])], "title string, embedding array<float>")
    r = V.write_index(df, ["title"], str(tmp_path / "index")).first()
    assert (r.vectors, r.embedding_dim) == (2, 2)
    assert [x.title for x in spark.read.parquet(str(tmp_path / "index")).orderBy("pos").collect()] == ["a", "b"]


def test_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("d", 1, "Page 1 of 2 body  text"), ("d", 2, " ")], "doc string, page_num int, text string").write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(spark, source, sink, str(tmp_path / "check")).awaitTermination()
    assert [(r.doc, r.text, r.n_words) for r in spark.read.parquet(sink).collect()] == [("d", "body text", 2)]


def test_curated_sources(spark):
    a = spark.createDataFrame([(1, "a", "same"), (2, "b", "own")], "ordinal int, title string, content string")
    b = spark.createDataFrame([(1, "c", "same")], "ordinal int, title string, content string")
    assert sorted(r.title for r in institutional.curated(a, b).collect()) == ["a", "b"]


def test_courses_take_their_pages_without_a_join(spark):
    """Texts of pages are neither broadcast nor joined; the pages that hold a code are those that `course_pages` finds."""
    from millrace.operators import courses, segment
    from millrace.plans import syllabus

    head = "Course Code Course Name L T P\n"
    rows = [("ug_mba_it.pdf", 3, head + "CSU101 First Name\nmore"), ("ug_mba_it.pdf", 5, "of CSU101 again\n" + head + "CSU102 Second Name\n"), ("ug_mba_it.pdf", 4, " \n"), ("x.pdf", 1, "nothing")]
    pages = spark.createDataFrame(rows, "doc string, page_num int, text string")
    got = syllabus.extract(pages)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    want = courses.course_pages(courses.extract_courses(segment.document_text(pages)), pages)
    assert sorted(map(tuple, got.select("course_code", "page_range").collect())) == sorted(map(tuple, want.select("course_code", "page_range").collect())) == [("CSU101", "3-5"), ("CSU102", "5")]


def test_admin_sections_are_cut_where_the_document_is(spark):
    """Each page's text is shuffled once: what is told of a document goes along, sections are not met with it by a join or a window."""
    text = f"Regulations: 2021\nELIGIBILITY FOR ADMISSION\n{RULE}\nAWARD OF GRADES\n{RULE} Again.\nAWARD OF GRADES\n{RULE} Again."
    got = admin.extract(spark.createDataFrame([("a", 1, text), ("b", 1, RULE), ("c", 1, " ")], "doc string, page_num int, text string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("Exchange") == 1
    assert sorted((r.doc, r.section_no, r.section_title, r.regulation_year) for r in got.collect()) == [("a", 1, "ELIGIBILITY FOR ADMISSION", "2021"), ("a", 2, "AWARD OF GRADES", "2021"), ("b", 0, "GENERAL REGULATIONS", None)]
