"""Queries over regulations, syllabi, staff lists and records that are made of the driver's tables.

A rule wraps the rows of a table: whole texts go under headers, part names into syllabi, suppliers into staff lists. The
rules are SQL that Spark and DuckDB both read, so each side makes the same thousands of inputs from the same tables; what
is expected of them DuckDB computes from the tables' own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import lexicons as lex
from millrace.authored import _in, _literal, _section_title_sql, sections_sql
from millrace.config import Thresholds, read_settings, write_settings
from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import audit, courses, dedup, evaluate, faculty, segment, vectors
from millrace.operators.staging import shared_path
from millrace.plans import admin, institutional, syllabus
from millrace.queries import SQL, _STRIP, _collapse, _drop, _read, _words, query
from millrace.sources import readers


def _pick(key: str, values: list) -> str:
    """The value at place key modulo their number, in SQL of both."""
    return f"CASE CAST({key} AS BIGINT) % {len(values)} " + " ".join(f"WHEN {i} THEN {_literal(v)}" for i, v in enumerate(values)) + " END"


def _floor(x: str, by: int) -> str:
    return f"CAST(floor({x} / {by}) AS BIGINT)"


def _made(table: str, **columns: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {table}"


def _rows(spark: SparkSession, sf_dir: str, table: str, **columns: str) -> DataFrame:
    return _read(spark, sf_dir, table).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


# --- titles and records ---

_FORMS = [
    "1. ELIGIBILITY FORADMISSION", "2) AWARD OFGRADES", "IV. Duration of theProgramme", "VI EXAMINATION RULES", "3.2 CREDITS", "12 ACADEMIC APPEALS BOARD (AAB", "THESIS SUBMISSION", "RULES FORTHE HOSTEL",
    "THEORY OFMACHINES", "ANDOTHER RULES", "FORMAT OFTHE REPORT", "Minimum Attendance (see page)", "FEES", "x) small letters here", "GRADING SYSTEM.", "SEMESTEREXAMINATION rules", "  ", "CreditTransferPOLICYRules",
]
_TITLED = {"id": "CAST(p_partkey AS INT)", "title": f"{_pick('p_partkey', _FORMS)} || CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN ' ' || upper(p_name) ELSE ' OF' || p_type || ' (' || p_name END"}


@query(f"SELECT id, {_section_title_sql('title')} AS section_title FROM ({_made('part', **_TITLED)})")
def section_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised titles of regulation sections: forms of titles with the names and kinds of all parts."""
    return _rows(spark, sf_dir, "part", **_TITLED).select("id", T.normalize_section_title(F.col("title")).alias("section_title"))


def _complete_sql(title: str, content: str) -> str:
    """SQL of a title that ends in the air and takes words of its content."""
    first = f"CASE WHEN contains({content}, '. ') THEN split_part({content}, '. ', 1) WHEN contains({content}, '? ') THEN split_part({content}, '? ', 1) WHEN contains({content}, '! ') THEN split_part({content}, '! ', 1) WHEN contains({content}, chr(10)) THEN split_part({content}, chr(10), 1) END"
    some = rf"coalesce(nullif({_STRIP.format(f'({first})')}, ''), {_STRIP.format(content)})"
    longer = _STRIP.format(rf"({title} || ' ' || array_to_string(list_slice(list_filter(string_split_regex({some}, '\s+'), lambda w: w <> ''), 1, 5), ' '))")
    ends = " OR ".join(f"ends_with(upper({title}), ' {w}')" for w in ("FOR", "OF", "AND", "THE"))
    return rf"CASE WHEN length({title}) < 25 AND ({ends}) AND NOT regexp_matches({title}, '\d') AND NOT {_in(f'upper({title})', lex.UNFIXABLE_TITLE_WORDS)} AND length({longer}) <= 80 THEN {longer} ELSE {title} END"


_AIR = {"doc_id": "doc_id", "title": _pick("doc_id", ["RULES FOR", "ELIGIBILITY FOR", "CONDUCT OF 2020", "A TITLE THAT IS LONGER THAN OTHERS OF", "TERMS AND", "PLAIN TITLE", "NOTES ON THE", "USE OF"]), "content": "text"}


@query(f"SELECT doc_id, {_complete_sql('title', 'content')} AS title FROM ({_made('documents', **_AIR)})")
def completed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short titles that end in the air take words of their content, every text, but for known ones."""
    return _rows(spark, sf_dir, "documents", **_AIR).select("doc_id", T.complete_title(F.col("title"), F.col("content")).alias("title"))


_CUT = {
    "doc_id": "doc_id", "title": _pick("doc_id", ["ELIGIBILITY FOR", "ELIGIBILITY FOR", "ELIGIBILITY FOR ALL"]), "program": _pick("doc_id", ["MBA", "MCA", "Unknown", None]),
    "file": _pick("doc_id", ["MBA_Regulations.pdf", "mca.pdf", "Regulations", "x.pdf", "mca.pdf"]), "content": "CASE WHEN doc_id % 7 < 4 THEN 'Each candidate: ' ELSE '' END || text",
}


@query(
    "SELECT doc_id, title AS off, CASE WHEN title = 'ELIGIBILITY FOR' AND coalesce(program, '') <> '' AND program <> 'Unknown' AND contains(file, 'Regulations') AND regexp_matches(lower(content), 'admission|programme|candidate|eligibility') THEN 'ELIGIBILITY FOR ADMISSION' ELSE title END AS by_content, "
    f"CASE WHEN title = 'ELIGIBILITY FOR' AND program = 'MCA' AND file = 'mca.pdf' THEN 'ELIGIBILITY FOR ADMISSION' ELSE title END AS by_file FROM ({_made('documents', **_CUT)})"
)
def eligibility_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two repairs of one title, off as a rule, each switched on alone, over all texts."""
    of = lambda **how: T.complete_eligibility(F.col("title"), F.col("program"), F.col("file"), F.col("content"), **how)
    return _rows(spark, sf_dir, "documents", **_CUT).select("doc_id", of().alias("off"), of(by_content=True).alias("by_content"), of(by_file="mca.pdf").alias("by_file"))


_CURATED = {
    "ako_id": "CASE WHEN c_custkey % 7 > 0 THEN 'c' || CAST(c_custkey AS STRING) END", "entity_type": _pick("c_custkey", [*lex.ENTITY_CATEGORIES, "Unheard_Of", None]),
    "title": "CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END", "content": "c_name || ' of ' || c_mktsegment", "content_hash": "CASE c_custkey % 3 WHEN 0 THEN 'h' || CAST(c_custkey AS STRING) WHEN 1 THEN '' END",
}


@query(
    "SELECT coalesce(ako_id, '') AS ako_id, CASE entity_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lex.ENTITY_CATEGORIES.items()) + " ELSE 'general' END AS category, coalesce(title, '') AS section_title, content, coalesce(nullif(content_hash, ''), md5(content)) AS content_hash, 'institutional' AS type, 0.85::DOUBLE AS semantic_purity_score "
    f"FROM ({_made('customer', **_CURATED)})"
)
def adapted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as curated records, with the fields of later stages."""
    more = {c: F.lit(None).cast("string") for c in ("domain", "source_file", "extraction_version", "last_updated")}
    df = _rows(spark, sf_dir, "customer", **_CURATED).withColumns(more | {"metadata": F.lit(None).cast("struct<key_entities:array<string>,target_audience:array<string>>")})
    return readers.adapt_records(df).select("ako_id", "category", "section_title", "content", "content_hash", "type", "semantic_purity_score")


@query(
    "SELECT title, content FROM (SELECT *, row_number() OVER (PARTITION BY md5(content) ORDER BY s, ordinal) AS n FROM (SELECT 0 AS s, item_id AS ordinal, 'item ' || item_id AS title, text AS content FROM benchmark UNION ALL SELECT 1, doc_id, source, text FROM documents)) WHERE n = 1"
)
def curated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages, then documents, as curated sources; equal contents once."""
    a = _rows(spark, sf_dir, "benchmark", ordinal="item_id", title="'item ' || CAST(item_id AS STRING)", content="text")
    return institutional.curated(a, _rows(spark, sf_dir, "documents", ordinal="doc_id", title="source", content="text")).select("title", "content")


_ODD = {
    "ako_id": "CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(doc_id AS STRING) END", "title": "CASE doc_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'ELIGIBILITY RULES' WHEN 2 THEN source END",
    "content": "CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' tiny ' ELSE text END", "regulation": _pick("doc_id", ["reg", None, "", "reg", " \n"]), "category": _pick("doc_id", ["cat", "", "unknown", "cat", None, "cat", "cat"]), "source": _pick("doc_id", ["f.pdf", None, " "]),
}
_BLANK = lambda c: rf"coalesce(regexp_replace({c}, '\s', '', 'g'), '') = ''"
_BRIEF = rf"coalesce(length({_STRIP.format('content')}), 0) < 10"


def _listed(*tests: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {t} THEN '{m}' END" for t, m in tests) + "], lambda x: x IS NOT NULL), ',')"


@query(
    "SELECT doc_id, "
    + _listed((_BLANK("title"), "section_title"), (_BRIEF, "content"), (_BLANK("regulation"), "regulation_name")) + " AS admin, "
    + _listed((_BLANK("ako_id"), "ako_id"), (_BLANK("category"), "category"), (_BLANK("title"), "section_title"), (_BRIEF, "content"), (_BLANK("source"), "source_file")) + " AS institutional, "
    + _listed((_BLANK("regulation"), "course_code"), (_BLANK("title"), "course_name")) + " AS course, "
    + f"NOT ({_BLANK('title')} OR {_BRIEF} OR {_BLANK('regulation')}) AS loadable, {_words('coalesce(content, \'\')')} >= 30 AND NOT {_BLANK('title')} AND NOT {_BLANK('category')} AND category <> 'unknown' AS clean, "
    + f"coalesce(length(content), 0) > 50 OR coalesce({_in('upper(title)', lex.UNFIXABLE_TITLE_WORDS)}, false) AS indexable FROM ({_made('documents', doc_id='doc_id', **_ODD)})"
)
def record_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents with fields taken from them lack by the rules of each kind, and whether they are loadable, clean and worth indexing."""
    df = _rows(spark, sf_dir, "documents", doc_id="doc_id", **_ODD)
    i, t, c, r, k, s = (F.col(x) for x in _ODD)
    listed = lambda x: F.array_join(x, ",")
    return df.select(
        "doc_id", listed(C.admin_errors(t, c, r)).alias("admin"), listed(C.institutional_errors(i, k, t, c, s)).alias("institutional"), listed(C.course_errors(r, t)).alias("course"),
        C.loadable("admin", t, c, r).alias("loadable"), C.cleanup_valid(c, t, k).alias("clean"), C.indexable_admin(t, c).alias("indexable"),
    )


_TWICE = {"o": "o_orderkey", "k": "CASE WHEN o_custkey % 50 > 0 THEN CAST(o_custkey % 500 AS STRING) END", "v": "o_orderstatus"}


@query(f"SELECT o, k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o) AS n FROM ({_made('orders', **_TWICE)} UNION ALL {_made('orders', **_TWICE)})) WHERE n = 1")
def dedup_of_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders twice: of rows that agree in key and order one stays."""
    rows = _rows(spark, sf_dir, "orders", **_TWICE)
    return dedup.keep_first(rows.unionByName(rows), F.col("k"), ["o"])


_MERGED = {"o": "CAST(o_orderkey AS INT)", "b": "CAST(o_custkey % 5 AS INT)", "leader": "CAST(o_orderkey - o_orderkey % 4 AS INT)", "similarity": "CAST(0.5 + (o_orderkey % 400) / 1000 AS DOUBLE)"}


@query(
    f"WITH c AS ({_made('orders', **_MERGED)}), s AS (SELECT b, o, leader, similarity, row_number() OVER (PARTITION BY b ORDER BY o) AS n FROM c WHERE o <> leader), m AS (SELECT b, o, leader, similarity, row_number() OVER (ORDER BY b, o) AS n FROM c WHERE o <> leader) "
    "SELECT 'similarity' AS kind, b, o, leader, round(similarity, 4) AS similarity FROM s WHERE n <= 20 UNION ALL SELECT 'merge', b, o, leader, round(similarity, 4) FROM m WHERE n <= 50 UNION ALL SELECT 'counts', CAST(count(DISTINCT b) AS INT), CAST(count(*) AS INT), CAST(count(*) FILTER (o = leader) AS INT), CAST(count(*) FILTER (o <> leader) AS DOUBLE) FROM c"
)
def cluster_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first similarities of each block, the first merges, and counters, of clusters of four orders."""
    sims, merges, counts = dedup.cluster_report(_rows(spark, sf_dir, "orders", **_MERGED), "b", "o")
    tagged = lambda df, kind: df.select(F.lit(kind).alias("kind"), "b", "o", "leader", "similarity")
    numbers = counts.select(F.lit("counts").alias("kind"), F.col("blocks").cast("int").alias("b"), F.col("input").cast("int").alias("o"), F.col("clusters").cast("int").alias("leader"), F.col("merged").cast("double").alias("similarity"))
    return tagged(sims, "similarity").unionByName(tagged(merges, "merge")).unionByName(numbers)


@query(f"SELECT similarity_threshold AS similarity, semantic_boundary_threshold AS boundary, mixed_topic_threshold AS mixed, CAST({Thresholds().purity_floor} AS DOUBLE) AS floor, true AS calibrated FROM ({SQL['recommend_thresholds']})")
def settings_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds calibrated on all vectors, written as settings and read again, one of them left at its default."""
    path, r = shared_path(spark, "settings"), vectors.recommend(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding").first()
    write_settings(spark, path, Thresholds(r["similarity_threshold"], r["semantic_boundary_threshold"], r["mixed_topic_threshold"], calibrated=True))
    t = read_settings(spark, path, Thresholds)
    row = (t.similarity_threshold, t.semantic_boundary_threshold, t.mixed_topic_threshold, t.purity_floor, t.calibrated)
    return spark.createDataFrame([row], "similarity double, boundary double, mixed double, floor double, calibrated boolean")


# --- labelled queries and audit ---

_ASKED = {
    "set": _pick("conv_id", ["routing", "syllabus", "admin"]), "qid": "CAST(conv_id * 100 + turn AS INT)",
    "query": _pick("conv_id + turn", ["Which module: ", "About GRADING ", "", "Hostel? ", "exam and fee "]) + " || text", "label": _pick("turn + conv_id", ["syllabus", "admin", "unknown", "institutional", "institutional"]),
}
_ROUTED = "CASE " + " ".join("WHEN " + _in("lower(query)", ws) + f" THEN '{r}'" for r, ws in lex.ROUTES.items()) + " ELSE 'unknown' END"


@query(f"SELECT set, count(*) AS n, count(*) FILTER ({_ROUTED} = label) AS correct, round(100 * count(*) FILTER ({_ROUTED} = label) / count(*), 2) AS accuracy_pct FROM ({_made('conversations', **_ASKED)}) GROUP BY set")
def labelled_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of keyword routing on labelled query sets, made of all turns and read from a JSON array."""
    path = shared_path(spark, "queries")
    readers.write_json_array(_rows(spark, sf_dir, "conversations", **_ASKED), path)
    q = evaluate.labelled_queries(spark, path).withColumn("predicted", C.route_query(F.col("query")))
    right = F.col("predicted") == F.col("label")
    return q.groupBy("set").agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("correct"), F.round(100 * F.count_if(right) / F.count(F.lit(1)), 2).alias("accuracy_pct"))


_DAYS = "SELECT event_type AS stage, CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) AS n FROM events GROUP BY 1, 2"


@query(
    f"WITH d AS ({_DAYS}), e AS (SELECT stage, day, n AS output_count, lag(n) OVER (PARTITION BY stage ORDER BY day) AS input_count FROM d) "
    "SELECT stage, day, output_count, input_count, output_count - input_count AS delta, round(100 * (output_count - input_count) / input_count, 1) AS delta_pct, coalesce(output_count < input_count AND (input_count - output_count) / input_count > 0.1, false) AS alarm FROM e"
)
def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each kind and day as entries of a stage, with those of the day before as input, appended to an audit and read back."""
    e = _read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage"), F.col("ts").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("output_count"))
    e = e.withColumn("input_count", F.lag("output_count").over(Window.partitionBy("stage").orderBy("day")))
    path = shared_path(spark, "audit")
    audit.record_stages(e.withColumn("seq", F.xxhash64("stage", "day")).withColumn("extra", F.create_map(F.lit("day"), F.col("day"))), path)
    return audit.history(spark, path).select("stage", F.try_element_at("extra", F.lit("day")).alias("day"), "output_count", "input_count", "delta", "delta_pct", "alarm")


# --- pages and regulations ---

_PAGED = {"doc": "'d' || CAST(page_id % 40 AS STRING)", "page_num": "CAST(page_id AS INT)", "text": "CASE page_id % 7 WHEN 0 THEN ' ' || chr(10) WHEN 1 THEN NULL ELSE ' ' || html || chr(10) END"}
_PARTS = f"WITH p AS (SELECT doc, page_num, {_STRIP.format('text')} AS t FROM ({_made('pages', **_PAGED)})), k AS (SELECT * FROM p WHERE t <> '') "


@query(
    _PARTS + "SELECT doc, string_agg(t, chr(10) || chr(10) ORDER BY page_num) || chr(10) || chr(10) AS plain, string_agg('--- PAGE ' || page_num || ' ---' || chr(10) || t, chr(10) || chr(10) ORDER BY page_num) AS marked, "
    "CASE WHEN min(page_num) = max(page_num) THEN CAST(min(page_num) AS VARCHAR) ELSE min(page_num) || '-' || max(page_num) END AS pages FROM k GROUP BY 1"
)
def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages joined into documents, blank ones left out, each followed by a blank line, and once more with page marks."""
    pages = _rows(spark, sf_dir, "pages", **_PAGED)
    plain = segment.document_text(pages, ended=True).select("doc", F.col("text").alias("plain"), T.page_range(F.col("first_page"), F.col("last_page")).alias("pages"))
    return plain.join(segment.document_text(pages, marked=True).select("doc", F.col("text").alias("marked")), "doc")


_HEADS = ["ELIGIBILITY FOR ADMISSION", "AWARD OFGRADES", "GRADING SYSTEM", "ATTENDANCE REQUIREMENTS", "WITHDRAWAL FROM EXAMINATION", "1.1 Eligibility of Others", "SHORT CAPS", "Examination Rules And Marks"]
_RULED = {
    "doc": f"'r' || CAST(doc_id AS STRING) || {_pick('doc_id', ['_btech.pdf', '.pdf', '_MBA-x.pdf'])}",
    "text": "'Before the first header. ' || chr(10) || "
    + f"CASE WHEN doc_id % 5 = 0 THEN '' ELSE {_pick('doc_id', _HEADS)} || chr(10) END || text || chr(10) || {_pick('doc_id', ['12', 'OF', '30 MARKS FOR ATTENDANCE', 'CAPS'])} || chr(10) || "
    + f"CASE WHEN doc_id % 5 < 2 THEN '' ELSE {_pick(_floor('doc_id', 3), _HEADS)} || chr(10) END || {_pick('doc_id', ['', 'Regulations 2021-22 for B.Tech and M.Tech, B Tech twice.', 'Rules: MCA'])} || chr(10) || text",
}


@query(sections_sql(_made("documents", **_RULED), "doc"))
def admin_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of all texts between header lines put into them; of equal ones in a document the first."""
    return segment.sections(_rows(spark, sf_dir, "documents", **_RULED), doc="doc")


def _program_sql(text: str, file: str) -> str:
    best = lambda x: "(SELECT list_max([" + ", ".join(f"{{'s': len(regexp_extract_all({x}, '(?i){p}')), 'p': {-i}, 'n': '{n}'}}" for i, (n, p) in enumerate(lex.PROGRAM_PATTERNS.items())) + "]))"
    spaced = f"translate({file}, '_-', '  ')"
    return f"CASE WHEN {best(text)}.s > 0 THEN {best(text)}.n WHEN {best(spaced)}.s > 0 THEN {best(spaced)}.n ELSE 'Unknown' END"


_YEAR = "coalesce(" + ", ".join(f"nullif(regexp_extract(text, '(?i){p}', 1), '')" for p in lex.ADMIN_YEAR_PATTERNS) + ")"
_NAME = f"coalesce((SELECT list_filter(list_transform(list_slice(string_split(text, chr(10)), 1, 20), lambda x: {_STRIP.format('x')}), lambda x: length(x) > 10 AND length(x) < 200 AND regexp_matches(upper(x), '{'|'.join(lex.REGULATION_NAME_WORDS)}'))[1]), {_collapse("translate(regexp_replace(doc, '(?i)[.]pdf$', ''), '_-', '  ')")})"
_CATEGORY = lambda t: "CASE " + " ".join(f"WHEN {_in(f'upper({t})', ws)} THEN '{n}'" for n, ws in lex.SECTION_CATEGORIES) + " ELSE 'GENERAL' END"
_META = _RULED | {"title": _pick("doc_id", ["CURRICULUM OF STUDY", "LIBRARY", "Assessment of Work", "AWARD AND STRUCTURE", *_HEADS])}


@query(f"SELECT doc, {_program_sql('text', 'doc')} AS program, {_YEAR} AS regulation_year, {_NAME} AS regulation_name, {_CATEGORY('title')} AS section_category FROM ({_made('documents', **_META)})")
def regulation_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Program by most mentions (else the file's name), year, name, and the category of a section's title, of all texts."""
    df = _rows(spark, sf_dir, "documents", **_META)
    return df.select("doc", C.majority_program(F.col("text"), F.col("doc")).alias("program"), C.regulation_year(F.col("text")).alias("regulation_year"), C.regulation_name(F.col("text"), F.col("doc")).alias("regulation_name"), C.section_category(F.col("title")).alias("section_category"))


_STRIPPED = f"SELECT doc, {_STRIP.format('text')} AS text FROM ({_made('documents', **_RULED)})"


@query(f"""
WITH src AS ({_STRIPPED}), meta AS (SELECT doc, {_program_sql('text', 'doc')} AS program, {_NAME} AS name FROM src), parts AS ({sections_sql('SELECT doc, text FROM src', 'doc')}),
t AS (SELECT parts.doc, section_no, {_complete_sql('section_title', 'content')} AS section_title, content, program, name FROM parts JOIN meta ON meta.doc = parts.doc),
v AS (SELECT *, row_number() OVER (PARTITION BY lower({_STRIP.format('section_title')}), lower({_STRIP.format('program')}) ORDER BY doc, section_no) AS nth FROM t WHERE NOT ({_BLANK('section_title')} OR {_BRIEF} OR {_BLANK('name')}))
SELECT doc, section_title, {_CATEGORY('section_title')} AS section_category FROM v WHERE nth = 1 AND (length(content) > 50 OR {_in('upper(section_title)', lex.UNFIXABLE_TITLE_WORDS)})
""")
def admin_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as regulations, from pages to deduplicated sections worth indexing."""
    pages = _rows(spark, sf_dir, "documents", **_RULED).withColumn("page_num", F.lit(1))
    return admin.documents(admin.deduplicate(admin.extract(pages))).select("doc", "section_title", "section_category")


# --- courses ---

_N = "p_partkey"
_CODE = f"{_pick(_floor(_N, 1000), ['CSU', 'ECU', 'MAC', 'PHU'])} || lpad(CAST({_N} % 1000 AS STRING), 3, '0')"
_UNITS = f"{_N} % 3 > 0"
_NAMED = f"p_name || CASE WHEN {_N} % 4 = 0 THEN ' and' ELSE '' END"
_L, _TU, _PR = f"(1 + {_N} % 4)", f"({_N} % 2)", f"(2 * ({_N} % 3))"
_S = lambda x: f"CAST({x} AS STRING)"
_DOC = f"{_pick(_N, ['ug', 'pg', 'xx'])} || '_' || {_pick(_floor(_N, 3), ['btech', 'mtech', 'mba', 'mca', 'msc', 'none'])} || '_' || {_pick(_floor(_N, 2), ['cse', 'ece', 'it', 'civil', 'zzz'])} || '_' || {_S(_N)} || '.pdf'"
_SYLLABI = {
    "doc": _DOC, "page_num": f"CAST({_N} % 9 + 1 AS INT)",
    "text": " || ".join([
        f"CASE WHEN {_N} % 2 = 0 THEN 'Regulations: 2020-21' || chr(10) ELSE '' END || 'Course Code Course Name L T P' || chr(10)", _CODE, f"' ' || {_NAMED} || chr(10) || 'Semester : '", _pick(_N, courses.ROMAN),
        f"'  ' || {_S(_L)} || ' - ' || {_S(_TU)} || ' - ' || {_S(_PR)} || chr(10)", f"'Lecture Periods: ' || {_S(f'15 * {_L}')} || ' Tutorial Periods: ' || {_S(f'15 * {_TU}')} || ' Total Periods: ' || {_S(f'15 * ({_L} + {_TU} + {_PR})')} || chr(10)",
        "'Course Objectives:' || chr(10) || '1. To study the ' || p_name || chr(10) || '2. To analyse ' || p_brand || ' in depth' || chr(10)", f"'Course Outcomes:' || chr(10) || 'CO1 Explain ' || p_name || ' CO2 Apply ' || p_type || ' CO10 Build ' || {_S('p_size')} || chr(10)",
        f"CASE WHEN {_UNITS} THEN 'UNIT I : ' || p_name || ' and Lists Periods: ' || {_S(f'{_N} % 15 + 1')} || chr(10) || 'Linear structures' || chr(10) || p_name || '; ' || p_type || ' - ' || p_brand || chr(10) || 'CO1' || chr(10) "
        f"|| 'UNIT II' || chr(10) || 'Trees of ' || p_type || chr(10) || 'Periods : ' || {_S('p_size % 20 + 1')} || chr(10) || '1. Binary ' || p_name || ', heaps CO10, CO7' || chr(10) ELSE '' END",
        "'Reference Books' || chr(10) || '1. A. Author, ' || p_name || ' and More, Press' || chr(10) || '2. B. Author, Practice of ' || p_name || chr(10) || 'CO-PO Mapping'",
    ]),
}
_CASED = r"array_to_string(list_transform(string_split({}, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
_FIRST_UP = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"
_PROGRAM = _pick(_floor(_N, 3), ["B.Tech", "M.Tech", "MBA", "MCA", "M.Sc", ""])
_LEVEL = f"CASE {_N} % 3 WHEN 0 THEN 'UG' WHEN 1 THEN 'PG' ELSE {_pick(_floor(_N, 3), ['UG', 'PG', 'PG', 'PG', 'PG', ''])} END"
_DEPT = _pick(_floor(_N, 2), ["CSE", "ECE", "IT", "Civil", "Unknown"])
_TOTAL = f"{_L} + {_TU} + {_PR}"
_SEMESTER = _S(f"{_N} % 5 + 1")
_REPAIRED = f"CASE WHEN {_N} % 4 > 0 THEN p_name WHEN {_UNITS} THEN {_CASED.format("(p_name || ' and Lists')")} ELSE p_name || ' and More' END"


def _courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syllabus.extract(_rows(spark, sf_dir, "part", **_SYLLABI))


@query(_made(
    "part", course_code=_CODE, course_name=_NAMED, program=_PROGRAM, degree_level=_LEVEL, department=_DEPT, regulation_year=f"CASE WHEN {_N} % 2 = 0 THEN '2020-21' END", semester=_SEMESTER,
    credits=f"{_S(_L)} || '-' || {_S(_TU)} || '-' || {_S(_PR)} || '=' || {_S(_TOTAL)}", hours=f"CAST(15 * ({_TOTAL}) AS INT)", page_range=_S(f"{_N} % 9 + 1"),
))
def course_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses of syllabi made of all parts: header fields, file fields, year, semester, credits, hours, pages."""
    c = F.col("credits")
    shown = F.concat(c["lecture"].cast("string"), F.lit("-"), c["tutorial"].cast("string"), F.lit("-"), c["practical"].cast("string"), F.lit("="), c["total"].cast("string"))
    return _courses(spark, sf_dir).select("course_code", "course_name", "program", "degree_level", "department", "regulation_year", "semester", shown.alias("credits"), F.col("contact_hours.total").alias("hours"), "page_range")


_TOPICS = f"{_FIRST_UP.format('p_name')} || '|' || {_FIRST_UP.format('p_type')} || '|' || {_FIRST_UP.format('p_brand')}"


@query(
    f"SELECT {_CODE} AS course_code, 'I' AS unit_number, p_name || ' and Lists' AS unit_title, CAST({_N} % 15 + 1 AS INT) AS hours, {_TOPICS} AS topics, 'CO1' AS mapped FROM part WHERE {_UNITS} "
    f"UNION ALL SELECT {_CODE}, 'II', 'Trees of ' || p_type, CAST(p_size % 20 + 1 AS INT), 'Binary ' || lower(p_name) || '|Heaps co10', 'CO10' FROM part WHERE {_UNITS}"
)
def course_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of the syllabi: number, title, hours, topics, and the declared outcomes that they mention."""
    got = _courses(spark, sf_dir).select("course_code", F.explode("units").alias("u"))
    return got.select("course_code", "u.unit_number", "u.unit_title", "u.hours", F.array_join("u.topics", "|").alias("topics"), F.array_join("u.mapped_course_outcomes", "|").alias("mapped"))


@query(_made(
    "part", course_code=_CODE, objectives="'To study the ' || p_name || '|To analyse ' || p_brand || ' in depth'", outcomes=f"'CO1=Explain ' || p_name || '|CO2=Apply ' || p_type || '|CO10=Build ' || {_S('p_size')}",
    refs="'A. Author, ' || p_name || ' and More, Press|B. Author, Practice of ' || p_name",
))
def course_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objectives, outcomes and references of the syllabi."""
    outcomes = F.transform("course_outcomes", lambda o: F.concat(o["co_id"], F.lit("="), o["description"]))
    return _courses(spark, sf_dir).select("course_code", F.array_join("course_objectives", "|").alias("objectives"), F.array_join(outcomes, "|").alias("outcomes"), F.array_join("textbook_references", "|").alias("refs"))


_UNIT_TEXT = (
    f"'Unit I – ' || p_name || ' and Lists (' || ({_N} % 15 + 1) || ' hrs): Linear structures ' || p_name || '; ' || p_type || ' - ' || p_brand || chr(10) || 'Unit II – Trees of ' || p_type || ' (' || (p_size % 20 + 1) || ' hrs): Binary ' || lower(p_name) || ', Heaps co10'"
)
_MADE_TITLE = f"{_CODE} || ' – ' || n || ' (' || {_PROGRAM} || ', Sem ' || {_SEMESTER} || ')'"


@query(
    f"SELECT {_CODE} AS course_code, {_MADE_TITLE} AS ako_title, CASE WHEN {_UNITS} THEN '' ELSE 'NO_UNITS' END AS flags, CASE WHEN {_UNITS} THEN 1.0 ELSE 0.85 END::DOUBLE AS score, CAST({_TOTAL} AS INT) AS total_credits, "
    f"'Course: ' || n || chr(10) || 'Course Code: ' || {_CODE} || chr(10) || 'Program: ' || {_PROGRAM} || ' (' || {_LEVEL} || ') | Department: ' || {_DEPT} || chr(10) || 'Semester: ' || {_SEMESTER} || ' | Total Credits: ' || ({_TOTAL}) || chr(10) "
    f"|| 'Course Outcomes: CO1: Explain ' || p_name || ' | CO2: Apply ' || p_type || ' | CO3: Build ' || p_size || chr(10) || CASE WHEN {_UNITS} THEN {_UNIT_TEXT} ELSE 'Note: Detailed unit content not available for this course.' END AS ako_text FROM (SELECT *, {_REPAIRED} AS n FROM part)"
)
def finished_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The courses with repaired names, titles, texts, flags and credits."""
    got = syllabus.finish(_courses(spark, sf_dir))
    return got.select("course_code", "ako_title", F.array_join("quality_flags", ",").alias("flags"), F.round("quality_score", 6).alias("score"), "total_credits", "ako_text")


@query(f"""
WITH c AS (SELECT *, {_CODE} AS code, {_DOC} || '#00000000' AS ordinal, {_REPAIRED} AS n, {_PROGRAM} AS program, {_DEPT} AS department, {_SEMESTER} AS semester FROM part),
one AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY upper(code) ORDER BY ordinal) = 1),
two AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY lower(n), lower(program), lower(department), semester ORDER BY ordinal) = 1)
SELECT code AS course_code FROM two WHERE {_UNITS}
""")
def indexed_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The courses that the index takes, deduplicated, when those without units are left out."""
    return syllabus.build(_rows(spark, sf_dir, "part", **_SYLLABI), skip_without_units=True).select("course_code")


_DANGLING = {"id": "CAST(p_partkey AS INT)", "name": f"p_name || {_pick(_N, [' and', ' of', '', ' for'])}", "unit": f"CASE WHEN {_N} % 3 = 0 THEN upper(p_name || ' and lists') END", "ref": f"CASE WHEN {_N} % 5 < 3 THEN 'A. Author, ' || p_name || ' of ' || p_type || ', Press' END"}
_RENAMED = (
    f"CASE WHEN {_N} % 4 = 2 THEN name WHEN starts_with(lower(p_name || ' and lists'), substr(lower(name), 1, 15)) AND {_N} % 3 = 0 THEN {_CASED.format("(p_name || ' and lists')")} "
    f"WHEN {_N} % 5 < 3 AND {_N} % 4 = 1 AND length(name) < 30 THEN p_name || ' of ' || p_type ELSE name || ' [NEEDS REVIEW]' END"
)


@query(f"SELECT id, n AS name, 'C' || id || ' – ' || replace(n, ' [NEEDS REVIEW]', '') || ' (MBA, Sem 2)' AS title FROM (SELECT id, {_RENAMED} AS n FROM (SELECT *, {', '.join(f'{e} AS {k}' for k, e in _DANGLING.items())} FROM part))")
def course_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all parts that end in the air, repaired from unit titles or references, and rendered as titles."""
    df = _rows(spark, sf_dir, "part", **_DANGLING)
    named = df.withColumn("name", courses.repair_name(F.col("name"), F.array("unit"), F.array("ref")))
    return named.select("id", "name", courses.render_title(F.concat(F.lit("C"), F.col("id").cast("string")), F.col("name"), F.lit("MBA"), F.lit("2")).alias("title"))


_T30 = " ".join(f"t{i}" for i in range(30))
_COURSE_ROWS = {
    "o": "p_partkey", "course_code": f"CASE {_N} % 3 WHEN 0 THEN ' b' || {_S(f'{_N} % 700')} WHEN 1 THEN 'B' || {_S(f'{_N} % 700')} END", "course_name": f"p_name || CASE WHEN {_N} % 2 = 0 THEN '!' ELSE ' ' END", "program": "p_brand", "department": f"CASE WHEN {_N} % 7 = 0 THEN lower(p_type) ELSE p_type END",
    "semester": _S(f"{_N} % 3"), "ako_title": f"CASE WHEN {_N} % 4 = 0 THEN '{_T30} ' || {_S(_N)} ELSE 'alone ' || {_S(_N)} END",
}


@query(f"""
WITH c AS ({_made("part", **_COURSE_ROWS)}),
one AS (SELECT * FROM c QUALIFY coalesce(trim(course_code), '') = '' OR row_number() OVER (PARTITION BY upper(trim(course_code)) ORDER BY o) = 1),
two AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY trim(replace(course_name, '!', ' ')), lower(program), lower(department), semester ORDER BY o) = 1),
three AS (SELECT *, starts_with(ako_title, 't0') AS alike FROM two)
SELECT o, CASE WHEN alike AND row_number() OVER (PARTITION BY program, lower(department), alike ORDER BY o) > 1 THEN 'near_duplicate' ELSE 'clean' END AS dedup_status FROM three
""")
def course_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three passes over courses made of all parts; titles of a program and department share 30 of 32 words or none."""
    return dedup.dedup_courses(_rows(spark, sf_dir, "part", **_COURSE_ROWS), "o", remove=False).select("o", "dedup_status")


# --- faculty ---

_AREA = "s_suppkey % 5"
_LINES_OF = " || chr(10) || ".join(["'Dr. ' || s_name", "'M.Tech., Ph.D'", "'Specialization : Nets, ' || CAST(s_suppkey AS STRING) || '/Systems; Logic'", f"CASE WHEN {_AREA} = 0 THEN 'Phone : 0' ELSE 'Phone : 0413-' || CAST(s_suppkey AS STRING) END", "'Email : s' || CAST(s_suppkey AS STRING) || ' [at] site.edu,'"])
_PEOPLE = "SELECT s_suppkey, s_name, n_name, row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) - 1 AS k FROM supplier JOIN nation ON n_nationkey = s_nationkey"
_HEAD_MAIL, _SPECIAL = "'head' || s_suppkey || '@site.edu'", "'Nets, ' || s_suppkey || '/Systems; Logic'"
_DEPARTMENT = _CASED.format("lower(n_name)")
_RANK = "CASE WHEN k < 2 THEN 'Professor' ELSE 'Associate Professor' END"
_PHONE = f"CASE WHEN {_AREA} = 0 THEN '0' ELSE '0413-' || s_suppkey END"


def _staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staff list of each nation's suppliers: the first is the head, the first two are professors."""
    s = _read(spark, sf_dir, "supplier").join(_read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    s = s.withColumn("k", F.row_number().over(Window.partitionBy("n_name").orderBy("s_suppkey")) - 1)
    lines = F.concat(F.when(F.col("k") == 2, "ASSOCIATE PROFESSOR\n").otherwise(""), F.expr(_LINES_OF))
    got = s.groupBy("n_name").agg(F.array_sort(F.collect_list(F.struct("k", lines.alias("t"), "s_name", "s_suppkey"))).alias("p"))
    head = F.col("p")[0]
    text = F.concat(F.lit("DEPARTMENT OF "), F.col("n_name"), F.lit("\nHead of the Department\nDr. "), head["s_name"], F.lit("\n0413-2345\nhead"), head["s_suppkey"].cast("string"), F.lit("[at]site[dot]edu\nPROFESSOR\n"), F.array_join(F.transform("p", lambda x: x["t"]), "\n"))
    return got.select(F.col("n_name").alias("doc"), text.alias("text"))


_PERSONS = (
    f"SELECT n_name AS doc, CAST(6 + 5 * k + CASE WHEN k >= 2 THEN 1 ELSE 0 END AS INT) AS line_no, 'Dr. ' || s_name AS name, {_RANK} AS designation, {_DEPARTMENT} AS department, 'M.Tech., Ph.D' AS qualifications, {_SPECIAL} AS specialization, {_PHONE} AS phone, 's' || s_suppkey || '@site.edu' AS email, "
    f"k = 0 AS is_hod, CASE WHEN k = 0 THEN '0413-2345' END AS hod_phone, CASE WHEN k = 0 THEN {_HEAD_MAIL} END AS hod_email FROM ({_PEOPLE})"
)


@query(_PERSONS)
def faculty_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of staff lists made of all suppliers with what is carried forward to them, and the heads found among them."""
    return faculty.faculty_profiles(_staff(spark, sf_dir))


@query(
    f"SELECT name, 'Profile of ' || name || CASE WHEN is_hod THEN ', HOD of ' ELSE ', ' END || department AS title, name || '|' || department || CASE WHEN is_hod THEN '|HOD' ELSE '' END || '|' || replace(replace(replace(specialization, '/', '|'), ', ', '|'), '; Logic', '') AS entities, "
    "'**Name**: ' || name || chr(10) || '**Designation**: ' || CASE WHEN is_hod THEN 'Professor & Head of the Department (' || department || ')' ELSE designation END || chr(10) || '**Qualifications**: ' || qualifications || chr(10) || '**Specialization**: ' || specialization || chr(10) || '**Contact**:' || chr(10) "
    "|| CASE WHEN coalesce(hod_phone, phone) IN ('0', '413') THEN '' ELSE '- Phone: ' || coalesce(hod_phone, phone) || chr(10) END || '- Email: ' || coalesce(hod_email, email) || chr(10) || '**Department**: ' || department AS content "
    f"FROM ({_PERSONS})"
)
def faculty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered profile a name and department, with title and entities, of all suppliers."""
    entities = faculty.profile_entities(F.col("name"), F.col("department"), F.col("specialization"), is_hod=F.col("is_hod"))
    got = faculty.unique_profiles(faculty.faculty_profiles(_staff(spark, sf_dir)))
    return got.select("name", faculty.profile_title().alias("title"), F.array_join(entities, "|").alias("entities"), faculty.render_profile().alias("content"))


@query(f"SELECT department, CAST(count(*) AS INT) AS n_members, max(name) FILTER (is_hod) AS head, string_agg(name, '|' ORDER BY line_no) AS members FROM ({_PERSONS}) GROUP BY 1")
def faculty_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of each department, each once, and its head, of all suppliers."""
    got = faculty.rosters(faculty.faculty_profiles(_staff(spark, sf_dir)))
    return got.select("department", "n_members", "head", F.array_join(F.transform("members", lambda m: m["name"]), "|").alias("members"))


# --- files of pages ---

_FILED = {"grp": "page_id % 20", "n": "page_id", "t": "CASE page_id % 9 WHEN 0 THEN ' ' || chr(10) ELSE coalesce(translate(html, chr(12), ' '), '') END"}


def _paged(blocks: Iterator[bytes]) -> Iterator[tuple[int, str]]:
    for n, text in readers.text_pages(blocks):
        if "BROKEN FILE" in text:
            raise ValueError("a file that can't be read")
        yield n, text


@query(
    f"WITH f AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY n) AS k, {_STRIP.format('t')} AS t FROM ({_made('pages', **_FILED)})) "
    "SELECT CAST(grp AS VARCHAR) AS doc, CAST(k AS INT) AS page_num, t AS text, false AS failed FROM f WHERE t <> '' AND grp <> 7 UNION ALL SELECT '7', NULL, NULL, true FROM f WHERE grp = 7 GROUP BY grp"
)
def scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to files, a form feed between two, and read again: blank ones dropped, a file that fails gives its error and no page."""
    folder = shared_path(spark, "files")
    p = _rows(spark, sf_dir, "pages", **_FILED).groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("p"))
    text = F.concat(F.when(F.col("grp") == 7, "BROKEN FILE").otherwise(""), F.array_join(F.transform("p", lambda x: x["t"]), "\f"))
    p.select("grp", text.alias("value")).write.partitionBy("grp").text(folder)
    got = readers.read_pages(spark, folder, _paged, "*.txt", name=r"grp=(\d+)", blocks=True).unionByName(readers.read_pages(spark, folder + "/none", _paged, blocks=True))
    return got.select("doc", "page_num", "text", F.col("error").isNotNull().alias("failed"))


# --- gates and soft deduplication ---

_GATED = {"doc": "'g' || CAST(doc_id % 50 AS STRING)", "section_no": "CAST(doc_id AS INT)", "section_title": "source", "content": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE text END", "category": _pick("doc_id", ["fees", "campus", "", "campus"])}
_ALIKE = r"list_filter(list_transform(string_split(regexp_replace(" + _collapse("content") + r", '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 20)"


def _by_parity():
    return lambda batch: np.array([[1.0, 0.0] if len(t) % 2 else [0.0, 1.0] for t in batch], np.float32)


@query(f"""
WITH c AS ({_made("documents", **_GATED)}), s AS (SELECT *, {_ALIKE} AS ss FROM c),
p AS (SELECT *, len(ss) AS n, len(list_filter(ss, lambda x: length(x) % 2 = 1)) AS a FROM s),
q AS (SELECT *, CASE WHEN coalesce({_words("content")}, 0) < 75 THEN 'too_short' WHEN category = '' THEN 'unclear_category' END AS early, CASE WHEN n < 2 THEN 1.0 ELSE round((a * (a - 1) + (n - a) * (n - a - 1)) / (n * (n - 1)), 3) END AS purity FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY doc, early IS NULL, substr(content, 1, 200) ORDER BY section_no) AS nth FROM q)
SELECT doc, section_no, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN 'duplicate' WHEN purity < 0.45 THEN 'low_purity' END AS reason FROM f
""")
def candidate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why texts are refused as candidates: too short, no category, the same beginning in a document, sentences of two kinds (by an embedder with two directions)."""
    df = _rows(spark, sf_dir, "documents", **_GATED).withColumn("path", F.array(F.lit(0)))
    return institutional.gate(df, Thresholds(purity_floor=0.45), embedder=_by_parity).select("doc", "section_no", "reason")


_SOFT = {"id": "CAST(doc_id AS STRING)", "category": "lang", "title": _pick("doc_id", ["Overview", "A good long title", "Another good title", "Overview", "Overview"]), "content": "text", "cleanup_version": _pick("doc_id", ["rule", "ollama_llm_v2", None])}
_WORTH = f"CASE WHEN title = 'Overview' THEN 1 ELSE 0 END, {_words('content')} DESC, CASE cleanup_version WHEN 'ollama_llm_v2' THEN 3 WHEN 'rule' THEN 1 ELSE 0 END DESC, id"


@query(f"""
WITH r AS (SELECT *, CAST(id AS BIGINT) % 64 AS k FROM ({_made("documents", **_SOFT)})),
a AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY md5({_STRIP.format("coalesce(content, '')")}) ORDER BY {_WORTH}) = 1),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY category, k ORDER BY {_WORTH}) = 1)
SELECT category, id, title FROM b WHERE title <> 'Overview'
UNION ALL SELECT category, id, title FROM (SELECT * FROM b WHERE title = 'Overview' QUALIFY row_number() OVER (PARTITION BY k ORDER BY {_WORTH}) = 1)
""")
def soft_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, then semantic deduplication of all texts, generic titles across categories last; in the final order. Each vector is one of 64 directions."""
    direction = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i == F.col("id").cast("long") % 64).cast("float"))
    df = _rows(spark, sf_dir, "documents", **_SOFT).withColumn("v", direction)
    return dedup.in_final_order(dedup.soft_dedup(df, "id", "v")).select("category", "id", "title")


# --- sections by meaning ---

_SAID = _collapse(_drop("text", r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+"))
_SAID = rf"list_filter(list_transform(string_split(regexp_replace({_SAID}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 20)"
_REDUCED = _collapse(_drop("content", "-{3,}", "_{3,}", r"(?i)\bas mentioned (above|earlier|previously)\b", r"(?i)\bas per above\b", r"(?i)\brefer to (table|figure|section)\s+\d+\b"))


@query(f"""
WITH RECURSIVE x AS (SELECT doc_id AS doc, {_SAID} AS ss FROM documents),
e AS (SELECT doc, unnest(ss) AS t, generate_subscripts(ss, 1) AS i FROM x),
a AS (SELECT doc, i, CASE WHEN nxt % 2 = own % 2 THEN 1.0 ELSE 0.0 END AS sim FROM (SELECT doc, i, length(t) AS own, lead(length(t)) OVER (PARTITION BY doc ORDER BY i) AS nxt FROM e) WHERE nxt IS NOT NULL),
s AS (SELECT doc, i, avg(CAST(sim AS DOUBLE)) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS x FROM a),
f AS (
  SELECT doc, len(ss) AS n, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS last FROM x WHERE len(ss) > 0
  UNION ALL
  SELECT f.doc, f.n, s.i, CASE WHEN s.x < 0.45 AND s.i - f.last >= 5 AND f.n - s.i >= 5 THEN s.i ELSE f.last END FROM f JOIN s ON s.doc = f.doc AND s.i = f.i + 1
),
d AS (SELECT *, lead(start, 1, n) OVER (PARTITION BY doc ORDER BY start) - start AS size FROM (SELECT DISTINCT doc, n, last AS start FROM f)),
w AS (SELECT *, CAST(ceil(size / 20) AS BIGINT) AS windows FROM d WHERE size >= 5),
v AS (SELECT *, windows - CASE WHEN windows > 2 AND size - (windows - 1) * 20 < 5 THEN 1 ELSE 0 END AS parts FROM w),
u AS (SELECT *, unnest(range(parts)) AS k FROM v),
c AS (SELECT u.doc, row_number() OVER (PARTITION BY u.doc ORDER BY start, k) - 1 AS section_no, array_to_string(ss[start + 20 * k + 1:start + 20 * k + CASE WHEN k = parts - 1 THEN size - 20 * k ELSE 20 END], ' ') AS content FROM u JOIN x ON x.doc = u.doc)
SELECT doc, CAST(section_no AS INT) AS section_no, {_REDUCED} AS content FROM c
""")
def semantic_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of all texts between the places where the meaning changes, by an embedder with two directions."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    got = institutional.semantic_sections(docs, Thresholds(similarity_threshold=0.45), embedder=_by_parity)
    return got.select("doc", "section_no", "content")
