"""Further registered queries: round trips through files, titles, sections and reports over the driver's tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import lexicons as lex
from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import audit, dedup, evaluate, segment, titles, vectors
from millrace.operators.staging import shared_path
from millrace.queries import SQL, _LINES, _Q, _SENTENCES, _STRIP, _collapse, _read, _words, query
from millrace.sources import readers

_TYPES = {"long": "BIGINT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}


def _literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(_literal, v)) + "]"
    return str(v)


def _values(rows: Iterable[tuple], schema: str) -> str:
    """SQL that returns the rows; types are those of the Spark schema."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    kinds = [f"{_TYPES[k[6:-1]]}[]" if k.startswith("array<") else _TYPES[k] for k in kinds]
    one = lambda r: "SELECT " + ", ".join(f"CAST({_literal(v)} AS {k}) AS {n}" for v, k, n in zip(r, kinds, names, strict=True))
    return " UNION ALL ".join(map(one, rows))


# --- sources and sinks ---


@query("SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS absent FROM customer")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers written as one JSON array and read again, with a field that the array lacks."""
    path = shared_path(spark, "json")
    readers.write_json_array(_read(spark, sf_dir, "customer"), path)
    return readers.read_json_array(spark, path, "c_custkey long, c_name string, c_acctbal double, absent string")


def _index(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "index")
    vectors.write_index(_read(spark, sf_dir, "embeddings"), ["label", "vec_id"], path, model="given")
    return path


@query("SELECT row_number() OVER (ORDER BY label, vec_id) - 1 AS pos, vec_id, label FROM embeddings")
def index_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of all vectors in order of label and id, read again with a check of its dimension."""
    return vectors.read_index(spark, _index(spark, sf_dir), 64).select("pos", "vec_id", "label")


@query("SELECT count(*) AS vectors, CAST(max(len(embedding)) AS INT) AS embedding_dim, 'given' AS embed_model, count(*) AS recorded, false AS differs FROM embeddings")
def index_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index's build statistics, and its number of rows against that of the last audit entry."""
    path = _index(spark, sf_dir)
    stats = vectors.build_stats(spark, path)
    log = shared_path(spark, "audit")
    audit.record_stage(spark, log, "index", stats.first()["vectors"])
    checked = audit.count_mismatch(vectors.read_index(spark, path), spark.read.schema(audit.AUDIT).parquet(log), "index", ["seq"])
    return stats.join(checked.select("recorded", "differs"))  # one row each


@query("WITH i AS (SELECT row_number() OVER (ORDER BY label, vec_id) - 1 AS pos, vec_id FROM embeddings) SELECT i.pos, vec_id FROM i JOIN (SELECT DISTINCT CAST(p_partkey * 7 - 50 AS BIGINT) AS pos FROM part) p ON p.pos = i.pos")
def rows_at_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows by position; negative positions and those behind the end give none."""
    asked = _read(spark, sf_dir, "part").select((F.col("p_partkey") * 7 - 50).alias("pos"))
    return vectors.rows_at(vectors.read_index(spark, _index(spark, sf_dir)), asked).select("pos", "vec_id")


@query("SELECT 'documents' AS found, count(*) AS texts, CAST(NULL AS VARCHAR) AS warning FROM documents")
def calibration_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several paths that exists, and the texts to calibrate on: no pages, so the records."""
    path = readers.first_existing(spark, [f"{sf_dir}/raw.parquet", f"{sf_dir}/documents.parquet", f"{sf_dir}/pages.parquet"])
    records = spark.read.parquet(path).select(F.col("text").alias("content"))
    texts, warning = readers.sample_texts(spark, records.limit(0).select(F.col("content").alias("text")), records)
    name = path.rsplit("/", 1)[-1].removesuffix(".parquet")
    return texts.agg(F.lit(name).alias("found"), F.count(F.lit(1)).alias("texts"), F.lit(warning).cast("string").alias("warning"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(64 AS INT) AS dimension, count(*) AS unit FROM documents")
def embedded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of all texts by the default embedder, in batches: their dimension and how many have unit length (or are empty)."""
    got = vectors.embed(_read(spark, sf_dir, "documents").select("text"), "text", lambda: vectors.hashing_embedder(64))
    norm = vectors.dot(F.col("embedding"), F.col("embedding"))
    return got.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dimension"), F.count_if((F.abs(norm - 1) < 1e-4) | (norm == 0)).alias("unit"))


# --- text ---


@query(
    "SELECT doc_id, regexp_replace(regexp_replace(replace(replace(text, '[at]', '@'), '[dot]', '.'), '[ \\x09-\\x0d]+', '', 'g'), '[,.]+$', '') AS email, "
    "CASE WHEN p = '413' THEN '0413-413' ELSE p END AS phone FROM (SELECT doc_id, text, regexp_replace(regexp_replace(text, '^[ \\x09-\\x0d]+|[ \\x09-\\x0d]+$', '', 'g'), '[^\\d+\\-() ]', '', 'g') AS p FROM documents)"
)
def email_and_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail and telephone normalisation of every text."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.clean_email(F.col("text")).alias("email"), T.normalize_phone(F.col("text")).alias("phone"))


def _split_glued(x: str) -> str:
    whole = "|".join(lex.WHOLE_WORDS)
    for w in ("THE", "OF", "FOR", "AND"):
        x = rf"replace(regexp_replace(regexp_replace({x}, '\b({whole})\b', '_Q_\1', 'g'), '\b{w}([A-Z])', '{w} \1', 'g'), '_Q_', '')"
    return x


def _section_title_sql(title: str) -> str:
    lead = r"'^\s*(\d+[.)]?\s+|\d+[.)]|[IVXivx]+[.)]\s*)'"
    t = rf"CASE WHEN regexp_matches({title}, {lead}) THEN regexp_replace({title}, {lead}, '') ELSE regexp_replace({title}, '^\s*[IVX]+\s+([A-Z])', '\1') END"
    t = rf"regexp_replace(regexp_replace({t}, '([a-z])([A-Z])', '\1 \2', 'g'), '([A-Z]{{2,}})([A-Z][a-z])', '\1 \2', 'g')"
    canonical = " ".join(f"WHEN contains(upper(b), '{v}') THEN '{f}'" for v, f in lex.CANONICAL_TITLES.items())
    return (
        rf"(SELECT CASE WHEN length(u) <= 5 THEN '' ELSE u END FROM (SELECT regexp_replace(regexp_replace(regexp_replace(upper(CASE {canonical} ELSE b END), '\s+', ' ', 'g'), '[^\w\s]$', ''), '^\s+|\s+$', '', 'g') AS u FROM "
        rf"(SELECT regexp_replace(CASE WHEN contains(g, '(') AND NOT contains(g, ')') THEN regexp_replace(g, '(?s)\s*\(.*', '') ELSE g END, '[()]', '', 'g') AS b FROM (SELECT {_split_glued('s')} AS g FROM (SELECT {t} AS s)))))"
    )


_GENERIC = "|".join(lex.GENERIC_TITLE_PATTERNS)
_CLEANED = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '^\s+|\s+$', '', 'g'), '^[" + "\"''" + r"]+|[" + "\"''" + r"]+$', '', 'g'), '(?i)^title\s*:?\s*', ''), '\s+', ' ', 'g'))"


@query(f"SELECT page_id, t AS title, {_words('t')} BETWEEN 2 AND 12 AND NOT regexp_matches(lower(t), '{_GENERIC}') AS valid FROM (SELECT page_id, {_CLEANED} AS t FROM pages)")
def title_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated titles cleaned and tested; addresses of pages stand for them."""
    t = T.clean_title_candidate(F.col("url"))
    return _read(spark, sf_dir, "pages").select("page_id", t.alias("title"), C.is_valid_title(t).alias("valid"))


def _first_words(category: str, text: str) -> str:
    """A stand-in for a title service: as many of the first words as the text has characters, modulo 15."""
    return "Title: " + " ".join(x for x in text.replace("\n", " ").replace("\t", " ").split(" ") if x)[: len(text) % 90]


_ASKED = r"substr(text, 1, 1200)"
_ANSWER = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace('Title: ' || substr(array_to_string(list_filter(string_split_regex({_ASKED}, '[ \n\t]'), lambda w: w <> ''), ' '), 1, length({_ASKED}) % 90), '^\s+|\s+$', '', 'g'), '^[{chr(34)}'']+|[{chr(34)}'']+$', '', 'g'), '(?i)^title\s*:?\s*', ''), '\s+', ' ', 'g'))"


@query(
    f"WITH a AS (SELECT doc_id, source, {_ANSWER} AS t FROM documents), v AS (SELECT *, {_words('t')} AS n, {_words('t')} BETWEEN 2 AND 12 AND NOT regexp_matches(lower(t), '{_GENERIC}') AS ok FROM a) "
    "SELECT doc_id, CASE WHEN ok THEN t ELSE source END AS llm_title, CASE WHEN ok THEN 'llm' ELSE 'rule_based_fallback' END AS title_source, CASE WHEN ok THEN NULL WHEN t = '' THEN 'empty_response' WHEN n < 2 THEN 'too_short_' || n WHEN n > 12 THEN 'too_long_' || n ELSE 'generic' END AS title_reason FROM v"
)
def generated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title of each document by the generator hook, tried twice, with the source as fallback; no row is lost."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source")
    got = titles.with_titles(docs, lambda: _first_words, "lang", "text", "source")
    return got.select("doc_id", "llm_title", "title_source", "title_reason")


def _rewriter(category: str, text: str) -> str:
    return "Plainly: " + text if len(text) % 3 else "no"


@query("SELECT doc_id, CASE WHEN text <> '' AND length(substr(text, 1, 1500)) % 3 > 0 AND length('Plainly: ' || regexp_replace(substr(text, 1, 1500), '\\s+$', '')) >= 50 THEN 'Plainly: ' || substr(text, 1, 1500) ELSE text END AS content FROM documents")
def rewritten_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts rewritten by the hook, which sees their first 1500 characters; answers under 50 characters keep the text."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return titles.rewrite(docs, lambda: _rewriter, "content").select("doc_id", "content")


@query(
    "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN t BETWEEN 0 AND 10 THEN t WHEN a + b + c BETWEEN 0 AND 10 THEN a + b + c ELSE 0 END AS INT) AS credits FROM "
    "(SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) - 5 AS t, l_linenumber AS a, CASE WHEN l_linenumber > 3 THEN l_linenumber END AS bb, coalesce(CASE WHEN l_linenumber > 3 THEN l_linenumber END, 0) AS b, CAST(l_quantity AS INT) % 4 AS c FROM lineitem)"
)
def sane_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits made sane: the total if it can be true, else the parts' sum, else 0; numbers of order lines stand for them."""
    d, q = _read(spark, sf_dir, "lineitem"), F.col("l_quantity").cast("int")
    some = F.when(F.col("l_linenumber") > 3, F.col("l_linenumber"))
    return d.select("l_orderkey", "l_linenumber", C.sanitize_credits(q - 5, F.col("l_linenumber"), some, q % 4).alias("credits"))


# --- sections ---


def _in(x: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def _header_sql(line: str) -> str:
    """SQL of the header test on a line."""
    refused = " OR ".join([r"regexp_matches(x, '^[()\d\s\-=.:/|]+$')", r"regexp_matches(x, '(?i)^(.*\d.*HOURS.*|\d.*MARKS.*|\d.*CREDITS.*|\d.*POINTS.*)$')", *(f"regexp_matches(u, '{p}')" for p in lex.NO_HEADER_PATTERNS)])
    plain = r"NOT regexp_matches(u, '\d+\.\d+') AND NOT regexp_matches(lower(x), '\([a-z]\)') AND length(u) - length(replace(u, '.', '')) <= 1"
    strong = " OR ".join(f"(contains(u, '{w}') AND (starts_with(u, '{w.split()[0]}') OR (length(u) <= {len(w) + 15} AND {plain})))" for w in lex.STRONG_HEADER_WORDS)
    weak = f"{_in('u', lex.WEAK_HEADER_WORDS)} AND {_words('x')} >= 3 AND NOT regexp_matches(x, '^\\w+\\s+\\w+\\s+\\w+')"
    cased = r"((upper(x) = x AND lower(x) <> x) OR (regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '(^|[^A-Za-z])[a-z]') AND NOT regexp_matches(x, '[A-Za-z][A-Z]')))"
    return rf"(SELECT length(x) >= 10 AND {cased} AND (({strong}) OR ({weak})) AND len(regexp_extract_all(x, '\b[A-Za-z]+\b')) >= 2 AND NOT ({refused}) FROM (SELECT x, upper(x) AS u FROM (SELECT {_STRIP.format(line)} AS x)))"


_BODY = "Every candidate of the programme follows these rules in the first year, without exception."
_RULES = [
    ("r1", "\n".join(["Some words before the first header are dropped.", "ELIGIBILITY FOR ADMISSION", _BODY, "12", "ab", "SHORT CAPS", "1.1 Eligibility of Others", _BODY, "AWARD OFGRADES", _BODY + " Graded.", "ELIGIBILITY FOR ADMISSION", _BODY, "AWARD OFGRADES", _BODY + " Other content.", "GRADING SYSTEM", "too short"])),
    ("r2", "Examination Rules And Marks\nOF\n30 MARKS FOR ATTENDANCE\nATTENDANCE REQUIREMENTS\n" + _BODY + "\nPage 3 of 9\nTable 2 shows more of the same rule for all."),
    ("r3", "No header in this text, but it is long enough to be one section of its own, surely."),
    ("r4", "tiny"),
    ("r5", "TABLE OF ASSESSMENT\nREFERENCES\n2.1 ASSESSMENT\nCOURSE\nWITHDRAWAL FROM EXAMINATION\n" + _BODY),
]
_RULE_LINES = f"SELECT doc, generate_subscripts(ls, 1) - 1 AS k, unnest(ls) AS line FROM (SELECT doc, string_split(text, chr(10)) AS ls FROM ({_values(_RULES, 'doc string, text string')}))"


@query(f"SELECT doc, CAST(k AS INT) AS line_no, line, {_header_sql('line')} AS is_header FROM ({_RULE_LINES}) UNION ALL SELECT 'documents', CAST(line_no AS INT), CAST(count(*) AS VARCHAR), bool_or(h) FROM (SELECT line_no, {_header_sql('line')} AS h FROM ({_LINES})) GROUP BY line_no")
def section_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header test on lines of authored regulations, and on all lines of documents by line number."""
    rules = segment.lines(spark.createDataFrame(_RULES, "doc string, text string"), "doc").select("doc", "line_no", "line", C.is_header(F.col("line")).alias("is_header"))
    found = segment.lines(_read(spark, sf_dir, "documents")).select("line_no", C.is_header(F.col("line")).alias("h"))
    return rules.unionByName(found.groupBy("line_no").agg(F.count(F.lit(1)).cast("string").alias("line"), F.bool_or("h").alias("is_header")).withColumn("doc", F.lit("documents")))


def _clean_sql(x: str) -> str:
    from millrace.queries import _drop, _typo

    cut = _drop(x, r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+", r"(?i)Page\s+\d+", r"(?i)Table\s+\d+", r"(?i)Figure\s+\d+")
    return _typo(_collapse(f"array_to_string(list_filter(list_transform(string_split({cut}, chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '' AND (regexp_matches(x, '[A-Za-z]') OR {_words('x')} > 2)), chr(10))"))


def sections_sql(docs: str, doc: str) -> str:
    """SQL of the sections of `docs` ({doc}, text)."""
    return rf"""
WITH l AS (SELECT {doc}, generate_subscripts(ls, 1) - 1 AS k, unnest(ls) AS line FROM (SELECT {doc}, string_split(text, chr(10)) AS ls FROM ({docs}))),
h AS (SELECT *, {_STRIP.format('line')} AS x, {_header_sql('line')} AS is_head FROM l WHERE line <> ''),
n AS (SELECT *, sum(CAST(is_head AS INT)) OVER (PARTITION BY {doc} ORDER BY k ROWS UNBOUNDED PRECEDING) AS section_no FROM h),
s AS (SELECT {doc}, section_no, max(x) FILTER (is_head) AS head, string_agg(x, chr(10) ORDER BY k) FILTER (NOT is_head AND length(x) >= 3 AND NOT (upper(x) = x AND lower(x) <> x AND {_words('x')} <= 3) AND NOT regexp_matches(x, '^[()\d\s\-=.:/|]+$')) AS body FROM n WHERE section_no > 0 GROUP BY 1, 2),
m AS (SELECT {doc}, section_no, {_section_title_sql('head')} AS section_title, {_clean_sql("coalesce(body, '')")} AS content FROM s),
d AS (SELECT *, row_number() OVER (PARTITION BY {doc}, section_title, substr(lower({_collapse('content')}), 1, 200) ORDER BY section_no) AS nth FROM m WHERE length(content) >= 50 AND section_title <> '')
SELECT {doc}, CAST(section_no AS BIGINT) AS section_no, section_title, content FROM d WHERE nth = 1
UNION ALL
SELECT {doc}, 0, 'GENERAL REGULATIONS', content FROM (SELECT {doc}, {_clean_sql('text')} AS content FROM ({docs}) WHERE {doc} NOT IN (SELECT {doc} FROM h WHERE is_head)) WHERE length(content) > 50
"""


# the SQL of regulation_sections is the same, over all documents
SQL["regulation_sections"] = sections_sql("SELECT doc_id, text FROM documents", "doc_id")

_RULE_TITLE = (
    r"(SELECT ((ends_with(x, ':') AND length(x) < 80) OR (regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '(^|[^A-Za-z])[a-z]') AND NOT regexp_matches(x, '[A-Za-z][A-Z]') AND length(x) < 60) OR "
    + " OR ".join(f"starts_with(upper(x), '{w}')" for w in lex.RULE_TITLE_WORDS)
    + ") AND NOT ("
    + " OR ".join(f"regexp_matches(x, '(?i){p}')" for p in lex.RULE_IGNORE_PATTERNS)
    + f") FROM (SELECT {_STRIP.format('line')} AS x))"
)
_RULE_SECTIONS = rf"""
l AS ({_LINES}), h AS (SELECT *, {_RULE_TITLE} AS is_head FROM l),
n AS (SELECT *, sum(CAST(is_head AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section_no FROM h),
s AS (SELECT doc_id, section_no, regexp_replace(max({_STRIP.format('line')}) FILTER (is_head), ':$', '') AS section_title, {_collapse("coalesce(string_agg(line, ' ' ORDER BY line_no) FILTER (NOT is_head), '')")} AS content FROM n WHERE section_no > 0 GROUP BY 1, 2),
r AS (SELECT * FROM s WHERE {_words('content')} >= 10),
g AS (SELECT doc_id, count(*) AS n, avg({_words('content')}) AS mean_words, count(DISTINCT section_title) AS titles FROM r GROUP BY 1)"""


def _by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.rule_sections(_read(spark, sf_dir, "documents"), min_words=10)


@query(f"WITH {_RULE_SECTIONS} SELECT doc_id AS doc, CAST(section_no AS BIGINT) AS section_no, section_title, content FROM r")
def rule_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of every text under lines that look like titles."""
    return _by_rules(spark, sf_dir)


@query(f"WITH {_RULE_SECTIONS} SELECT doc_id AS doc, n, round(mean_words, 6) AS mean_words, n >= 2 AND mean_words >= 20 AND titles = n AS good FROM g")
def section_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document's sections are good enough."""
    return segment.section_gate(_by_rules(spark, sf_dir), 2, 20).withColumn("mean_words", F.round("mean_words", 6))


@query(f"WITH {_RULE_SECTIONS}, k AS (SELECT doc_id FROM g WHERE n >= 2 AND mean_words >= 20 AND titles = n) SELECT doc_id AS doc, section_title, content FROM r WHERE doc_id IN (FROM k) UNION ALL SELECT doc_id, source, text FROM documents WHERE doc_id NOT IN (FROM k)")
def hybrid_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule sections of documents that pass the gate, whole texts of the others."""
    whole = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("source").alias("section_title"), F.col("text").alias("content"))
    return segment.hybrid_sections(_by_rules(spark, sf_dir), whole, least=2, mean_words=20)


@query(f"WITH {_RULE_SECTIONS}, p AS (SELECT d.doc_id, coalesce(g.n, 0) AS n FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id) SELECT round(avg(n), 6) AS mean_sections, round(100 * count(*) FILTER (n <= 1) / count(*), 2) AS coarse_pct, round(100 * count(*) FILTER (n <= 1) / count(*), 2) > 30 AS warning FROM p")
def granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections a document, and how many documents have one at most."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"))
    return evaluate.granularity(_by_rules(spark, sf_dir), docs).withColumn("mean_sections", F.round("mean_sections", 6))


_HALVES = f"""
s AS (SELECT doc_id, text, {_SENTENCES} AS ss FROM documents),
h AS (SELECT *, array_to_string(ss[1:len(ss) // 2], ' ') AS a, array_to_string(ss[len(ss) // 2 + 1:], ' ') AS b FROM s),
c AS (SELECT *, len(ss) >= 10 AND {_words('a')} >= 75 AND {_words('b')} >= 75 AS cut FROM h)"""


@query(f"WITH {_HALVES} SELECT doc_id, '0' AS path, CASE WHEN cut THEN a ELSE text END AS content, CAST(cut AS INT) AS bisected FROM c UNION ALL SELECT doc_id, '1', b, 1 FROM c WHERE cut")
def bisected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut in the middle of its sentences, if both halves are long enough."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    got = segment.bisect(docs, F.lit(True), 1)
    return got.select("doc_id", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"), "content", "bisected")


# --- courses ---


# --- faculty ---


# --- curated and extracted records ---


# --- validity ---


@query("SELECT vec_id, CAST(vec_id AS VARCHAR) AS id_text, '[' || label || ',' || label + 1 || ']' AS list_text, '{\"k\":' || label || '}' AS struct_text, '' AS null_text FROM embeddings")
def stringified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of any type as text: containers as JSON, null as empty."""
    df = _read(spark, sf_dir, "embeddings").select("vec_id", F.array("label", F.col("label") + 1).alias("l"), F.struct(F.col("label").alias("k")).alias("s"), F.lit(None).cast("int").alias("n"))
    return df.select("vec_id", *[C.stringify(df, c).alias(a) for c, a in (("vec_id", "id_text"), ("l", "list_text"), ("s", "struct_text"), ("n", "null_text"))])


# --- deduplication ---


@query(f"SELECT page_id FROM (SELECT page_id, row_number() OVER (PARTITION BY lower({_STRIP.format('substr(html, 1, 30)')}), lower({_STRIP.format('url')}) ORDER BY page_id) AS n FROM pages) WHERE n = 1")
def title_program_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each title and program, trimmed and in lower case; beginnings and addresses stand for them."""
    p = _read(spark, sf_dir, "pages").select("page_id", F.substring("html", 1, 30).alias("section_title"), F.col("url").alias("program"))
    return dedup.keep_first(p, dedup.title_program_key(), ["page_id"]).select("page_id")


@query("SELECT count(*) AS total_input, count(DISTINCT md5(text)) AS total_output, count(*) - count(DISTINCT md5(text)) AS total_removed, round(100 * (count(*) - count(DISTINCT md5(text))) / count(*), 2) AS duplicate_rate_pct, round(100 * (count(*) - count(DISTINCT md5(text))) / count(*), 2) < 15 AS target_met FROM documents")
def removal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What exact deduplication of all texts removes, against the target."""
    docs = _read(spark, sf_dir, "documents")
    return dedup.removal_report(docs, dedup.keep_first(docs, dedup.content_md5(F.col("text")), ["doc_id"]))


@query("SELECT row_number() OVER (ORDER BY coalesce(lang, ''), lower(coalesce(source, '')), doc_id) - 1 AS pos, doc_id FROM documents")
def final_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in the final order: category, title in lower case, then id."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return dedup.in_final_order(docs, "lang", "source", then=("doc_id",), place="pos").select("pos", "doc_id")


# --- calibration and reports ---

_SCORES = "SELECT (embedding[1] + 1) / 2 AS s FROM embeddings"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").select(((F.col("embedding")[0] + 1) / 2).cast("double").alias("s"))


def _quartile(k: int) -> str:
    # place k (n + 1) / 4 of the sorted values, between the two values there
    low = f"least(greatest({k} * (n + 1) // 4, 1), n - 1)"
    return f"round(v[{low}] + ({k} * (n + 1) / 4 - {low}) * (v[{low} + 1] - v[{low}]), 6) AS q{k}"


@query(
    f"WITH x AS (SELECT CAST(s AS DOUBLE) AS s FROM ({_SCORES})), l AS (SELECT list(s ORDER BY s) AS v, count(*) AS n FROM x), g AS (SELECT round(avg(s), 6) AS mean, count(*) FILTER (s >= 0.8) AS high, count(*) FILTER (s >= 0.7 AND s < 0.8) AS medium, count(*) AS n, round(100 * count(*) FILTER (s >= 0.7) / count(*), 2) AS high_pct, round(100 * count(*) FILTER (s < 0.5) / count(*), 2) AS rejected_pct FROM x) "
    f"SELECT g.*, CASE WHEN rejected_pct < 5 THEN 'gate rejects little' WHEN rejected_pct > 40 THEN 'gate rejects much' END AS warning, q.* FROM g, (SELECT {', '.join(map(_quartile, (1, 2, 3)))} FROM l) AS q"
)
def purity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purity summary, gate calibration and quartiles of scores."""
    s = _scores(spark, sf_dir)
    summary = evaluate.purity_summary(s, "s").withColumn("mean", F.round("mean", 6))
    gate, quartiles = evaluate.purity_calibration(s, "s", 0.5).drop("n"), vectors.exclusive_quartiles(s, "s")
    return summary.join(gate).join(quartiles.select(*[F.round(c, 6).alias(c) for c in quartiles.columns]))  # one row each


@query("SELECT round(avg(" + _words("text") + "), 6) AS mean_words, round(100 * count(*) FILTER (" + _words("text") + " BETWEEN 75 AND 500) / count(*), 2) AS optimal_pct, count(*) FILTER (lang = 'de') AS duplicates, count(*) FILTER (n_chars < 100) AS invalid FROM documents")
def cleanup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleanup statistics of all texts, with two conditions in place of duplicates and invalid ones."""
    got = evaluate.cleanup_summary(_read(spark, sf_dir, "documents"), "text", F.col("lang") == "de", F.col("n_chars") < 100)
    return got.withColumn("mean_words", F.round("mean_words", 6))


@query("SELECT min(length(text)) AS min_chars, max(length(text)) AS max_chars, round(avg(length(text)), 6) AS mean_chars, count(*) FILTER (length(text) > 800) AS oversized FROM documents")
def chunk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.chunk_sizes(_read(spark, sf_dir, "documents"), "text").withColumn("mean_chars", F.round("mean_chars", 6))


_ASK = {"common": ["the", "and"], "German": ["und", "keitung"], "none": ["qqqq", "zzzz"], "rare": ["lorem", "und"]}


@query(" UNION ALL ".join(f"SELECT '{q}' AS query, bool_or({' + '.join(f'CAST(contains(lower(text), {_literal(w)}) AS INT)' for w in ws)} >= 2) AS passed FROM documents" for q, ws in _ASK.items()))
def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries and whether some text has two of their expected terms."""
    return evaluate.query_coverage(_read(spark, sf_dir, "documents"), "text", _ASK)


_DOTS = "list_sum(list_transform(list_zip(q.q, e.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"
_HITS = f"q AS ({_Q}), s AS (SELECT query_id, vec_id AS pos, e.label, {_DOTS} AS score FROM q, embeddings e), h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) AS rank FROM s) WHERE rank <= 3)"


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "embeddings")
    got = vectors.top_k(e.filter("vec_id % 50 = 0"), e, 3, query_id="vec_id", query_vector="embedding", pos="vec_id")
    return got.join(e.select(F.col("vec_id").alias("pos"), F.col("label").cast("string").alias("title")), "pos")


@query(
    f"WITH {_HITS}, m AS (SELECT round(100 * count(*) FILTER (rank = 1 AND score >= 0.6) / count(*) FILTER (rank = 1), 2) AS good_pct, round(100 * count(*) FILTER (pos % 10 > 0) / count(*), 2) AS complete_pct FROM h), d AS (SELECT round(100 * sum(c - 1) / sum(c), 2) AS duplicate_pct FROM (SELECT count(*) AS c FROM h GROUP BY query_id, label)) "
    "SELECT good_pct, duplicate_pct, complete_pct, good_pct >= 60 AND duplicate_pct < 15 AND complete_pct >= 95 AS targets_met FROM m, d"
)
def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of good first hits, of repeated titles (labels) and of complete hits, against their targets."""
    return evaluate.retrieval_metrics(_hits(spark, sf_dir), "title", F.col("pos") % 10 > 0)


@query(
    f"WITH {_HITS}, w AS (SELECT vec_id, CAST(label AS VARCHAR) AS word, 0.45 + label / 20 AS least FROM embeddings WHERE vec_id % 50 = 0), r AS (SELECT query_id, max(score) AS top_score, string_agg(CAST(label AS VARCHAR), ' ') AS t FROM h GROUP BY 1) "
    "SELECT vec_id AS query_id, round(top_score, 4) AS top_score, CAST(contains(t, word) AS INT) AS keywords, CASE WHEN top_score >= least AND contains(t, word) THEN 'PASS' WHEN top_score >= least THEN 'PARTIAL' ELSE 'FAIL' END AS status FROM w JOIN r ON r.query_id = w.vec_id"
)
def retrieval_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's status by its best score and the expected keywords (its label) that its hits hold."""
    e = _read(spark, sf_dir, "embeddings").filter("vec_id % 50 = 0")
    asked = e.select(F.col("vec_id").alias("query_id"), F.array(F.col("label").cast("string")).alias("expected"), (F.lit(0.45) + F.col("label") / 20).alias("min_score"))
    return evaluate.retrieval_report(_hits(spark, sf_dir), asked, "title").withColumn("top_score", F.round("top_score", 4))


@query(
    f"WITH q AS ({_Q}), s AS (SELECT query_id, vec_id AS pos, e.label, {_DOTS} AS score FROM q, embeddings e), h AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY score DESC, pos) AS rank FROM s) "
    "SELECT query_id, CAST(label AS INT) AS label, round(max(score), 4) AS best, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY rank) AS places FROM h WHERE rank <= 3 GROUP BY 1, 2"
)
def routing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's best score and hits in each index, taken out of the report's maps."""
    e = _read(spark, sf_dir, "embeddings")
    hits = vectors.top_k(e.filter("vec_id % 50 = 0").select("vec_id", F.col("embedding").alias("q")), e, 3, query_id="vec_id", query_vector="q", pos="vec_id", group="label")
    report = vectors.routing_report(hits, "label")
    each = report.select("query_id", "scores", F.explode("top_hits").alias("label", "hits"))
    return each.select("query_id", "label", F.round(F.try_element_at("scores", "label"), 4).alias("best"), F.array_join(F.transform("hits", lambda h: h["pos"].cast("string")), ",").alias("places"))


# --- audit ---


@query("SELECT count(*) FILTER (event_type = 'purchase') AS passed, count(*) FILTER (event_type = 'click') AS warned, count(*) FILTER (event_type = 'error') AS failed, count(*) AS total, count(*) FILTER (event_type = 'error') = 0 AS ok FROM events")
def check_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of checks that passed, warned and failed; kinds of events stand for their results."""
    status = F.when(F.col("event_type") == "purchase", "pass").when(F.col("event_type") == "click", "warn").when(F.col("event_type") == "error", "fail").otherwise("skip")
    return evaluate.check_summary(_read(spark, sf_dir, "events").select(status.alias("status")))


from millrace import wrapped as _wrapped  # noqa: E402, F401  (registers its queries)
