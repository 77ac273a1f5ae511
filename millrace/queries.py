"""Registered queries of the curation and retrieval operators over the driver's tables, with DuckDB SQL.

`documents` plays records and pages, `embeddings` an index, `conversations` of users queries, `benchmark` marker
phrases, `events` a stage log. All run over whole tables and whole texts. The lexicon of the test language takes the
place of the English one, which the invented prose doesn't contain; the shipped lexicon is used too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import lexicons as lex
from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import audit, dedup, evaluate, graph, segment, vectors

#: Words that the test prose contains, in categories.
TEST_LEXICON = {"alpha": ["the", "and", "of"], "beta": ["der", "die", "und", "das"], "gamma": ["que", "de", "la"], "delta": ["le", "les", "est"], "omega": ["was", "for", "in"]}
TEST_ROUTES = {"first": ["tion", "ing"], "second": ["keit", "ung"], "third": ["ment", "eau"]}
TEST_TITLES = [("Common Words", ["the", "and", "of"]), ("German Words", ["der", "die", "und"]), ("Romance Words", ["de", "la", "que"]), ("Zero Hits", ["qqqq"])]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- SQL fragments ---

_COLLAPSE = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


def _collapse(x: str) -> str:
    return _COLLAPSE.format(x)


def _words(x: str) -> str:
    return rf"len(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> ''))"


def _typo(x: str) -> str:
    for old, new in lex.TYPOGRAPHY:
        x = f"replace({x}, '{old}', '{new.replace(chr(39), chr(39) * 2)}')"
    return x


def _drop(x: str, *patterns: str) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def _hits(x: str, words: list[str], distinct: bool = False) -> str:
    # tokens between characters that are no word characters; the keywords are single words
    one = [rf"len(list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}_]+'), lambda y: y = '{w}'))" for w in words]
    return "(" + " + ".join(f"CAST({o} > 0 AS INT)" if distinct else o for o in one) + ")"


def _subs(x: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({x}), '{w}') AS INT)" for w in words) + ")"


_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(" + _collapse("text") + r", '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 20)"

# --- text ---


@query(
    "SELECT doc_id, "
    + _typo(_collapse("array_to_string(list_filter(list_transform(string_split(" + _drop("text", r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+", r"(?i)Page\s+\d+", r"(?i)Table\s+\d+", r"(?i)Figure\s+\d+") + r", chr(10)), lambda x: " + _STRIP.format("x") + r"), lambda x: x <> '' AND (regexp_matches(x, '[A-Za-z]') OR " + _words("x") + " > 2)), chr(10))"))
    + " AS content FROM documents"
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regulation cleaning of every text."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.clean_regulation(F.col("text")).alias("content"))


@query("SELECT doc_id, " + _typo(_collapse(_drop("text", r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+", r"(?i)The and.*?\n"))) + " AS content FROM documents")
def clean_institutional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institutional cleaning with a running header."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.clean_institutional(F.col("text"), "The and").alias("content"))


@query(
    "SELECT doc_id, "
    + _collapse(_drop("text", "-{3,}", "_{3,}", r"(?i)\bas mentioned (above|earlier|previously)\b", r"(?i)\bas per above\b", r"(?i)\brefer to (table|figure|section)\s+\d+\b"))
    + " AS reduced, "
    + _STRIP.format(_drop("text", r"(?i)\bPage \d+ of \d+\b", r"\b\d+/\d+\b", "-{3,}", "_{3,}"))
    + " AS denoised FROM documents"
)
def noise_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section noise reduction and cleanup noise removal."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.reduce_noise(F.col("text")).alias("reduced"), T.remove_noise(F.col("text")).alias("denoised"))


@query(
    r"WITH n AS (SELECT doc_id, source, "
    + _STRIP.format(_drop("text", r"(?i)\bPage \d+ of \d+\b", r"\b\d+/\d+\b", "-{3,}", "_{3,}"))
    + r" AS t FROM documents), r AS (SELECT doc_id, "
    + _collapse(_drop(r"regexp_replace(regexp_replace(regexp_replace(t, '(?i)\bthis section\b', 'the ' || source || ' section', 'g'), '(?i)\bthis program\b', 'the program', 'g'), '(?i)\bthis course\b', 'the course', 'g')", r"(?i)\bas mentioned (above|earlier|previously)\b", r"(?i)\bas per above\b", r"(?i)\brefer to (table|figure|section) \d+\b"))
    + " AS t FROM n) SELECT doc_id, "
    + _STRIP.format(r"regexp_replace(t, '(?m)^[•●○►▪▫-]\s+', '• ', 'g')")
    + " AS content FROM r"
)
def clean_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record cleanup with the source as title."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.clean_record(F.col("text"), F.col("source")).alias("content"))


@query(
    f"WITH s AS (SELECT doc_id, {_SENTENCES} AS ss FROM documents) "
    "SELECT doc_id, CAST(len(ss) AS INT) AS n_sentences, CAST(coalesce(list_sum(list_transform(ss, lambda x: length(x))), 0) AS BIGINT) AS sentence_chars FROM s"
)
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of every text, counted."""
    s = _read(spark, sf_dir, "documents").select("doc_id", T.sentences(F.col("text")).alias("ss"))
    return s.select("doc_id", F.size("ss").alias("n_sentences"), F.aggregate("ss", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("sentence_chars"))


@query("SELECT count(*) FILTER (w < 50) AS short, count(*) FILTER (w BETWEEN 50 AND 1000) AS optimal, count(*) FILTER (w > 1000) AS long, count(*) AS n, round(100 * count(*) FILTER (w BETWEEN 50 AND 1000) / count(*), 2) AS optimal_pct, round(100 * count(*) FILTER (w BETWEEN 50 AND 1000) / count(*), 2) >= 70 AS good FROM (SELECT " + _words("text") + " AS w FROM documents)")
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.length_buckets(_read(spark, sf_dir, "documents"), "text")


_CATS = list(TEST_LEXICON)


@query(
    "WITH h AS (SELECT doc_id, text, " + ", ".join(f"{_hits('text', ws)} AS {c}" for c, ws in TEST_LEXICON.items()) + " FROM documents) SELECT doc_id, CASE WHEN length(text) < 20 OR greatest(" + ", ".join(_CATS) + ") = 0 THEN '' "
    + " ".join(f"WHEN {c} = greatest({', '.join(_CATS)}) THEN '{c}'" for c in _CATS)
    + " END AS category FROM h"
)
def keyword_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category by whole-word occurrences, ties by priority."""
    return _read(spark, sf_dir, "documents").select("doc_id", C.infer_category(F.col("text"), TEST_LEXICON, tuple(TEST_LEXICON)).alias("category"))


@query(
    "WITH h AS (SELECT doc_id, " + ", ".join(f"{_subs('text', ws)} AS s_{c}" for c, ws in lex.CATEGORY_KEYWORDS.items()) + ", text FROM documents) SELECT doc_id, CASE WHEN greatest(" + ", ".join(f"s_{c}" for c in lex.CATEGORY_KEYWORDS) + ") = 0 THEN 'general' "
    + " ".join(f"WHEN s_{c} = greatest({', '.join(f's_{x}' for x in lex.CATEGORY_KEYWORDS)}) THEN '{c}'" for c in lex.CATEGORY_KEYWORDS)
    + " END AS dominant FROM h"
)
def dominant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category by distinct keywords of the shipped lexicon as substrings."""
    return _read(spark, sf_dir, "documents").select("doc_id", C.dominant_category(F.col("text")).alias("dominant"))


@query(
    "WITH h AS (SELECT doc_id, lang, " + ", ".join(f"{_hits('text', ws, True)} AS {c}" for c, ws in TEST_LEXICON.items()) + ", " + ", ".join("(" + " + ".join(f"(length(text) - length(replace(lower(text), '{w}', ''))) // {len(w)}" for w in ws) + f") AS n_{c}" for c, ws in TEST_LEXICON.items()) + " FROM documents) "
    "SELECT doc_id, (" + " + ".join(f"CAST({c} > 0 AS INT)" for c in _CATS) + ") > 2 AND (alpha = 0 OR " + " OR ".join(f"{c} >= 0.65 * alpha" for c in _CATS[1:]) + ") AS mixed, "
    "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} > 0 THEN '{c}' END" for c in _CATS[1:]) + "], lambda x: x IS NOT NULL), ',') AS secondary, "
    "array_to_string(list_filter([" + ", ".join(f"CASE WHEN n_{c} >= 2 THEN '{c}' END" for c in _CATS) + "], lambda x: x IS NOT NULL), ',') AS topics FROM h"
)
def mixed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-category test, secondary categories and topics of every text."""
    alpha = F.lit("alpha")
    found = _read(spark, sf_dir, "documents").select("doc_id", "text", C.keywords_found(F.col("text"), TEST_LEXICON).alias("found"))
    return found.select(
        "doc_id",
        C.mixed_by(F.col("found"), alpha, TEST_LEXICON, most=2).alias("mixed"),
        F.array_join(C.secondary_by(F.col("found"), alpha, TEST_LEXICON), ",").alias("secondary"),
        F.array_join(C.mixed_topics(F.col("text"), TEST_LEXICON), ",").alias("topics"),
    )


_SAMPLE = "lower(array_to_string(list_slice(string_split_regex(text, '[.!?]+'), 1, 10), ' '))"


@query(
    f"WITH s AS (SELECT doc_id, {_SAMPLE} AS x, text FROM documents), h AS (SELECT doc_id, text, list_max([" + ", ".join("{'s': " + _subs("x", ws) + f", 't': '{t}'" + "}" for t, ws in TEST_TITLES) + "]) AS b FROM s) "
    "SELECT doc_id, CASE WHEN b.s >= 1 THEN b.t " + " ".join(f"WHEN {_subs('text', ws)} >= 2 THEN '{c.replace('_', ' ').title()} Information'" for c, ws in lex.CATEGORY_KEYWORDS.items()) + f" ELSE '{lex.DEFAULT_TITLE}' END AS title FROM h"
)
def title_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles by rules with a fallback on categories."""
    return _read(spark, sf_dir, "documents").select("doc_id", C.infer_title(F.col("text"), TEST_TITLES).alias("title"))


@query(
    "SELECT doc_id, array_to_string(CASE WHEN len(p) = 0 THEN ['ALL'] ELSE p END, ',') AS scope FROM (SELECT doc_id, list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN '{p}' END" for p, ws in lex.PROGRAM_SCOPE.items()) + "], lambda x: x IS NOT NULL) AS p FROM documents)"
)
def program_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.array_join(C.program_scope(F.col("text")), ",").alias("scope"))


@query("SELECT conv_id, turn, CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN '{r}'" for r, ws in lex.ROUTES.items()) + " ELSE 'unknown' END AS route FROM conversations WHERE role = 'user'")
def route_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword routing of all user turns."""
    return _read(spark, sf_dir, "conversations").filter("role = 'user'").select("conv_id", "turn", C.route_query(F.col("text")).alias("route"))


_LABEL = "CASE WHEN regexp_matches(lower(text), 'keit|ung') THEN 'second' WHEN regexp_matches(lower(text), 'tion|ing') THEN 'first' ELSE 'third' END"


@query("WITH r AS (SELECT CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN '{r}'" for r, ws in TEST_ROUTES.items()) + f" ELSE 'unknown' END AS p, {_LABEL} AS l FROM conversations WHERE role = 'user') SELECT count(*) AS n, count(*) FILTER (p = l) AS correct, round(100 * count(*) FILTER (p = l) / count(*), 2) AS accuracy_pct FROM r")
def routing_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of keyword routing against a rule's labels."""
    low = F.lower("text")
    label = F.when(low.rlike("keit|ung"), "second").when(low.rlike("tion|ing"), "first").otherwise("third")
    rows = _read(spark, sf_dir, "conversations").filter("role = 'user'").select(C.route_query(F.col("text"), TEST_ROUTES).alias("p"), label.alias("l"))
    return evaluate.routing_accuracy(rows, "p", "l")


# --- segmentation ---

_LINES = "SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"
_HEAD = r"(length(trim(line)) < 60 AND regexp_matches(line, '[A-Z]') AND NOT regexp_matches(line, '(^|[^A-Za-z])[a-z]{8,}'))"


@query(
    f"WITH l AS ({_LINES}), h AS (SELECT *, {_HEAD} AS is_head FROM l), n AS (SELECT *, sum(CAST(is_head AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section_no FROM h) "
    "SELECT doc_id, CAST(section_no AS BIGINT) AS section_no, CAST(min(line_no) AS INT) AS first_line, CAST(max(line_no) AS INT) AS last_line, CAST(count(*) AS BIGINT) AS n_lines FROM n WHERE section_no > 0 GROUP BY 1, 2"
)
def section_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines by a shape test and the spans of lines that they head."""
    from pyspark.sql import Window

    rows = segment.lines(_read(spark, sf_dir, "documents"))
    head = (F.length(F.trim("line")) < 60) & F.col("line").rlike("[A-Z]") & ~F.col("line").rlike("(^|[^A-Za-z])[a-z]{8,}")
    order = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("section_no", F.sum(head.cast("int")).over(order)).filter("section_no > 0")
    return numbered.groupBy(F.col("doc").alias("doc_id"), "section_no").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count(F.lit(1)).alias("n_lines"))


@query()
def regulation_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of every text under regulation headers, or the whole text as one."""
    return segment.sections(_read(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


_OVERSIZE = """
WITH c AS (SELECT doc_id, source, trim(regexp_replace(text, '[ \\x09-\\x0d]+', ' ', 'g')) AS t FROM documents),
p AS (SELECT *, flatten(list_transform(string_split(regexp_replace(t, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)),
  lambda s: CASE WHEN length(s) <= 1200 THEN [s] ELSE string_split(s, ' ') END)) AS pieces FROM c),
r AS (SELECT *, list_reduce(pieces, lambda acc, s: CASE WHEN length(string_split(acc, chr(1))[-1]) + 1 + length(s) <= 800 THEN acc || ' ' || s ELSE acc || chr(1) || s END) AS packed FROM p),
x AS (SELECT doc_id, source, CASE WHEN length(t) <= 1200 THEN [t] ELSE list_filter(string_split(packed, chr(1)), lambda x: length(x) >= 20) END AS parts FROM r),
u AS (SELECT doc_id, source, len(parts) AS n, unnest(parts) AS content, generate_subscripts(parts, 1) AS i FROM x)
SELECT doc_id, CASE WHEN n > 1 THEN source || ' (part ' || i || '/' || n || ')' ELSE source END AS section_title,
  CAST(n AS INT) AS chunk_total, content, CAST(i AS INT) AS chunk_index FROM u
"""


@query(_OVERSIZE)
def oversize_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in parts of about 800 characters between sentences."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("section_title"), F.col("text").alias("content"))
    return segment.oversize_rows(docs)


@query(
    "WITH l AS (" + _LINES + "), p AS (SELECT doc_id, min(line_no) AS a, max(line_no) AS b FROM l WHERE contains(line, 'the') GROUP BY 1) "
    "SELECT d.doc_id, CASE WHEN a IS NULL THEN 'N/A' WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END AS page_range FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id"
)
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last line of every text that contains a word."""
    docs = _read(spark, sf_dir, "documents")
    hits = segment.lines(docs).filter(F.contains("line", F.lit("the"))).groupBy(F.col("doc").alias("doc_id")).agg(F.min("line_no").alias("a"), F.max("line_no").alias("b"))
    return docs.select("doc_id").join(hits, "doc_id", "left").select("doc_id", T.page_range(F.col("a"), F.col("b")).alias("page_range"))


# --- validation ---

_PAIRS = [("the", "and"), ("der", "die"), ("que", "la")]
_BULLETS = " + ".join(rf"(length(text) - length(replace(text, chr(10) || '{b}', ''))) // 2" for b in "-•*")
_ISSUES = (
    "list_filter([CASE WHEN length(text) < 200 THEN 'Too short (' || length(text) || ' < 200 chars)' END, CASE WHEN length(text) > 800 THEN 'Too long (' || length(text) || ' > 800 chars)' END, "
    f"CASE WHEN {_BULLETS} > 3 THEN 'Too many bullet points (' || ({_BULLETS}) || ' > 3)' END, "
    + ", ".join(f"CASE WHEN contains(lower(text), '{a}') AND contains(lower(text), '{b}') AND NOT contains(lower(text), '{a} {b}') AND NOT contains(lower(text), '{b} {a}') THEN 'Mixed topics detected: ''{a}'' and ''{b}''' END" for a, b in _PAIRS)
    + r", CASE WHEN len(string_split_regex(lower(text), '[.!?]')) > 2 AND repeats THEN 'Repeated/similar sentences detected' END, CASE WHEN regexp_matches(text, '^\s*$') THEN 'Empty or whitespace-only content' END], lambda x: x IS NOT NULL)"
)
_SETS = r"list_filter(list_transform(string_split_regex(lower(text), '[.!?]'), lambda s: list_distinct(list_filter(string_split_regex(s, '\s+'), lambda w: w <> ''))), lambda s: len(s) > 5)"
_CHECKED = (
    f"WITH b AS (SELECT doc_id, text, {_SETS} AS sets FROM documents), e AS (SELECT doc_id, generate_subscripts(sets, 1) AS i, unnest(sets) AS s FROM b), "
    "w AS (SELECT doc_id, i, len(s) AS n, unnest(s) AS w FROM e), p AS (SELECT x.doc_id, x.i, y.i AS j FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i GROUP BY 1, 2, 3, x.n, y.n HAVING count(*) * 2 > least(x.n, y.n)), "
    f"c AS (SELECT doc_id, text, doc_id IN (SELECT doc_id FROM p) AS repeats FROM documents), v AS (SELECT doc_id, {_ISSUES} AS issues FROM c) "
)


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", C.chunk_issues(F.col("text"), pairs=_PAIRS).alias("issues"))


@query(_CHECKED + "SELECT doc_id, array_to_string(issues, '; ') AS issues, len(issues) = 0 AS valid FROM v")
def chunk_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of every text as a chunk: size, bullets, mixed topics, repeated sentences, blank."""
    return _issues(spark, sf_dir).select("doc_id", F.array_join("issues", "; ").alias("issues"), (F.size("issues") == 0).alias("valid"))


@query(_CHECKED + ", k AS (SELECT unnest(issues) AS i FROM v) SELECT trim(string_split(i, '(')[1]) AS kind, count(*) AS n FROM k GROUP BY 1")
def issue_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.issue_histogram(_issues(spark, sf_dir), "issues")


@query(_CHECKED + "SELECT count(*) AS total, count(*) FILTER (len(issues) = 0) AS valid, count(*) FILTER (len(issues) > 0) AS invalid, round(100 * count(*) FILTER (len(issues) = 0) / count(*), 2) AS valid_pct FROM v")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.validation_summary(_issues(spark, sf_dir), "issues")


@query(
    "SELECT doc_id, array_to_string(f, ',') AS flags, CAST(greatest(0.0, 1 - 0.15 * len(f)) AS DOUBLE) AS score FROM (SELECT doc_id, list_filter([CASE WHEN n_chars // 1000 = 0 THEN 'NO_UNITS' END, CASE WHEN doc_id % 3 = 0 THEN 'NO_OUTCOMES' END, CASE WHEN doc_id % 5 = 0 THEN 'NO_OBJECTIVES' END, "
    "CASE WHEN regexp_matches(text, ' (and|of|in|the|for|to|&|or|-)$') THEN 'TRUNCATED_NAME' END, CASE WHEN contains(text, '[NEEDS REVIEW]') THEN 'NAME_UNRESOLVED' END, CASE WHEN doc_id % 7 = 0 THEN 'ZERO_CREDITS' END], lambda x: x IS NOT NULL) AS f FROM documents)"
)
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course flags over numbers that stand for units, outcomes, objectives and credits."""
    d = _read(spark, sf_dir, "documents")
    f = C.course_flags(F.floor(F.col("n_chars") / 1000), F.col("doc_id") % 3, F.col("doc_id") % 5, F.col("text"), F.col("doc_id") % 7)
    return d.select("doc_id", f.alias("f")).select("doc_id", F.array_join("f", ",").alias("flags"), C.quality_score(F.col("f")).alias("score"))


@query(
    "SELECT doc_id, CASE WHEN length(source || chr(10) || chr(10) || text) > 8000 THEN substr(source || chr(10) || chr(10) || text, 1, 8000) || '...' ELSE source || chr(10) || chr(10) || text END AS admin, "
    "'Category: ' || lang || chr(10) || 'Title: ' || source || CASE WHEN text = '' THEN '' ELSE chr(10) || 'Content: ' || text END AS institutional, substr(" + _collapse("text") + ", 1, 220) AS preview FROM documents"
)
def render_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding documents and previews of every record."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.render_admin(F.col("source"), F.col("text")).alias("admin"), T.render_institutional(F.col("lang"), F.col("source"), F.array().cast("array<string>"), F.col("text")).alias("institutional"), T.preview(F.col("text")).alias("preview"))


# --- deduplication ---


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(" + _STRIP.format("lower(substr(text, 1, 150))") + ") ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedup_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each hash of 150 characters."""
    return dedup.keep_first(_read(spark, sf_dir, "documents").select("doc_id", "text"), dedup.prefix_md5(F.col("text")), ["doc_id"]).select("doc_id")


@query(
    "WITH d AS (SELECT doc_id, md5(" + _STRIP.format("text") + ") AS k, CASE WHEN lower(substr(text, 1, 40)) IN ('general information') OR " + _words("substr(text, 1, 40)") + " < 3 THEN 0 ELSE 1 END AS good, " + _words("text") + " AS w FROM documents) "
    "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY k ORDER BY good DESC, w DESC, doc_id) AS n FROM d) WHERE n = 1"
)
def dedup_exact_pick_better(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal contents the better record: good title, more words, earlier."""
    d = _read(spark, sf_dir, "documents").select("doc_id", "text", F.substring("text", 1, 40).alias("title"), F.lit("rule").alias("version"))
    return dedup.keep_better(d, dedup.stripped_md5(F.col("text")), F.col("title"), F.col("text"), F.col("version"), "doc_id").select("doc_id")


@query(
    r"WITH k AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(trim(p_name)), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) || '|' || lower(trim(p_type)) || '|' || lower(trim(p_brand)) || '|' || CAST(p_size AS VARCHAR) AS k FROM part) "
    "SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY k ORDER BY p_partkey) AS n FROM k) WHERE n = 1"
)
def dedup_soft_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part of each name, type, brand and size."""
    p = _read(spark, sf_dir, "part")
    return dedup.keep_first(p, dedup.soft_key(F.col("p_name"), F.col("p_type"), F.col("p_brand"), F.col("p_size").cast("string")), ["p_partkey"]).select("p_partkey")


def _text_tokens() -> tuple:
    return T.words(dedup.normal_name(F.col("text"))), [F.col("lang"), F.col("source")]


_TOKENS = r"list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9_\x09-\x0d ]', ' ', 'g'), '[\x09-\x0d ]+'), lambda w: w <> '')))"
_LINKS = f"""
t AS (SELECT doc_id, lang, source, {_TOKENS} AS ws FROM documents),
c AS (SELECT lang, source, ws, min(doc_id) AS o FROM t WHERE len(ws) > 0 GROUP BY ALL),
m AS (SELECT a.o AS i, b.o AS j, len(list_intersect(a.ws, b.ws)) AS n, len(a.ws) AS x, len(b.ws) AS y FROM c AS a JOIN c AS b
  ON a.lang IS NOT DISTINCT FROM b.lang AND a.source IS NOT DISTINCT FROM b.source AND a.o < b.o),
near AS (SELECT i, j, n / (x + y - n) AS similarity FROM m WHERE n / (x + y - n) >= 0.8),
l AS (SELECT i, j, similarity FROM near UNION ALL SELECT c.o, t.doc_id, 1.0 FROM t JOIN c
  ON t.lang IS NOT DISTINCT FROM c.lang AND t.source IS NOT DISTINCT FROM c.source AND t.ws = c.ws AND t.doc_id > c.o)
"""


@query(f"WITH {_LINKS} SELECT i, j, round(similarity, 6) AS similarity FROM l")
def near_dup_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar pairs of whole texts of a language and source; of equal token sets the first stands for all."""
    tokens, block = _text_tokens()
    links = dedup.jaccard_links(_read(spark, sf_dir, "documents"), tokens, block, "doc_id", 0.8)
    return links.select("i", "j", F.round("similarity", 6).alias("similarity"))


@query(f"""
WITH RECURSIVE {_LINKS},
b AS (SELECT j, list(i) AS before, row_number() OVER (ORDER BY j) AS k FROM near GROUP BY j),
g AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone
  UNION ALL
  SELECT b.k, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, b.j) ELSE gone END FROM g JOIN b ON b.k = g.k + 1
),
e AS (SELECT gone FROM g ORDER BY k DESC LIMIT 1),
f AS (SELECT j AS removed, min(i) AS kept, arg_min(similarity, i) AS similarity FROM near, e WHERE list_contains(gone, j) AND NOT list_contains(gone, i) GROUP BY 1)
SELECT removed, kept, round(similarity, 6) AS similarity FROM f
UNION ALL
SELECT l.j, coalesce(f.kept, l.i), round(coalesce(f.similarity, l.similarity), 6) FROM l LEFT JOIN f ON f.removed = l.i WHERE l.j NOT IN (SELECT o FROM c)
""")
def greedy_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the greedy pass over similar whole texts of a language and source removes, with what they fall to."""
    tokens, block = _text_tokens()
    links = dedup.jaccard_links(_read(spark, sf_dir, "documents"), tokens, block, "doc_id", 0.8)
    got = dedup.greedy_duplicates(links)
    return got.select("removed", "kept", F.round("similarity", 6).alias("similarity"))


_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"


@query(f"""
WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
g AS (
  SELECT label, k, [{{'id': vec_id, 'v': embedding}}] AS leaders, vec_id, vec_id AS leader, CAST(1.0 AS DOUBLE) AS similarity FROM r WHERE k = 1
  UNION ALL
  SELECT label, k, CASE WHEN best.s >= 0.8 THEN leaders ELSE list_append(leaders, {{'id': vec_id, 'v': embedding}}) END, vec_id,
    CASE WHEN best.s >= 0.8 THEN -best.p ELSE vec_id END, CASE WHEN best.s >= 0.8 THEN best.s ELSE 1.0 END
  FROM (SELECT r.label, r.k, leaders, r.vec_id, r.embedding, list_max(list_transform(leaders, lambda x: {{'s': {_DOT.format(a="x.v", b="r.embedding")}, 'p': -x.id}})) AS best
    FROM g JOIN r ON r.label = g.label AND r.k = g.k + 1)
)
SELECT vec_id, label, leader, round(similarity, 6) AS similarity FROM g
""")
def leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy leader clusters of vectors within their labels."""
    e = _read(spark, sf_dir, "embeddings")
    got = dedup.leader_clusters(e, "label", "vec_id", "embedding", 0.8)
    return got.select("vec_id", "label", "leader", F.round("similarity", 6).alias("similarity"))


# --- vectors ---

_ADJ = "SELECT label, vec_id, " + _DOT.format(a="embedding", b="nxt") + " AS similarity FROM (SELECT label, vec_id, embedding, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS nxt FROM embeddings) WHERE nxt IS NOT NULL"


@query(f"WITH a AS ({_ADJ}) SELECT label, vec_id, round(similarity, 6) AS similarity, round(avg(similarity) OVER (PARTITION BY label ORDER BY vec_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM a")
def adjacent_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vectors.adjacent_similarity(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")
    return got.select("label", "vec_id", F.round("similarity", 6).alias("similarity"), F.round("smooth", 6).alias("smooth"))


def _fold(thresholds: str) -> str:
    """SQL of the boundaries that a fold finds: CTEs a (similarities), s (smoothed), n (sizes) and f with a row a place."""
    return f"""
a AS ({_ADJ}),
s AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i, avg(similarity) OVER (PARTITION BY label ORDER BY vec_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS x FROM a),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
t AS ({thresholds}),
f AS (
  SELECT threshold, label, n, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS last FROM n, t
  UNION ALL
  SELECT f.threshold, f.label, f.n, s.i, CASE WHEN s.x < f.threshold AND s.i - f.last >= 5 AND f.n - s.i >= 5 THEN s.i ELSE f.last END FROM f JOIN s ON s.label = f.label AND s.i = f.i + 1
),
e AS (SELECT DISTINCT threshold, label, n, last AS start FROM f),
d AS (SELECT *, lead(start, 1, n) OVER (PARTITION BY threshold, label ORDER BY start) - start AS size FROM e)"""


@query(f"""
WITH RECURSIVE {_fold("SELECT CAST(0.5 AS DOUBLE) AS threshold")},
w AS (SELECT *, CAST(ceil(size / 20) AS BIGINT) AS windows FROM d WHERE size >= 5),
v AS (SELECT *, windows - CASE WHEN windows > 2 AND size - (windows - 1) * 20 < 5 THEN 1 ELSE 0 END AS parts FROM w),
u AS (SELECT *, unnest(range(parts)) AS i FROM v)
SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY start, i) - 1 AS INT) AS chunk, CAST(start + 20 * i AS INT) AS start, CAST(CASE WHEN i = parts - 1 THEN size - 20 * i ELSE 20 END AS INT) AS length FROM u
""")
def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic boundaries along each label's vectors and the chunks between them."""
    got = vectors.topic_boundaries(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 0.5)
    spans = segment.chunk_spans(F.col("ends"), F.col("n"))
    return got.select("label", F.posexplode(spans).alias("chunk", "s")).select("label", "chunk", F.col("s.start").alias("start"), F.col("s.len").alias("length"))


@query(
    "WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), e AS (SELECT label, d, sum(v) AS s, sum(v * v) AS q, count(*) AS n FROM x GROUP BY 1, 2) "
    "SELECT label, max(n) AS n, round((sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)), 8) AS purity FROM e GROUP BY 1"
)
def pairwise_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vectors.pairwise_purity(_read(spark, sf_dir, "embeddings"), "label", "embedding")
    return got.select("label", "n", F.round("purity", 8).alias("purity"))


@query(
    f"WITH a AS ({_ADJ}) SELECT " + ", ".join(f"round(quantile_cont(similarity, {p / 100}), 6) AS p{p}" for p in (10, 25, 50, 75, 90)) + ", round(avg(similarity), 6) AS mean FROM a"
)
def percentile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vectors.percentiles(vectors.adjacent_similarity(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding"), "similarity")
    return got.select(*[F.round(c, 6).alias(c) for c in got.columns])


_GRID = "SELECT DISTINCT round(unnest(quantile_cont(similarity, [" + ", ".join(str(i / 100) for i in range(5, 100, 5)) + "])), 4) AS threshold FROM a"
_TRIED = f"""{_fold(_GRID)},
z AS (SELECT threshold, avg(least(size, 20)) AS mean_sentences FROM d WHERE label IN (SELECT label FROM s) GROUP BY 1)"""


@query(f"WITH RECURSIVE {_TRIED} SELECT threshold, round(mean_sentences, 6) AS mean_sentences, row_number() OVER (ORDER BY abs(mean_sentences - 12), threshold) = 1 AS best FROM z")
def threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate thresholds and the chunk sizes that each would give."""
    got = vectors.threshold_search(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")
    return got.select("threshold", F.round("mean_sentences", 6).alias("mean_sentences"), "best")


_WINDOWS = """
c AS (SELECT label, vec_id, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS p, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
k AS (SELECT *, least(20, greatest(5, n // 2)) AS w FROM c),
h AS (SELECT *, p // w AS window_no FROM k WHERE (p // w + 1) * w <= n),
y AS (SELECT label, window_no, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM h),
q AS (SELECT label, window_no, d, sum(v) AS s, sum(v * v) AS q, count(*) AS n FROM y GROUP BY ALL),
o AS (SELECT label, window_no, max(n) AS n, (sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)) AS purity FROM q GROUP BY ALL)"""


@query(f"WITH {_WINDOWS} SELECT label, window_no, n, round(purity, 8) AS purity FROM o")
def window_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vectors.window_purity(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")
    return got.select("label", "window_no", "n", F.round("purity", 8).alias("purity"))


@query(
    f"WITH RECURSIVE {_TRIED}, {_WINDOWS}, b AS (SELECT arg_min(threshold, {{'a': abs(mean_sentences - 12), 't': threshold}}) AS threshold FROM z) "
    "SELECT round(coalesce((SELECT threshold FROM b), (SELECT quantile_cont(similarity, 0.25) FROM a)), 3) AS similarity_threshold, round((SELECT quantile_cont(similarity, 0.75) FROM a), 3) AS semantic_boundary_threshold, "
    "round((SELECT quantile_cont(purity, 0.5) FROM o), 3) AS mixed_topic_threshold, round((SELECT quantile_cont(purity, 0.1) FROM o), 3) AS purity_floor"
)
def recommend_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.recommend(_read(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding")


_Q = "SELECT vec_id AS query_id, embedding AS q, label FROM embeddings WHERE vec_id % 50 = 0"


@query(
    f"WITH q AS ({_Q}), s AS (SELECT query_id, vec_id AS pos, " + _DOT.format(a="q.q", b="e.embedding") + " AS score FROM q, embeddings e), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) AS rank FROM s) SELECT query_id, pos, CAST(rank AS INT) AS rank, round(score, 4) AS score FROM r WHERE rank <= 5"
)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors with the greatest inner products for the query set."""
    e = _read(spark, sf_dir, "embeddings")
    got = vectors.top_k(e.filter("vec_id % 50 = 0"), e, 5, query_id="vec_id", query_vector="embedding", pos="vec_id")
    return got.select("query_id", "pos", "rank", F.round("score", 4).alias("score"))


@query("SELECT count(*) FILTER (vec_id % 50 = 0) AS queries, 5 * count(*) FILTER (vec_id % 50 = 0) AS hits, true AS recalled FROM embeddings")
def graph_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the graph index finds of the 5 best vectors of the query set: whether it is 0.95 or more of them."""
    e = _read(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 50 = 0").select("vec_id", F.col("embedding").alias("q"))
    found = graph.search_graph(q, graph.build_graph(e, "vec_id"), 5, query_id="vec_id", query_vector="q")
    exact = vectors.top_k(q, e, 5, query_id="vec_id", query_vector="q", pos="vec_id").select("query_id", "pos", F.lit(1).alias("best"))
    met = found.join(exact, ["query_id", "pos"], "left")
    return met.agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("hits"), (F.count("best") >= 0.95 * F.count(F.lit(1))).alias("recalled"))


@query(
    f"WITH q AS ({_Q}), s AS (SELECT query_id, q.label AS want, e.label AS label, max(" + _DOT.format(a="q.q", b="e.embedding") + ") AS score FROM q, embeddings e GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER w AS n, coalesce(lead(score) OVER w, 0.0) AS runner_up FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, label)) "
    "SELECT query_id, label AS predicted, round(score, 4) AS score, round(score - runner_up, 4) AS margin, CASE WHEN label <> want THEN 'WRONG_DB' WHEN score - runner_up < 0.05 THEN 'WEAK_SEPARATION' WHEN score - runner_up < 0.10 THEN 'MODERATE_MATCH' ELSE 'GOOD_MATCH' END AS status FROM r WHERE n = 1"
)
def cross_index_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's best index (label), its margin and class."""
    e = _read(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 50 = 0").select("vec_id", "embedding", F.col("label").alias("want"))
    got = vectors.route_by_index(q, e, "label", label="want", query_id="vec_id", query_vector="embedding", pos="vec_id")
    return got.select("query_id", "predicted", F.round("score", 4).alias("score"), F.round("margin", 4).alias("margin"), "status")


@query("SELECT label, CAST(max(len(embedding)) AS INT) AS dimension, count(*) AS vectors FROM embeddings GROUP BY 1")
def index_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.index_report(_read(spark, sf_dir, "embeddings"), "label")


# --- reports ---


@query("SELECT source, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS share_pct FROM documents GROUP BY 1")
def distribution_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.distribution(_read(spark, sf_dir, "documents"), F.col("source"), "source")


@query("SELECT " + ", ".join(f"round(100 * avg(CASE WHEN {t} THEN 1 ELSE 0 END), 2) AS {c}_pct" for c, t in (("text", r"coalesce(regexp_replace(text, '\s', '', 'g'), '') <> ''"), ("lang", "coalesce(lang, '') <> ''"), ("quality", "quality IS NOT NULL"))) + r", round((round(100 * avg(CASE WHEN coalesce(regexp_replace(text, '\s', '', 'g'), '') <> '' THEN 1 ELSE 0 END), 2) + round(100 * avg(CASE WHEN coalesce(lang, '') <> '' THEN 1 ELSE 0 END), 2) + round(100 * avg(CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END), 2)) / 3, 2) AS mean_pct FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of documents with text, language and a quality label."""
    d = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id", "left")
    return evaluate.completeness(d, ["text", "lang", "quality"])


@query("SELECT l.quality, l.toxic, count(*) AS n, round(avg(" + _words("d.text") + "), 6) AS mean_words, round(100 * avg(CASE WHEN " + _words("d.text") + " BETWEEN 75 AND 500 THEN 1 ELSE 0 END), 4) AS optimal_pct FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 2")
def label_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length statistics by verdict."""
    d = _read(spark, sf_dir, "documents").join(_read(spark, sf_dir, "labels"), "doc_id")
    w = T.word_count(F.col("text"))
    return d.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(w), 6).alias("mean_words"), F.round(100 * F.avg(w.between(75, 500).cast("int")), 4).alias("optimal_pct"))


@query("SELECT min(length(text)) AS min_chars, max(length(text)) AS max_chars, round(avg(length(text)), 6) AS mean_chars, median(length(text)) AS median_chars FROM documents")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = evaluate.length_stats(_read(spark, sf_dir, "documents"), "text")
    return got.withColumn("mean_chars", F.round("mean_chars", 6))


@query("SELECT count(source) - count(DISTINCT source) AS titles, count(substr(text, 1, 100)) - count(DISTINCT substr(text, 1, 100)) AS prefixes, count(md5(text)) - count(DISTINCT md5(text)) AS contents, count(text) - count(DISTINCT md5(" + _STRIP.format("text") + ")) AS stripped FROM documents")
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.duplicate_counts(_read(spark, sf_dir, "documents"), "source", "text")


@query(
    r"WITH b AS (SELECT item_id, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS w FROM benchmark), d AS (SELECT doc_id, ' ' || array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), ' ') || ' ' AS t FROM documents) "
    "SELECT d.doc_id, b.item_id AS marker_id FROM d, b WHERE len(w) > 0 AND contains(t, ' ' || array_to_string(w, ' ') || ' ')"
)
def marker_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a whole benchmark passage."""
    return evaluate.marker_contamination(_read(spark, sf_dir, "documents"), "doc_id", "text", _read(spark, sf_dir, "benchmark"), "item_id", "text")


_FLOW = "WITH s AS (SELECT event_type AS stage, count(DISTINCT user_id) AS output_count, min(struct_pack(ts := ts, event_id := event_id)) AS f FROM events GROUP BY 1), p AS (SELECT stage, output_count, lag(output_count) OVER (ORDER BY f) AS input_count FROM s) "


@query(_FLOW + "SELECT stage, output_count, coalesce(input_count, 0) AS input_count, coalesce(output_count - input_count, 0) AS delta, coalesce(round(100 * (output_count - input_count) / input_count, 1), 0) AS delta_pct, coalesce(output_count < input_count AND (input_count - output_count) / input_count > 0.1, false) AS alarm FROM p")
def stage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that reach each stage of the event log, and losses between stages."""
    got = audit.stage_flow(_read(spark, sf_dir, "events"), "event_type", "user_id", ["ts", "event_id"])
    return got.fillna(0, ["input_count", "delta", "delta_pct"])


@query("SELECT event_type AS stage, arg_max(user_id, struct_pack(ts := ts, event_id := event_id)) AS output_count FROM events GROUP BY 1")
def latest_stage_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entry of each stage."""
    e = _read(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.col("user_id").alias("output_count"), "ts", "event_id")
    return audit.latest_counts(e, ["ts", "event_id"])


@query(
    "WITH a AS (SELECT page_id % 20 AS k, count(*) AS n, avg(length(html)) AS c FROM pages GROUP BY 1), b AS (SELECT doc_id % 20 AS k, count(*) AS n, avg(length(text)) AS c FROM documents GROUP BY 1) "
    "SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS now_n, coalesce(b.n, 0) AS before_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta, round(100 * (coalesce(a.n, 0) - coalesce(b.n, 0)) / nullif(b.n, 0), 2) AS delta_pct, round(coalesce(a.c, 0) - coalesce(b.c, 0), 4) AS delta_chars FROM a FULL OUTER JOIN b ON a.k = b.k"
)
def baseline_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and lengths of two whole tables, pages against documents, by a key that both have (groups of ids)."""
    now = _read(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("k"), F.col("html").alias("text"))
    before = _read(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("k"), "text")
    return evaluate.baseline_delta(now, before, "k", "text")


@query("WITH x AS (SELECT lang, CASE WHEN " + _words("text") + " < 75 THEN 'too_short' WHEN length(text) > 8000 THEN 'too_long' ELSE 'accepted' END AS reason FROM documents) SELECT lang, reason, count(*) AS n FROM x GROUP BY 1, 2")
def rejection_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    reason = F.when(T.word_count(F.col("text")) < 75, "too_short").when(F.length("text") > 8000, "too_long").otherwise("accepted")
    return evaluate.tally(d.select("lang", reason.alias("reason")), "lang", "reason")


@query("SELECT unnest(['the', 'keitung', 'qqqq']) AS term, unnest([(SELECT bool_or(contains(lower(text), 'the')) FROM documents), (SELECT bool_or(contains(lower(text), 'keitung')) FROM documents), (SELECT bool_or(contains(lower(text), 'qqqq')) FROM documents)]) AS found")
def term_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.term_coverage(_read(spark, sf_dir, "documents"), "text", ["the", "keitung", "qqqq"])


@query(
    f"WITH s AS (SELECT doc_id, {_SENTENCES} AS ss, length(text) AS chars, " + _words("text") + " AS w, CASE WHEN length(text) < 20 OR greatest(" + ", ".join(_hits("text", ws) for ws in TEST_LEXICON.values()) + ") = 0 THEN '' " + " ".join(f"WHEN {_hits('text', ws)} = greatest({', '.join(_hits('text', x) for x in TEST_LEXICON.values())}) THEN '{c}'" for c, ws in TEST_LEXICON.items()) + " END AS category FROM documents) "
    "SELECT category, count(*) AS n, round(avg(w), 6) AS mean_words, CAST(sum(len(ss)) AS BIGINT) AS sentences, round(100 * avg(CASE WHEN w >= 30 AND category <> '' THEN 1 ELSE 0 END), 4) AS valid_pct FROM s GROUP BY 1"
)
def category_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: sentences, words, category and validity of all texts, by category."""
    t = F.col("text")
    d = _read(spark, sf_dir, "documents").select(C.infer_category(t, TEST_LEXICON, tuple(TEST_LEXICON)).alias("category"), T.word_count(t).alias("w"), F.size(T.sentences(t)).alias("s"))
    valid = (F.col("w") >= 30) & (F.col("category") != "")
    return d.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("w"), 6).alias("mean_words"), F.sum("s").alias("sentences"), F.round(100 * F.avg(valid.cast("int")), 4).alias("valid_pct"))


def _ocr(x: str) -> str:
    x = _drop(x, *lex.WEB_ARTIFACTS)
    for old, new in lex.OCR_REPAIRS:
        x = f"replace({x}, '{old}', '{new}')"
    return _STRIP.format(rf"regexp_replace(regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g')")


@query(f"SELECT doc_id, {_ocr('text')} AS content FROM documents")
def clean_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optical-recognition repairs in their fixed order."""
    return _read(spark, sf_dir, "documents").select("doc_id", T.clean_ocr(F.col("text")).alias("content"))


_ISSUE_COUNTS = {"empty": "t = ''", "short": "t <> '' AND length(t) <= 5", "long": "length(t) > 80", "mixed_case": "t <> '' AND NOT (upper(t) = t AND lower(t) <> t)", "with_digits": r"regexp_matches(t, '\d')", "punctuation": r"regexp_matches(t, '[^a-zA-Z0-9_\s)]$')"}


@query("SELECT *, CASE WHEN empty + short + long + mixed_case + with_digits + punctuation = 0 THEN 'PERFECT' WHEN empty + short + long + mixed_case + with_digits + punctuation <= 0.05 * n THEN 'GOOD' ELSE 'NEEDS WORK' END AS verdict FROM (SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {k}" for k, c in _ISSUE_COUNTS.items()) + " , count(*) AS n FROM (SELECT coalesce(p_name, '') AS t FROM part))")
def title_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title faults of part names."""
    return evaluate.title_issues(_read(spark, sf_dir, "part"), "p_name")


@query(
    r"SELECT *, empty_table + missing_id + repeated_id + missing_content + missing_title + missing_category + missing_source + repeated_content = 0 AS passed FROM (SELECT CAST(count(*) = 0 AS INT) AS empty_table, count(*) FILTER (doc_id IS NULL) AS missing_id, count(doc_id) - count(DISTINCT doc_id) AS repeated_id, "
    r"count(*) FILTER (regexp_matches(coalesce(text, ''), '^\s*$')) AS missing_content, count(*) FILTER (coalesce(lang, '') = '') AS missing_title, count(*) FILTER (coalesce(source, '') = '') AS missing_category, count(*) FILTER (coalesce(source, '') = '') AS missing_source, count(text) - count(DISTINCT "
    + _STRIP.format("text")
    + ") AS repeated_content FROM documents)"
)
def smoke_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structural checks of documents as records."""
    d = _read(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    return evaluate.smoke_checks(d, "id", "text", F.col("lang"), F.col("source"), "source")


@query("SELECT count(*) AS n, count(*) FILTER (length(source || chr(10) || text) > 30) AS ready FROM documents")
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.readiness(_read(spark, sf_dir, "documents"), F.concat_ws("\n", "source", "text"))


@query("SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'es' AND n_chars < 300)")
def new_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that an earlier, smaller version doesn't have."""
    d = _read(spark, sf_dir, "documents")
    return evaluate.new_keys(d, d.filter("lang = 'es' AND n_chars < 300"), "source")


@query(
    f"WITH q AS ({_Q}), s AS (SELECT query_id, e.label AS l, vec_id AS pos, " + _DOT.format(a="q.q", b="e.embedding") + " AS score FROM q, embeddings e), r AS (SELECT *, row_number() OVER (PARTITION BY query_id, l ORDER BY score DESC, pos) AS n FROM s) SELECT query_id, l AS label, pos, CAST(n AS INT) AS rank, round(score, 4) AS score FROM r WHERE n <= 3"
)
def top_hits_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 best hits of each query in each index (label)."""
    e = _read(spark, sf_dir, "embeddings")
    got = vectors.top_k(e.filter("vec_id % 50 = 0").select("vec_id", F.col("embedding").alias("q")), e, 3, query_id="vec_id", query_vector="q", pos="vec_id", group="label")
    return got.select("query_id", "label", "pos", "rank", F.round("score", 4).alias("score"))


from millrace import authored as _authored  # noqa: E402, F401  (registers its queries)
