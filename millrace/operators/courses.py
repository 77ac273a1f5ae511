"""Course records out of syllabus texts. Marks put before headers let a split stand in for match positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

# --- fixed values: shapes of course headers, units and file names ---
CODE = r"[A-Z]{2,5}[UC]{0,2}\d{3}[A-Z]?"
UNIT = r"UNIT\s*[-–—:]?\s*(?:[IVX]+|[1-5])\b"
UNIT_END = r"\bReference\s+Books?\b|\bTextbooks?\b|CO-PO\s+Mapping|Lecture\s+Periods?\s*:"
TOPIC_STOPS = [r"\bCO-PO\s+Mapping\b", r"\bCourse\s+Outcome\b", r"\bReference\s+Books?\b", r"\bTextbooks?\b", r"Lecture\s+Periods?\s*:"]
PERIODS = r"(?i)Periods?\s*[:\-]\s*(\d+)"
YEARS = [r"Regulations?\s*[:\-]?\s*(\d{4}[-–]\d{2,4})", r"Effective from.*?(\d{4}[-–]\d{2,4})", r"Academic year\s*(\d{4}[-–]\d{2,4})"]
PROGRAMS = [("B.Tech", ["btech", "b.tech"]), ("M.Tech", ["mtech", "m.tech"]), ("MBA", ["mba"]), ("MCA", ["mca"]), ("M.Sc", ["msc", "m.sc"])]
DEPARTMENTS = {
    "cse": "CSE", "ece": "ECE", "eee": "EEE", "eie": "EIE", "me": "ME", "civil": "Civil", "chemical": "Chemical", "it": "IT", "mt": "MT", "ce": "Civil",
    "ib": "International Business", "ievd": "IEVD", "datascience": "Data Science", "infosec": "Information Security", "wireless": "Wireless Communication", "drives": "Drives",
    "instrumentation": "Instrumentation", "iot": "IoT", "energy": "Energy", "pdm": "PDM", "environmental": "Environmental", "structural": "Structural",
}
DANGLING = r"( (and|of|in|the|for|to|&|or|-)|–)\z"
ROMAN = ["I", "II", "III", "IV", "V"]


def file_fields(name: Column) -> tuple[Column, Column, Column]:
    """Program, degree level and department that a file name tells, by its parts between underscores."""
    parts = F.split(F.lower(F.regexp_replace(name, r"(?i)\.pdf$", "")), "_")
    program = F.lit("")
    for p, ws in reversed(PROGRAMS):
        program = F.when(F.arrays_overlap(parts, F.array(*[F.lit(w) for w in ws])), p).otherwise(program)
    degree = F.when(F.get(parts, F.lit(0)) == "ug", "UG").when(F.get(parts, F.lit(0)) == "pg", "PG").otherwise("")
    table = F.create_map(*[F.lit(x) for kv in DEPARTMENTS.items() for x in kv])
    known = F.filter(parts, lambda x: F.map_contains_key(table, x))
    return program, degree, F.coalesce(F.try_element_at(table, F.get(known, F.lit(0))), F.lit("Unknown"))


def regulation_year(text: Column) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, "(?i)" + p, 1), F.lit("")) for p in YEARS])


def course_sections(text: Column) -> Column:
    """A text's course sections, each from its header to the next: from Course Code / Course Name headers, or where
    there are none from bare course codes."""
    headed = F.regexp_replace(text, rf"(?i)(Course\s+Code\s+Course\s+Name[^\x01\n]*\n(?=(?:[^\n]*\n)?{CODE}\s))", "\u0001$1")
    coded = F.regexp_replace(text, rf"(?i)({CODE}\s+\S)", "\u0001$1")
    return F.when(F.contains(headed, F.lit("\u0001")), F.slice(F.split(headed, "\u0001"), 2, 1 << 30)).otherwise(F.slice(F.split(coded, "\u0001"), 2, 1 << 30))


def semester(text: Column) -> Column:
    """The semester's digits; Roman numbers from I to V become digits."""
    got = F.upper(F.coalesce(F.nullif(F.regexp_extract(text, r"(?i)Semester\s*[:\-]?\s*([IVX]+|[1-8])", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"(?i)(\d+)\s*(?:st|nd|rd|th)\s*Semester", 1), F.lit("")), F.lit("")))
    digits = F.array_position(F.array(*[F.lit(r) for r in ROMAN]), got)
    return F.when(digits > 0, digits.cast("string")).otherwise(got)


def _number(text: Column, pattern: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("int"), F.lit(0))


def _load(lecture: Column, tutorial: Column, practical: Column, total: Column) -> Column:
    return F.struct(lecture.alias("lecture"), tutorial.alias("tutorial"), practical.alias("practical"), total.alias("total"))


def credits_of(text: Column) -> Column:
    """Credits from d-d-d, else from single letters; null without a total or lectures."""
    dash = r"\s*[-–—]\s*"
    ltp = [F.regexp_extract(text, rf"(\d+){dash}(\d+){dash}(\d+)", k) for k in (1, 2, 3)]
    a, b, c = [F.coalesce(F.nullif(x, F.lit("")).try_cast("int"), F.lit(0)) for x in ltp]
    singles = [_number(text, rf"(?i){k}\s*[:\-]?\s*(\d+)") for k in ("L", "T", "P")]
    total = _number(text, r"(?i)Credits?\s*[:\-]?\s*(\d+)")
    total = F.when(total == 0, singles[0] + singles[1] + singles[2]).otherwise(total)
    return F.when(ltp[0] != "", _load(a, b, c, a + b + c)).when((total > 0) | (singles[0] > 0), _load(*singles, total))


def contact_hours(text: Column) -> Column:
    got = [_number(text, rf"(?i){k}\s+Periods?\s*[:\-]?\s*(\d+)") for k in ("Lecture", "Tutorial", "Practical", "Total")]
    return F.when((got[3] > 0) | (got[0] > 0), _load(*got))


def _numbered(span: Column, clean=T.strip) -> Column:
    parts = F.transform(F.split(T.strip(span), r"(?m)^\d+[.)]\s*"), clean)
    return F.filter(parts, lambda x: F.length(x) > 10)


def objectives(text: Column) -> Column:
    return _numbered(F.regexp_extract(text, r"(?is)Course\s+Objectives?\s*[:\-]?\s*(.+?)(?=Course\s+Outcome|UNIT|\z)", 1))


def outcomes(text: Column) -> Column:
    """co_id and description of the outcomes in their span."""
    span = F.regexp_extract(text, r"(?is)Course\s+Outcomes?[:\-]?\s*(.+?)(?=UNIT|Lecture Periods|Reference Books|CO-PO Mapping|\z)", 1)
    pattern = F.lit(r"(?is)CO(\d+)\s+(.+?)(?=CO\d+|UNIT|Lecture Periods|\z)")
    pairs = F.arrays_zip(F.regexp_extract_all(span, pattern, F.lit(1)).alias("n"), F.regexp_extract_all(span, pattern, F.lit(2)).alias("d"))
    got = F.transform(pairs, lambda p: F.struct(F.concat(F.lit("CO"), p["n"]).alias("co_id"), T.collapse(p["d"]).alias("description")))
    return F.filter(got, lambda o: o["description"] != "")


def references(text: Column) -> Column:
    return _numbered(F.regexp_extract(text, r"(?is)(?:Reference\s+Books?|Textbooks?|References?)\s*[:\-]?\s*(.+?)(?=CO-PO Mapping|\z)", 1), T.collapse)


def unit_slices(text: Column) -> Column:
    """Texts of the units, from header to header; the last ends at the first end mark behind its own header."""
    slices = F.slice(F.split(F.regexp_replace(text, rf"(?i)({UNIT})", "\u0001$1"), "\u0001"), 2, 1 << 30)
    last = F.size(slices) - 1
    cut = lambda s: F.regexp_extract(s, rf"(?is)\A(.*?)(?={UNIT_END}|\z)", 1)
    return F.transform(slices, lambda s, i: T.strip(F.when(i == last, cut(s)).otherwise(s)))


def unit_number(unit: Column) -> Column:
    got = F.upper(F.regexp_extract(unit, r"(?i)\AUNIT\s*[-–—:]?\s*([IVX]+|[1-5])\b", 1))
    return F.when(got.rlike("^[1-5]$"), F.get(F.array(*[F.lit(r) for r in ROMAN]), got.try_cast("int") - 1)).otherwise(got)


def _unit_lines(unit: Column) -> Column:
    kept = F.filter(F.transform(F.split(unit, "\n"), T.strip), lambda x, i: (i > 0) & (x != "") & ~x.rlike(PERIODS))
    return kept


def unit_title(unit: Column) -> Column:
    """The rest of the header line, else the first line behind it that is no period or outcome mark."""
    tidy = lambda t: T.strip(F.regexp_replace(T.strip(t), r"[:–—]\s*\z", ""))
    head = F.get(F.split(unit, "\n"), F.lit(0))
    own = tidy(F.regexp_extract(head, r"(?i)UNIT\s*[-–—:]?\s*[IVX]+[:\s]+(.+?)(?=Periods|$)", 1))
    later = F.filter(_unit_lines(unit), lambda x: ~x.rlike(r"(?i)^CO\d+[,\s]*$") & (F.length(x) > 3))
    return F.when((F.length(own) > 3) & ~own.rlike(PERIODS), own).otherwise(F.coalesce(tidy(F.get(later, F.lit(0))), F.lit("")))


def unit_topics(unit: Column) -> Column:
    """A unit's topics: what follows its title line, up to the first listed stop that occurs, in parts between
    semicolons, then slashes, commas, dashes and "and"; four characters or more, each once."""
    stop = F.lit(None).cast("string")
    for p in reversed(TOPIC_STOPS):
        stop = F.when(unit.rlike("(?i)" + p), F.regexp_extract(unit, rf"(?is)\A(.*?)(?={p})", 1)).otherwise(stop)
    found = _unit_lines(F.coalesce(stop, unit))
    title_at = F.array_position(F.transform(found, lambda x: F.length(x) > 3), True)
    body = F.filter(found, lambda x, i: ((title_at == 0) | (i != title_at - 1)) & ~x.rlike(r"(?i)^CO\d+[,\s]*$") & ~x.rlike(r"(?i)^(UNIT|Reference|Textbook|Lecture|Tutorial|Practical|Total)"))

    def cleaned(x: Column) -> Column:
        x = F.regexp_replace(F.regexp_replace(x, r"^\w+[.)]\s*", ""), r"^[-•]\s*", "")
        return F.regexp_replace(F.regexp_replace(x, r"(?i)\s*CO\d+[,\s]*$", ""), r"(?i)\s*CO\d+[,\s]*CO\d+[,\s]*$", "")

    whole = F.filter(F.flatten(F.transform(body, lambda x: F.transform(F.split(cleaned(x), ";"), T.strip))), lambda x: F.length(x) > 3)
    parts = F.flatten(F.transform(whole, lambda x: F.split(x, r"(?i)\s*[/,–\-]\s*|\s+and\s+")))
    parts = F.filter(F.transform(parts, T.strip), lambda x: F.length(x) >= 4)
    cased = F.transform(parts, lambda x: T.strip(F.regexp_replace(F.regexp_replace(F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2)))), r"[,;.]+\z", ""), r"^[-–—]\s*", "")))
    return F.array_distinct(F.filter(cased, lambda x: (F.length(x) >= 4) & ~x.rlike(PERIODS)))


def unit_content(unit: Column) -> Column:
    """Lines of over 99 characters, or bullets, tell where structure begins: the longer lines before it, joined."""
    found = F.filter(F.transform(F.split(unit, "\n"), T.strip), lambda x, i: (i > 0) & (x != ""))
    structured = lambda x: x.rlike(r"^[-•*]") | ((F.length(x) >= 100) | (F.length(x) <= 3)) & x.rlike(r"(?i)^(CO\d+|\d+[.)]\s*)")
    at = F.array_position(F.transform(found, structured), True)
    before = F.filter(F.slice(found, 1, F.greatest(at.cast("int") - 1, F.lit(0))), lambda x: (F.length(x) > 10) & ~x.rlike(PERIODS) & ~x.rlike(r"(?i)^(UNIT|COURSE|REFERENCE|TEXTBOOK)"))
    return F.array_join(before, " ")


def mapped_outcomes(unit: Column, declared: Column) -> Column:
    """Outcomes that a unit mentions and the course declares, each once, in string order."""
    mentions = F.transform(F.regexp_extract_all(unit, F.lit(r"(?i)CO(\d+)"), F.lit(1)), lambda n: F.concat(F.lit("CO"), n))
    return F.array_sort(F.array_distinct(F.array_intersect(mentions, F.transform(declared, lambda o: o["co_id"]))))


def units(text: Column, declared: Column) -> Column:
    return F.transform(
        unit_slices(text),
        lambda u: F.struct(unit_number(u).alias("unit_number"), unit_title(u).alias("unit_title"), _number(u, PERIODS).alias("hours"), unit_topics(u).alias("topics"), unit_content(u).alias("content"), mapped_outcomes(u, declared).alias("mapped_course_outcomes")),
    )


def extract_courses(docs: DataFrame, file: str = "doc", text: str = "text", pages: str | None = None) -> DataFrame:
    """One row a valid course of the documents (file name, whole text); `section_no` orders a file's courses.

    `pages`: a column with the document's pages, an array of n and t; then courses get page_range, the pages that contain
    their code, as `course_pages` does by a join."""
    program, degree, department = file_fields(F.col(file))
    pattern = rf"(?im)({CODE})\s+(.+?)(?=\n|Periods|Credit|Course\s+Code|Department:|$)"

    def spanned(code: Column) -> Column:
        hits = F.transform(F.filter(pages, lambda p: F.contains(p["t"], code)), lambda p: p["n"])
        return F.when(F.size(hits) > 0, T.page_range(F.array_min(hits), F.array_max(hits))).otherwise("N/A")

    def found(section: Column) -> Column:
        code = T.strip(F.regexp_extract(section, pattern, 1))
        return F.struct(section.alias("section"), code.alias("course_code"), *([spanned(code).alias("page_range")] if pages else []))

    cut = docs.select(F.col(file).alias("doc"), program.alias("program"), degree.alias("degree"), department.alias("department"), regulation_year(F.col(text)).alias("regulation_year"), F.posexplode(F.transform(course_sections(F.col(text)), found)).alias("section_no", "x"))
    cut = cut.select("*", "x.section", "x.course_code", *["x.page_range"] * bool(pages)).drop("x")
    s = F.col("section")
    got = cut.withColumn("course_name", T.collapse(F.regexp_extract(s, pattern, 2))).withColumn("course_outcomes", outcomes(s))
    level = F.when(F.col("degree") != "", F.col("degree")).when(F.col("program").isin("MBA", "MCA", "M.Tech", "M.Sc"), "PG").when(F.col("program").isin("B.Tech", "B.E"), "UG").otherwise("")
    return got.filter((F.col("course_code") != "") & (F.col("course_name") != "")).select(
        F.lit("course").alias("object_type"), "program", level.alias("degree_level"), "department", "regulation_year", "course_code", "course_name", semester(s).alias("semester"),
        credits_of(s).alias("credits"), contact_hours(s).alias("contact_hours"), objectives(s).alias("course_objectives"), "course_outcomes", units(s, F.col("course_outcomes")).alias("units"),
        references(s).alias("textbook_references"), "doc", "section_no", *["page_range"] * bool(pages),
    )


def course_pages(courses: DataFrame, pages: DataFrame) -> DataFrame:
    """courses with page_range: the pages of their file that contain their code."""
    hits = courses.select("doc", "course_code").distinct().join(pages.select("doc", "page_num", "text"), "doc").filter(F.contains("text", "course_code"))
    spans = hits.groupBy("doc", "course_code").agg(T.page_range(F.min("page_num"), F.max("page_num")).alias("page_range"))
    return courses.join(spans, ["doc", "course_code"], "left").withColumn("page_range", F.coalesce("page_range", F.lit("N/A")))


def repair_name(name: Column, unit_titles: Column, refs: Column) -> Column:
    """A name that ends in the air: the first unit's title if that begins like it, else its place in the first
    reference up to a comma, else marked for review."""
    n = T.strip(name)
    hint = T.title_case(F.get(F.filter(unit_titles, lambda t: F.coalesce(t, F.lit("")) != ""), F.lit(0)))
    ref = F.get(refs, F.lit(0))
    candidate = T.strip(F.get(F.split(F.substr(ref, F.instr(F.lower(ref), F.lower(n)), F.lit(60)), ","), F.lit(0)))
    return (
        F.when(~n.rlike(DANGLING), n)
        .when(F.startswith(F.lower(hint), F.substring(F.lower(n), 1, 15)), hint)
        .when((F.length(n) < 30) & F.contains(F.lower(ref), F.lower(n)) & (F.length(candidate) > F.length(n)), candidate)
        .otherwise(F.concat(n, F.lit(" [NEEDS REVIEW]")))
    )


def render_title(code: Column, name: Column, program: Column, sem: Column) -> Column:
    plain = T.strip(F.regexp_replace(F.regexp_replace(T.strip(name), r"\s*\[NEEDS REVIEW\]\z", ""), r"[ \-–&]+\z", ""))
    meta = F.when(F.coalesce(sem, F.lit("")) != "", F.concat(F.lit(" ("), program, F.lit(", Sem "), sem, F.lit(")"))).when(F.coalesce(program, F.lit("")) != "", F.concat(F.lit(" ("), program, F.lit(")"))).otherwise("")
    return F.concat(T.strip(code), F.lit(" – "), plain, meta)


def render_text(with_topics: bool = True) -> Column:
    """The text of a course row for embedding: head, outcomes renumbered, units, or a note that there are none.

    Units without description show their topics, unless `with_topics` is off; then they are left out."""
    name = F.replace(T.strip(F.col("course_name")), F.lit(" [NEEDS REVIEW]"), F.lit(""))
    described = F.filter("course_outcomes", lambda o: F.coalesce(o["description"], F.lit("")) != "")
    cos = F.array_join(F.transform(described, lambda o, i: F.concat(F.lit("CO"), (i + 1).cast("string"), F.lit(": "), o["description"])), " | ")
    body = lambda u: T.either(T.strip(u["content"]), F.array_join(u["topics"], ", ")) if with_topics else F.nullif(T.strip(u["content"]), F.lit(""))
    unit = lambda u: F.concat(F.lit("Unit "), u["unit_number"], F.lit(" – "), u["unit_title"], F.when(u["hours"] > 0, F.concat(F.lit(" ("), u["hours"].cast("string"), F.lit(" hrs)"))).otherwise(""), F.lit(": "), body(u))
    shown = F.array_join(F.transform(F.filter("units", lambda u: body(u).isNotNull()), unit), "\n")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Course: "), name),
        F.concat(F.lit("Course Code: "), F.col("course_code")),
        F.concat(F.lit("Program: "), F.col("program"), F.lit(" ("), F.col("degree_level"), F.lit(") | Department: "), F.col("department")),
        F.concat(F.lit("Semester: "), F.col("semester"), F.lit(" | Total Credits: "), F.coalesce(F.col("credits.total"), F.lit(0)).cast("string")),
        F.when(cos != "", F.concat(F.lit("Course Outcomes: "), cos)),
        F.when(F.size("units") == 0, F.lit("Note: Detailed unit content not available for this course.")).otherwise(F.nullif(shown, F.lit(""))),
    )
