"""Faculty lists: state carried forward line by line becomes windows; a profile is a block of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import segment as S
from millrace.operators.dedup import keep_first

# --- fixed values: lines that change the state ---
DEPARTMENT = r"(?i)^DEPARTMENT OF (.+?)\s*$"
HEAD = r"(?i)^Head of the Department\s*$"
RANKS = ["PROFESSOR", "ASSOCIATE PROFESSOR", "ASSISTANT PROFESSOR"]
NAME = r"^(Dr\.\s*(?:\(Mrs\.?\)\s*)?|Mr\.\s*|Mrs\.\s*|Ms\.\s*|D\s+)(.+)$"
PAGE_MARK = r"^--- PAGE \d+ ---$"
DEGREES = r"Ph\.D|M\.E|M\.Tech|B\.E|B\.Tech|M\.Sc|M\.A"
SMALL_WORDS = {" And ": " and "}
AREA_CODES = ["0", "413"]


def department_name(raw: Column) -> Column:
    """Title case with small joining words; one known misspelling of a department is put right."""
    t = T.title_case(T.strip(raw))
    for old, new in SMALL_WORDS.items():
        t = F.replace(t, F.lit(old), F.lit(new))
    return F.when(t == "Electrical and Electronic Engineering", "Electrical and Electronics Engineering").otherwise(t)


def core_name(name: Column) -> Column:
    """Upper-case words of a name longer than one letter, without titles and points."""
    bare = F.upper(F.regexp_replace(T.strip(name), r"^(Dr\.|Mr\.|Mrs\.|Ms\.)\s*(\(Mrs\.?\)\s*)?", ""))
    return F.array_join(F.filter(F.transform(T.words(bare), lambda w: F.regexp_replace(w, r"[.,]+\z", "")), lambda w: F.length(w) > 1), " ")


def same_person(a: Column, b: Column) -> Column:
    """Equal core names, or equal last words of four letters or more."""
    x, y = core_name(a), core_name(b)
    last = lambda c: F.substring_index(c, " ", -1)
    return (x != "") & (y != "") & ((x == y) | ((last(x) == last(y)) & (F.length(last(x)) >= 4)))


def faculty_profiles(docs: DataFrame, heads: DataFrame | None = None, doc: str = "doc", text: str = "text") -> DataFrame:
    """One row a person: doc, line_no, name, designation, department, qualifications, specialization, phone, email,
    is_hod, hod_phone, hod_email.

    A department line resets designation and head. A head's block is the lines from its mark on: the name, then
    number, mail or link. Persons begin with a title, and only in a department; a profile ends at the next mark.
    `heads` (department, email) names further heads of departments."""
    order = Window.partitionBy("doc").orderBy("line_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    x = F.col("x")
    found = S.lines(docs, doc, text).select("doc", "line_no", T.strip(F.col("line")).alias("x")).filter((x != "") & ~x.rlike(PAGE_MARK))
    mark = F.when(x.rlike(DEPARTMENT), "department").when(x.rlike(HEAD), "head").when(F.upper(x).isin(RANKS), "rank")
    found = found.withColumn("mark", mark).withColumn("dept_no", F.sum(F.when(F.col("mark") == "department", 1).otherwise(0)).over(upto))
    in_dept = Window.partitionBy("doc", "dept_no").orderBy("line_no")
    sofar = in_dept.rowsBetween(Window.unboundedPreceding, 0)
    # the line after a head mark is a name whatever it looks like, and begins no profile
    found = found.withColumn("head_name", F.lag("mark").over(in_dept) == "head").withColumn("head_name", F.coalesce("head_name", F.lit(False)))
    person = x.rlike(NAME) & ~F.col("head_name") & (F.col("dept_no") > 0) & F.col("mark").isNull()
    begin = F.when(F.col("mark").isNotNull(), F.col("mark")).when(F.col("head_name"), "head_name").when(person, "person")
    found = found.withColumn("begin", begin)
    found = found.withColumn("block", F.sum(F.when(F.col("begin").isNotNull(), 1).otherwise(0)).over(sofar))
    value = lambda kind, v: F.last(F.when(F.col("begin") == kind, v), ignorenulls=True).over(sofar)
    kind = F.max("begin").over(Window.partitionBy("doc", "dept_no", "block"))
    found = found.withColumn("kind", kind).withColumn("department", value("department", department_name(F.regexp_extract(x, DEPARTMENT, 1)))).withColumn("designation", value("rank", T.title_case(x)))
    number = x.rlike(r"^[\d\s+\-()]+$") & (F.length(x) >= 5)
    mail = F.contains(x, F.lit("@")) | F.contains(x, F.lit("[at]"))
    head = found.filter(F.col("kind") == "head_name").groupBy("doc", "dept_no").agg(
        F.max(F.when(F.col("begin") == "head_name", x)).alias("hod_name"),
        F.max(F.when(F.col("begin").isNull() & number, T.normalize_phone(x))).alias("hod_phone"),
        F.max(F.when(F.col("begin").isNull() & mail, T.clean_email(x))).alias("hod_email"),
    )
    field = lambda name: F.max(F.when(F.startswith(x, F.lit(name)), T.strip(F.regexp_replace(x, rf"^{name}\s*:?", ""))))
    # a specialization goes on over the lines behind it up to the next field
    part = Window.partitionBy("doc", "dept_no", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    field_no = F.sum(F.when(x.rlike(r"^(Phone|Email|Specialization|http|View Full Profile)") | mail | number, 1).otherwise(0)).over(part)
    people = found.filter(F.col("kind") == "person").withColumn("field_no", field_no)
    spec_no = F.max(F.when(F.startswith(x, F.lit("Specialization")), F.col("field_no"))).over(Window.partitionBy("doc", "dept_no", "block"))
    people = people.withColumn("in_spec", F.coalesce(F.col("field_no") == spec_no, F.lit(False)))
    spec = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("in_spec"), F.struct("line_no", F.regexp_replace(x, r"^Specialization\s*:?\s*", "").alias("t"))))), lambda s: s["t"]), " ")
    quality = F.min(F.when(F.col("begin").isNull() & ~F.col("in_spec") & x.rlike(r"^[A-Z]\.?[A-Za-z.,\s()]+$") & x.rlike(DEGREES), F.struct("line_no", x.alias("t"))))
    got = people.groupBy("doc", "dept_no", "block").agg(
        F.min("line_no").alias("line_no"), F.max(F.when(F.col("begin") == "person", x)).alias("raw"), F.max("department").alias("department"), F.max("designation").alias("designation"),
        quality.alias("q"), spec.alias("specialization"), T.normalize_phone(field("Phone")).alias("phone"), T.clean_email(field("Email")).alias("email"),
    )
    name = F.regexp_replace(T.collapse(F.regexp_replace("raw", r"^D\s+", "D. ")), r",+\z", "")
    out = got.join(head, ["doc", "dept_no"], "left").select("doc", "line_no", name.alias("name"), F.coalesce("designation", F.lit("Faculty")).alias("designation"), "department", F.col("q.t").alias("qualifications"), "specialization", "phone", "email", "hod_name", "hod_phone", "hod_email")
    is_hod = F.coalesce(same_person(F.col("name"), F.col("hod_name")), F.lit(False))
    if heads is not None:
        named = heads.select(F.col("department").alias("_d"), F.col("email").alias("_e")).distinct()
        out = out.join(named, (F.col("department") == F.col("_d")) & (F.col("email") == F.col("_e")), "left")
        is_hod = is_hod | F.col("_e").isNotNull()
    out = out.withColumn("is_hod", is_hod)
    return out.select("doc", "line_no", "name", "designation", "department", "qualifications", "specialization", "phone", "email", "is_hod", F.when(F.col("is_hod"), F.col("hod_phone")).alias("hod_phone"), F.when(F.col("is_hod"), F.col("hod_email")).alias("hod_email"))


def unique_profiles(profiles: DataFrame) -> DataFrame:
    """Of profiles with the same name and department the first."""
    return keep_first(profiles, [F.col("name"), F.col("department")], ["doc", "line_no"])


def profile_entities(name: Column, department: Column, specialization: Column, most: int = 3, is_hod: Column | None = None) -> Column:
    """Name, department, HOD for a head, and up to three specialisations, parted by comma, semicolon or slash."""
    special = F.filter(F.transform(F.split(F.coalesce(specialization, F.lit("")), "[,;/]"), T.strip), lambda s: s != "")
    head = F.array_compact(F.array(F.when(is_hod, F.lit("HOD")))) if is_hod is not None else F.array().cast("array<string>")
    return F.concat(F.array_compact(F.array(name, department)), head, F.slice(special, 1, most))


def profile_title() -> Column:
    return F.concat(F.lit("Profile of "), F.col("name"), F.when(F.col("is_hod"), F.lit(", HOD of ")).otherwise(F.lit(", ")), F.col("department"))


def render_profile() -> Column:
    """A profile row as text; fields without a value are left out, and numbers that are only an area code."""
    line = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c))
    rank = F.when(F.col("is_hod"), F.concat(F.lit("Professor & Head of the Department ("), F.col("department"), F.lit(")"))).otherwise(F.col("designation"))
    phone, email = T.either(F.col("hod_phone"), F.col("phone")), T.either(F.col("hod_email"), F.col("email"))
    contacts = F.array_compact(F.array(line("Phone: ", F.when(~phone.isin(AREA_CODES), phone)), line("Email: ", email)))
    contact = F.when(F.size(contacts) > 0, F.concat(F.lit("**Contact**:\n- "), F.array_join(contacts, "\n- ")))
    return F.concat_ws(
        "\n", line("**Name**: ", F.col("name")), line("**Designation**: ", rank), line("**Qualifications**: ", F.col("qualifications")),
        line("**Specialization**: ", F.col("specialization")), contact, line("**Department**: ", F.col("department")),
    )


def rosters(profiles: DataFrame) -> DataFrame:
    """One row a department: members in order, each once, its head, a table of them as text."""
    member = F.struct("doc", "line_no", "name", "designation")
    got = profiles.groupBy("department").agg(F.array_sort(F.collect_list(member)).alias("ms"), F.min(F.when(F.col("is_hod"), member)).alias("h"))
    unique = F.array_distinct(F.transform("ms", lambda m: F.struct(m["name"].alias("name"), m["designation"].alias("designation"))))
    got = got.select("department", unique.alias("members"), F.col("h.name").alias("head"))
    table = F.array_join(F.transform("members", lambda m: F.concat(F.lit("| "), m["name"], F.lit(" | "), m["designation"], F.lit(" |"))), "\n")
    head = F.when(F.col("head").isNotNull(), F.concat(F.lit("**Head of Department**: "), F.col("head"), F.lit(" (HOD)\n\n"))).otherwise("")
    content = F.concat(F.lit("## Department of "), F.col("department"), F.lit(" — Faculty Roster\n\n"), head, F.lit("**Faculty Members**:\n\n| Name | Designation |\n|------|-------------|\n"), table, F.lit("\n\n**Total Faculty**: "), F.size("members").cast("string"))
    return got.withColumn("n_members", F.size("members")).withColumn("content", content)
