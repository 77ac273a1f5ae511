from pyspark.sql import functions as F

from millrace.operators import courses as K
from millrace.operators import faculty as P

SYLLABUS = """B.Tech syllabus, Regulations: 2020-21
Course Code Course Name L T P
CSU101 Data Structures and
Department: CSE Semester : III  3 - 1 - 0
Course Objectives:
1. To study the basic structures of data
2. To analyse algorithms in depth
Course Outcomes:
CO1 Explain lists CO2 Apply trees CO10 Build graphs
UNIT I : Data Structures and Lists Periods: 9
Arrays; linked lists - stacks and queues
CO1
UNIT II
Trees and Heaps
Periods : 8
1. Binary trees, heaps CO10, CO2
Reference Books
1. Some Author, Data Structures and Algorithms, Press
2. Another Author, Trees in Practice
CO-PO Mapping
Course Code Course Name L T P
CSU102 Programming Laboratory
Credits: 2
"""


def test_course_extraction(spark):
    docs = spark.createDataFrame([("ug_btech_cse.pdf", SYLLABUS), ("none.pdf", "nothing"), ("null.pdf", None)], "doc string, text string")
    a, b = K.extract_courses(docs).orderBy("section_no").collect()
    assert (a.program, a.degree_level, a.department, a.regulation_year, a.course_code, a.course_name, a.semester) == ("B.Tech", "UG", "CSE", "2020-21", "CSU101", "Data Structures and", "3")
    assert a.credits.asDict() == {"lecture": 3, "tutorial": 1, "practical": 0, "total": 4}
    assert a.course_objectives == ["To study the basic structures of data", "To analyse algorithms in depth"]
    assert [tuple(o) for o in a.course_outcomes] == [("CO1", "Explain lists"), ("CO2", "Apply trees"), ("CO10", "Build graphs")]
    one, two = a.units
    assert (one.unit_number, one.unit_title, one.hours, one.mapped_course_outcomes) == ("I", "Data Structures and Lists", 9, ["CO1"])
    assert (two.unit_number, two.unit_title, two.hours, two.mapped_course_outcomes) == ("II", "Trees and Heaps", 8, ["CO10", "CO2"])
    # of two marks at the end the last is taken off
    assert two.topics == ["Binary trees", "Heaps co10"]
    assert len(a.textbook_references) == 2 and a.textbook_references[0].startswith("Some Author")
    assert (b.course_code, b.course_name, b.units, b.credits.total) == ("CSU102", "Programming Laboratory", [], 2)


def test_bare_codes_and_pages(spark):
    docs = spark.createDataFrame([("pg_mtech_ece", "ABC123 First Course\nx\nABC124 Second Course\ny")], "doc string, text string")
    got = K.extract_courses(docs)
    assert [(r.course_code, r.degree_level, r.department) for r in got.orderBy("section_no").collect()] == [("ABC123", "PG", "ECE"), ("ABC124", "PG", "ECE")]
    pages = spark.createDataFrame([("pg_mtech_ece", 1, "ABC123 x"), ("pg_mtech_ece", 4, "ABC123 y"), ("other", 2, "ABC124")], "doc string, page_num int, text string")
    assert {r.course_code: r.page_range for r in K.course_pages(got, pages).collect()} == {"ABC123": "1-4", "ABC124": "N/A"}


def test_name_repair_and_titles(spark):
    df = spark.createDataFrame(
        [("Data Structures and", ["DATA STRUCTURES AND LISTS"], ["x"]), ("Theory of", [], ["A. Author, Theory of Machines, Press"]), ("Design for", [], ["none"]), ("Whole Name", [], [])],
        "n string, u array<string>, r array<string>",
    )
    got = [r.x for r in df.select(K.repair_name(F.col("n"), F.col("u"), F.col("r")).alias("x")).collect()]
    assert got == ["Data Structures And Lists", "Theory of Machines", "Design for [NEEDS REVIEW]", "Whole Name"]
    titles = df.select(K.render_title(F.lit("C1"), F.lit("DBMS NAME [NEEDS REVIEW]"), F.lit("B.Tech"), F.lit("3")).alias("x")).first().x
    assert titles == "C1 – DBMS NAME (B.Tech, Sem 3)"


FACULTY = """DEPARTMENT OF COMPUTER SCIENCE AND ENGINEERING
Head of the Department
Dr. A. Example
413
head[at]site[dot]edu
PROFESSOR
Dr. A. Example
M.Tech., Ph.D
Specialization : Networks,
Security
Phone : 0413-222
Email : ae [at] site.edu,
--- PAGE 2 ---
ASSOCIATE PROFESSOR
Ms. B. Person
Specialization: Data
DEPARTMENT OF PHYSICS
Mr. C. Other
"""


def test_faculty(spark):
    docs = spark.createDataFrame([("f", FACULTY)], "doc string, text string")
    got = P.faculty_profiles(docs).orderBy("line_no").collect()
    a, b, c = got
    assert (a.name, a.designation, a.department, a.qualifications, a.specialization, a.phone, a.email, a.is_hod, a.hod_phone, a.hod_email) == (
        "Dr. A. Example", "Professor", "Computer Science and Engineering", "M.Tech., Ph.D", "Networks, Security", "0413-222", "ae@site.edu", True, None, "head@site.edu",
    )
    assert (b.name, b.designation, b.specialization, b.is_hod) == ("Ms. B. Person", "Associate Professor", "Data", False)
    assert (c.name, c.designation, c.department, c.is_hod) == ("Mr. C. Other", "Faculty", "Physics", False)
    heads = spark.createDataFrame([("Computer Science and Engineering", "ae@site.edu")], "department string, email string")
    roster = {r.department: r for r in P.rosters(P.faculty_profiles(docs, heads)).collect()}
    assert roster["Computer Science and Engineering"].head == "Dr. A. Example" and roster["Computer Science and Engineering"].n_members == 2
    assert "| Ms. B. Person | Associate Professor |" in roster["Computer Science and Engineering"].content and roster["Physics"].head is None
    text = P.faculty_profiles(docs).filter("is_hod").select(P.render_profile().alias("t"), P.profile_entities(F.col("name"), F.col("department"), F.col("specialization")).alias("e")).first()
    assert "**Designation**: Professor & Head" in text.t and text.e[2:] == ["Networks", "Security"]
