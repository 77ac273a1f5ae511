from pyspark.sql import functions as F

from millrace.functions import classify as C

PROSE = "Admission to the programme needs an application process and eligibility under the admission criteria set each year."


def test_expected_categories(apply):
    got = apply(C.infer_category, PROSE, "The tuition fee and hostel fee payment, with scholarship refund, is due each term.", "short fee", "Nothing of the sort is said in this sentence.")
    assert got == ["admission", "fees", "", ""]


def test_phrase_counts_add_up_by_keyword(apply):
    assert apply(lambda c: C.category_scores(c, {"a": ["seat", "seat allocation"]})["a"], "Seat allocation and seats, seat.") == [3]


def test_mixed_needs_more_than_three(apply):
    lexicon = {c: [c] for c in ("aa", "bb", "cc", "dd")}
    mixed = lambda c: C.has_mixed_categories(c, F.lit("aa"), lexicon)
    assert apply(mixed, "aa bb cc", "aa bb cc dd", "bb cc dd") == [False, True, False]


def test_titles_tie_to_the_greater(apply):
    rules = [("Alpha", ["one"]), ("Beta", ["two"])]
    assert apply(lambda c: C.infer_title(c, rules), "one two", "one", "fee and tuition", "nothing at all") == ["Beta", "Alpha", "Fees Information", "Institutional Information"]


def test_routing_is_by_substring_unless_asked(apply):
    assert apply(C.route_query, "Which clubs are available?", "exam dates", "hostel rooms", "hi") == ["syllabus", "admin", "institutional", "unknown"]
    assert apply(lambda c: C.route_query(c, whole_words=True), "Which clubs are available?") == ["unknown"]


def test_headers(apply):
    lines = ["ELIGIBILITY FOR ADMISSION", "Award Of Grades", "Total 40 HOURS", "COURSE", "1. ELIGIBILITY", "the eligibility rules", "COURSE CODE POLICY", "FEES & OTHER RULES", "GENERAL 1.1 CONDUCT NOTE"]
    assert apply(C.is_header, *lines) == [True, True, False, False, False, False, False, True, False]


def test_bad_and_valid_titles(apply):
    assert apply(C.is_bad_title, None, "Overview", "Some General Information here", "two words", "three good words") == [True, True, True, True, False]
    assert apply(C.is_valid_title, "x", "6-12 words", "general information", "Hostel rules", " ".join(["w"] * 13), None) == [False, False, False, True, False, False]


def test_scope(apply):
    assert apply(C.program_scope, "through the year", "nothing", "MBA and PhD") == [["b.tech"], ["ALL"], ["mba", "phd"]]
    assert apply(lambda c: C.program_scope(c, whole_words=True), "through the year") == [["ALL"]]


def test_sections_years_programs(apply):
    assert apply(C.section_category, "AWARD OF GRADES", "ELIGIBILITY", "CONDUCT") == ["GRADING", "ELIGIBILITY", "GENERAL"]
    assert apply(C.regulation_year, "Regulations: 2021", "of 2021-22", "none") == ["2021", "2021-22", None]
    assert apply(lambda t, f: C.majority_program(t, f), ("M.Tech and B.Tech, B Tech", "x"), ("Ph.D rules", "x"), ("none", "MCA_rules.pdf"), ("none", "x")) == ["B.Tech", "Ph.D", "MCA", "Unknown"]
    assert apply(C.regulation_name, ("short\nREGULATIONS OF THE YEAR\n", "f"), ("x", "my_file-a.pdf")) == ["REGULATIONS OF THE YEAR", "my file a"]


def test_chunk_issues(apply):
    good = "A calm text about one topic only. " * 8
    got = apply(C.chunk_issues, good[:199], good[:200], "x" * 801, "y" * 200 + "\n- a\n- b\n- c\n- d", "admission and fee " + "z" * 200, "admission fee " + "z" * 200, " ")
    assert got[0][0] == "Too short (199 < 200 chars)"
    assert [i for i in got[1] if "Too" in i] == []
    assert got[2] == ["Too long (801 > 800 chars)"]
    assert got[3] == ["Too many bullet points (4 > 3)"]
    assert got[4] == ["Mixed topics detected: 'admission' and 'fee'"]
    assert got[5] == []
    assert got[6][-1] == "Empty or whitespace-only content"


def test_similar_sentences_against_brute_force(apply):
    import random
    import re

    rng = random.Random(5)
    texts = [". ".join(" ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 6))) for _ in range(60)]

    def slow(t):
        s = [set(x.lower().split()) for x in re.split("[.!?]", t)]
        s2 = [x for x in s if len(x) > 5]
        return len(s) > 2 and any(len(a & b) * 2 > min(len(a), len(b)) for i, a in enumerate(s2) for b in s2[i + 1 :])

    assert apply(C.similar_sentences, *texts) == [slow(t) for t in texts]


def test_record_errors_and_flags(apply):
    assert apply(C.institutional_errors, ("i", "c", "t", "long enough", "s"), (None, " ", "t", "x", "s")) == [[], ["ako_id", "category", "content"]]
    assert apply(lambda u, o, b, n, c: C.course_flags(u.cast("int"), o.cast("int"), b.cast("int"), n, c.cast("int")), ("1", "1", "1", "Name", "3"), ("0", None, "1", "Theory of", "0")) == [[], ["NO_UNITS", "NO_OUTCOMES", "TRUNCATED_NAME", "ZERO_CREDITS"]]
    assert apply(C.sanitize_credits, (4, 0, 0, 0), (99, 3, 1, 0), (99, 30, 1, 0), types="int") == [4, 4, 0]
    assert apply(lambda r, m: C.margin_class(r.cast("boolean"), m.cast("double")), ("false", "1"), ("true", "0.01"), ("true", "0.07"), ("true", "0.1")) == ["WRONG_DB", "WEAK_SEPARATION", "MODERATE_MATCH", "GOOD_MATCH"]


def test_programs_and_years_by_one_search(apply):
    """Mentions at each other's edges are told apart as by a search for each program; a later year pattern counts if earlier ones fail."""
    texts = ["MBA MCA mca", "Ph.D.x and phd; Ph. D", "M Tech M.Sc m.\nsc B.Techs", "xMBA MBAs", "B.Tech-MBA.MBA", "", None]
    assert apply(C.majority_program, *texts) == ["MCA", "Ph.D", "M.Sc", "Unknown", "MBA", "Unknown", "Unknown"]
    assert apply(C.regulation_year, "Regulation: 2019 effective from 2021-22", "Effective from : 202021", "regulations 2018", "in 2017", "none", None) == ["2021-22", "202021", "2018", None, None, None]
