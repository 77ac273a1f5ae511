from pyspark.sql import functions as F

from millrace.functions import text as T


def test_clean_regulation_drops_marks_and_symbol_lines(apply):
    got = apply(T.clean_regulation, "12\nPage 3 of 9\n• Rule  one\n--\n1 2 3\nTable 4 It’s “so”—yes…", "", None)
    assert got == ["• Rule one 1 2 3 It's \"so\"-yes...", "", None]


def test_clean_institutional_running_header(apply):
    assert apply(lambda c: T.clean_institutional(c, "Some University"), "some university, page\nBody  text\n7\nEnd") == ["Body text End"]


def test_noise_and_references(apply):
    assert apply(T.reduce_noise, "A --- b ___ as mentioned above refer to table 3 c") == ["A b c"]
    assert apply(T.remove_noise, " Page 1 of 2 on 3/4 day ---- ") == ["on  day"]
    assert apply(T.remove_references, ("See this section, this Course.", "A$1\\b"), ("x", None)) == ["See the A$1\\b section, the course.", "x"]


def test_bullets_after_collapse_touch_only_the_start(apply):
    assert apply(T.clean_record, ("● one\n● two", "t")) == ["• one ● two"]


def test_ocr_repairs_keep_their_order(apply):
    assert apply(T.clean_ocr, "MsSc. MsSc Byech. Read More x\n\n\n\ny  z") == ["M.Sc. M.Sc B.Tech. x\n\ny z"]


def test_email_and_phone(apply):
    assert apply(T.clean_email, " a [at] b [dot] in., ") == ["a@b.in"]
    assert apply(T.normalize_phone, "413", "0413-265 x", "4130") == ["0413-413", "0413-265 ", "4130"]


def test_titles(apply):
    got = apply(T.normalize_section_title, "3. AWARD OFGRADES", "INTERNAL ASSESSMENT", "IV. OFFICE FORMAT (see", "ELIGIBILITY FORADMISSION", "DURATION OF THEPROGRAMME:", "ABC", "10 FORCANDIDATES RULES")
    assert got == ["AWARD OF GRADES", "INTERNAL ASSESSMENT", "OFFICE FORMAT", "ELIGIBILITY FOR ADMISSION", "DURATION OF THE PROGRAMME", "", "FOR CANDIDATES RULES"]
    assert apply(T.complete_title, ("RULES FOR", "All students of the first year must. More"), ("DURATION OF", "x. y"), ("A LONG ENOUGH TITLE THAT STAYS OF", "x"), ("WORK OF", "line\nnext")) == [
        "RULES FOR All students of the first", "DURATION OF", "A LONG ENOUGH TITLE THAT STAYS OF", "WORK OF line",
    ]


def test_case_tests_and_title_case(apply):
    assert apply(T.is_title, "Hello World", "Hello world", "HELLO", "3 Days", "B.Tech") == [True, False, False, True, True]
    assert apply(T.is_upper, "ABC 1", "123", "Ab") == [True, False, False]
    assert apply(T.title_case, "b.tech in cse", "it's") == ["B.Tech In Cse", "It'S"]


def test_sentences_and_words(apply):
    assert apply(T.sentences, "Short one. This is a sentence of some length! And here is another one of them? No.") == [["This is a sentence of some length!", "And here is another one of them?"]]
    assert apply(T.word_count, "", " a  b\n", None) == [0, 2, 0]
    assert apply(lambda c: T.count_of(c, "aa"), "aaaa aa", "") == [3, 0]


def test_page_range_and_previews(apply):
    assert apply(T.page_range, (None, None), (3, 3), (3, 9), types="int") == ["N/A", "3", "3-9"]
    assert apply(lambda c: T.preview(c, 5), "a  b c d", None) == ["a b c", ""]
    assert apply(T.render_admin, ("t", "x" * 9000))[0].endswith("x...") and len(apply(T.render_admin, ("t", "x" * 9000))[0]) == 8003
    assert apply(lambda a, b, c: T.render_institutional(a, b, F.array(F.lit("e")), c), ("k", None, "text")) == ["Category: k\nEntities: e\nContent: text"]


def test_title_candidates(apply):
    assert apply(T.clean_title_candidate, '"Title: Some  name"', "'x'") == ["Some name", "x"]


def test_searches_that_are_spared_change_nothing(apply):
    """Texts with and without marks, odd white space and typography are cleaned as by plain searches for each."""
    import re

    from millrace import lexicons as lex

    def clean(t):
        for p in (r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+", r"(?i)Page\s+\d+", r"(?i)Table\s+\d+", r"(?i)Figure\s+\d+"):
            t = re.sub(p, "", t, flags=re.A)
        kept = [x for x in (x.strip(" \t\n\x0b\f\r") for x in t.split("\n")) if x and (re.search("[A-Za-z]", x) or len(x.split()) > 2)]
        t = re.sub(r"[ \t\n\x0b\f\r]+", " ", "\n".join(kept)).strip(" ")
        for old, new in lex.TYPOGRAPHY:
            t = t.replace(old, new)
        return t.strip(" ")

    texts = ["a page 1 of 2 b", "PAGE \t\n 7\nx", "tabTable 1le 5 figure\t3", "rule 5, tree 6", "\x0b a  b\tc \r\n12\n1 2\n1 2 3", "Page\n12\n13\nz", "\u201cq\u201d \u2013 \u2026", "\u00e9 \u2019", "", "plain words"]
    assert apply(T.clean_regulation, *texts) == [clean(t) for t in texts]
    assert apply(T.strip, " \t\n\x0b\f\r a b\u00a0\r\n", "", None, " \n", "\u2003x ") == ["a b\u00a0", "", None, "", "\u2003x"]
