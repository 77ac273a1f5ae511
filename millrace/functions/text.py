"""Text functions from Column to Column: cleaning, titles, words and sentences.

Classes such as \\s and \\d are ASCII, as in Spark. Null in, null out, if nothing else is said.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import lexicons as lex

REFERENCES = [r"(?i)\bas mentioned (above|earlier|previously)\b", r"(?i)\bas per above\b"]


def _drop(text: Column, patterns: Iterable[str]) -> Column:
    for p in patterns:
        text = F.regexp_replace(text, p, "")
    return text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse(text: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip(text: Column) -> Column:
    """Without white space at the ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def plain_typography(text: Column) -> Column:
    """Typographic marks as plain ones; a text of ASCII is not searched for them."""
    def replaced(t: Column) -> Column:
        for old, new in lex.TYPOGRAPHY:
            t = F.replace(t, F.lit(old), F.lit(new))
        return t

    return let(text, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(replaced(t)))


def words(text: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def count_of(text: Column, part: str) -> Column:
    """How often a literal occurs, without overlap."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def sentences(text: Column, min_chars: int = 20) -> Column:
    """Sentences longer than min_chars, split behind . ! or ? before white space."""
    parts = F.transform(F.split(collapse(text), r"(?<=[.!?])\s+"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: F.length(x) > min_chars)


def is_upper(text: Column) -> Column:
    """Has cased letters, all of them capitals."""
    return (F.upper(text) == text) & (F.lower(text) != text)


def is_title(text: Column) -> Column:
    """Every run of letters begins with a capital and goes on in small letters (A-Z)."""
    return text.rlike("[A-Z]") & ~text.rlike("(^|[^A-Za-z])[a-z]") & ~text.rlike("[A-Za-z][A-Z]")


def title_case(text: Column) -> Column:
    """A capital after every character that is no letter, small letters else."""
    marked = F.regexp_replace(F.lower(text), r"([^a-z]|^)([a-z])", "$1\u0001$2")
    parts = F.split(marked, "\u0001")
    first = F.element_at(parts, 1)
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.concat(first, F.array_join(F.transform(rest, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))), ""))


def clean_regulation(text: Column) -> Column:
    """Page numbers and table marks out, lines with a letter or more than two words kept, one line, plain quotes."""
    marks = [r"(?i)Page\s+\d+\s+of\s+\d+", r"(?i)Page\s+\d+", r"(?i)Table\s+\d+", r"(?i)Figure\s+\d+"]
    # a mark ends in e, white space and a digit: one search for that spares most texts those for the four marks
    t = let(_drop(text, [r"(?m)^\d+$"]), lambda x: F.when(x.rlike(r"\s\d(?<=[eE\s]\s\d)"), _drop(x, marks)).otherwise(x))
    lines = F.transform(F.split(t, "\n"), strip)
    kept = F.filter(lines, lambda x: (x != "") & (x.rlike("[A-Za-z]") | (word_count(x) > 2)))
    # lines without white space at their ends, joined by a space, are collapsed unless there is more white space in one
    one = let(F.array_join(kept, " "), lambda x: F.when(F.contains(x, F.lit("  ")) | x.rlike(r"[\t\x0B\f\r]"), collapse(x)).otherwise(x))
    return F.trim(plain_typography(one))


def clean_institutional(text: Column, running_header: str | None = None) -> Column:
    """Digit lines and page marks out, lines from a running header's name to their end out, one line."""
    patterns = [r"(?m)^\d+$", r"(?i)Page\s+\d+\s+of\s+\d+"]
    if running_header:
        patterns.append(rf"(?i){re.escape(running_header)}.*?\n")
    return F.trim(plain_typography(collapse(_drop(text, patterns))))


def reduce_noise(text: Column) -> Column:
    """Rules of dashes and vague cross-references out."""
    return collapse(_drop(text, [r"-{3,}", r"_{3,}", *REFERENCES, r"(?i)\brefer to (table|figure|section)\s+\d+\b"]))


def remove_noise(text: Column) -> Column:
    """Page marks, fractions and rules out."""
    return strip(_drop(text, [r"(?i)\bPage \d+ of \d+\b", r"\b\d+/\d+\b", r"-{3,}", r"_{3,}"]))


def remove_references(text: Column, title: Column) -> Column:
    """"This section" becomes "the <title> section"; programs and courses alike; cross-references out.

    A title's dollar signs and backslashes are literal."""
    safe = F.replace(F.replace(F.coalesce(title, F.lit("this section")), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    t = F.regexp_replace(text, F.lit(r"(?i)\bthis section\b"), F.concat(F.lit("the "), safe, F.lit(" section")))
    t = F.regexp_replace(t, r"(?i)\bthis program\b", "the program")
    t = F.regexp_replace(t, r"(?i)\bthis course\b", "the course")
    return collapse(_drop(t, [*REFERENCES, r"(?i)\brefer to (table|figure|section) \d+\b"]))


def normalize_bullets(text: Column) -> Column:
    t = F.regexp_replace(text, r"(?m)^[•●○►▪▫-]\s+", "• ")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def clean_record(text: Column, title: Column) -> Column:
    """The three steps above in order, as record cleanup applies them."""
    return normalize_bullets(remove_references(remove_noise(text), title))


def clean_ocr(text: Column) -> Column:
    """Web artifacts out, degree abbreviations repaired in the fixed order, blank runs shortened."""
    t = _drop(text, lex.WEB_ARTIFACTS)
    for old, new in lex.OCR_REPAIRS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return strip(F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def clean_email(email: Column) -> Column:
    t = F.replace(F.replace(email, F.lit("[at]"), F.lit("@")), F.lit("[dot]"), F.lit("."))
    return F.regexp_replace(F.regexp_replace(t, r"\s+", ""), r"[,.]+\z", "")


def normalize_phone(phone: Column) -> Column:
    t = F.regexp_replace(strip(phone), r"[^\d+\-() ]", "")
    return F.when(t == "413", F.concat(F.lit("0413-"), t)).otherwise(t)


def normalize_section_title(title: Column) -> Column:
    """A regulation's section title: numbering off, glued words apart, open brackets cut, canonical forms, capitals.

    Unlike a plain prefix test, numbering needs a delimiter, and real words that begin like a glued one stay
    whole. Five characters or less give an empty title."""
    t = F.regexp_replace(title, r"^\s*(\d+[.)]?\s+|\d+[.)]|[IVXivx]+[.)]\s*|[IVX]+\s+(?=[A-Z]))", "")
    t = F.regexp_replace(t, r"([a-z])([A-Z])", "$1 $2")
    t = F.regexp_replace(t, r"([A-Z]{2,})([A-Z][a-z])", "$1 $2")
    whole = "|".join(lex.WHOLE_WORDS)
    for word in ("THE", "OF", "FOR", "AND"):
        t = F.regexp_replace(t, rf"\b(?!(?:{whole})\b){word}([A-Z])", f"{word} $1")
    # each step that uses a title more than once has it computed once
    t = let(t, lambda x: F.when(F.contains(x, F.lit("(")) & ~F.contains(x, F.lit(")")), F.regexp_replace(x, r"(?s)\s*\(.*", "")).otherwise(x))
    t = F.regexp_replace(t, r"[()]", "")

    def canonical(upper: Column) -> Column:
        out = upper
        for variant, form in reversed(lex.CANONICAL_TITLES.items()):
            out = F.when(F.contains(upper, F.lit(variant)), F.lit(form.upper())).otherwise(out)
        return out

    t = let(F.upper(t), canonical)
    t = strip(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"[^\w\s]\z", ""))
    return let(t, lambda x: F.when(F.length(x) <= 5, "").otherwise(x))


def complete_title(title: Column, content: Column) -> Column:
    """A short title that ends in FOR, OF, AND or THE takes up to five words of the content's first sentence."""
    upper = F.upper(title)
    dangling = F.endswith(upper, F.lit(" FOR")) | F.endswith(upper, F.lit(" OF")) | F.endswith(upper, F.lit(" AND")) | F.endswith(upper, F.lit(" THE"))
    fixed = title.rlike(r"\d")
    for word in lex.UNFIXABLE_TITLE_WORDS:
        fixed = fixed | F.contains(upper, F.lit(word))
    first = F.lit(None).cast("string")
    for end in ("\n", "! ", "? ", ". "):  # the last wins
        first = F.when(F.contains(content, F.lit(end)), F.substring_index(content, end, 1)).otherwise(first)
    # let, not nullif: Spark works out what nullif takes for every row, a title that lacks nothing needs no content
    some = let(strip(first), lambda x: F.coalesce(F.when(x != "", x), strip(content)))
    longer = strip(F.concat(title, F.lit(" "), F.array_join(F.slice(words(some), 1, 5), " ")))
    return F.when((F.length(title) < 25) & dangling & ~fixed, let(longer, lambda x: F.when(F.length(x) <= 80, x).otherwise(title))).otherwise(title)


def complete_eligibility(title: Column, program: Column, file: Column, content: Column, by_content: bool = False, by_file: str | None = None) -> Column:
    """Two optional repairs of the exact title ELIGIBILITY FOR, both off as a rule: for a known program, a file
    of regulations and content on admissions; or for one named MCA file."""
    t, cut, whole = title, title == "ELIGIBILITY FOR", "ELIGIBILITY FOR ADMISSION"
    if by_content:
        known = (F.coalesce(program, F.lit("")) != "") & (program != "Unknown") & F.contains(file, F.lit("Regulations"))
        t = F.when(cut & known & F.lower(content).rlike("admission|programme|candidate|eligibility"), whole).otherwise(t)
    if by_file:
        t = F.when(cut & (program == "MCA") & (file == by_file), whole).otherwise(t)
    return t


def clean_title_candidate(raw: Column) -> Column:
    """A generated title without quotes, a leading "title:" and runs of white space."""
    t = F.regexp_replace(strip(raw), r"^[\"']+|[\"']+\z", "")
    return collapse(F.regexp_replace(t, r"(?i)^title\s*:?\s*", ""))


def preview(text: Column, chars: int = 220) -> Column:
    return F.substring(collapse(F.coalesce(text, F.lit(""))), 1, chars)


def page_range(first: Column, last: Column) -> Column:
    """"N/A" without pages, one number for one page, else first-last."""
    return F.when(first.isNull(), "N/A").when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def either(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def render_admin(title: Column, content: Column, most: int = 8000) -> Column:
    """Title and content; a longer document is cut and marked."""
    doc = F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(content, F.lit("")))
    return F.when(F.length(doc) > most, F.concat(F.substring(doc, 1, most), F.lit("..."))).otherwise(doc)


def render_institutional(category: Column, title: Column, entities: Column, content: Column) -> Column:
    """Lines of category, title, up to eight entities and content; lines without a value are left out."""
    line = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{name}: "), value))
    return F.concat_ws("\n", line("Category", category), line("Title", title), line("Entities", F.array_join(F.slice(entities, 1, 8), ", ")), line("Content", content))
