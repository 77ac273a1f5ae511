"""Classification and quality predicates from Column to Column. Word lists are parameters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import lexicons as lex
from millrace.functions import text as T


def _total(columns: Sequence[Column]) -> Column:
    out = F.lit(0)
    for c in columns:
        out = out + c
    return out


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def whole_word_hits(text: Column, word: str) -> Column:
    """Occurrences of a word or phrase between word boundaries, in lower case."""
    return F.regexp_count(F.lower(text), F.lit(rf"\b{re.escape(word)}\b"))


def category_scores(text: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS) -> dict[str, Column]:
    """For each category the whole-word occurrences of its keywords, added up keyword by keyword.

    Single words can't overlap each other, so one scan counts them all; phrases are counted one by one."""
    out = {}
    for c, ws in lexicon.items():
        singles = [w for w in dict.fromkeys(ws) if re.fullmatch(r"\w+", w)]
        parts = [F.regexp_count(F.lower(text), F.lit(rf"\b({'|'.join(map(re.escape, singles))})\b"))] if singles else []
        out[c] = _total(parts + [whole_word_hits(text, w) for w in dict.fromkeys(ws) if w not in singles])
    return out


def keywords_found(text: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS) -> Column:
    """An array with the number of each category's keywords that occur as whole words, in the lexicon's order.

    One scan of the text finds the different single words of all categories; phrases are looked for one by one."""
    single = [w for w in dict.fromkeys(w for ws in lexicon.values() for w in ws) if re.fullmatch(r"\w+", w)]
    pattern = rf"\b({'|'.join(map(re.escape, single))})\b"

    def counts(low: Column) -> Column:
        seen = F.array_distinct(F.regexp_extract_all(low, F.lit(pattern), F.lit(1))) if single else _strings([])

        def of(words: Column) -> Column:
            each = []
            for ws in lexicon.values():
                phrases = [low.rlike(rf"\b{re.escape(w)}\b").cast("int") for w in dict.fromkeys(ws) if w not in single]
                each.append(_total([F.size(F.array_intersect(words, _strings([w for w in dict.fromkeys(ws) if w in single]))), *phrases]))
            return F.array(*each)

        return T.let(seen, of)

    return T.let(F.lower(text), counts)


def infer_category(text: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS, priority: Sequence[str] = tuple(lex.CATEGORY_PRIORITY), min_chars: int = 20) -> Column:
    """The category with the most whole-word hits, ties by priority; empty without a hit or for a short text."""
    scores = category_scores(text, lexicon)
    ranked = [c for c in priority if c in scores] + [c for c in scores if c not in priority]
    best = F.array_max(F.array(*[F.struct(scores[c].alias("s"), F.lit(-i).alias("p"), F.lit(c).alias("c")) for i, c in enumerate(ranked)]))
    return F.when(F.length(text) >= min_chars, T.let(best, lambda b: F.when(b["s"] > 0, b["c"]).otherwise(F.lit("")))).otherwise(F.lit(""))


def has_mixed_categories(text: Column, primary: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS, most: int = 3, ratio: float = 0.65) -> Column:
    """More than `most` categories occur, and the primary doesn't, or another has `ratio` of its keywords."""
    return mixed_by(keywords_found(text, lexicon), primary, lexicon, most, ratio)


def mixed_by(found: Column, primary: Column, lexicon: Mapping[str, Sequence[str]], most: int = 3, ratio: float = 0.65) -> Column:
    """`has_mixed_categories` on a column of `keywords_found`, for callers that use it more than once."""
    names = _strings(list(lexicon))

    def judge(x: Column) -> Column:
        present = F.size(F.filter(x, lambda h: h > 0))
        own = F.coalesce(F.try_element_at(x, F.nullif(F.array_position(names, primary).cast("int"), F.lit(0))), F.lit(0))
        rival = F.exists(F.zip_with(names, x, lambda c, h: (c != primary) & (h >= ratio * own)), lambda r: r)
        return (present > most) & ((own == 0) | rival)

    return T.let(found, judge)


def secondary_categories(text: Column, primary: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS) -> Column:
    """The other categories with a whole-word hit, in the lexicon's order."""
    return secondary_by(keywords_found(text, lexicon), primary, lexicon)


def secondary_by(found: Column, primary: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """`secondary_categories` on a column of `keywords_found`."""
    return F.array_compact(F.zip_with(_strings(list(lexicon)), found, lambda c, h: F.when((h > 0) & (primary != c), c)))


def dominant_category(text: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS, default: str = "general") -> Column:
    """The category with most different keywords as substrings, the first of equals."""
    low = F.lower(text)
    hits = {c: _total([F.contains(low, F.lit(w)).cast("int") for w in ws]) for c, ws in lexicon.items()}
    best = F.array_max(F.array(*[F.struct(h.alias("s"), F.lit(-i).alias("p"), F.lit(c).alias("c")) for i, (c, h) in enumerate(hits.items())]))
    return T.let(best, lambda b: F.when(b["s"] > 0, b["c"]).otherwise(F.lit(default)))


def mixed_topics(text: Column, lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS, least: int = 2) -> Column:
    """Categories whose keywords occur `least` times or more as substrings; mixed if more than one."""

    def often(low: Column) -> Column:
        return F.array_compact(F.array(*[F.when(_total([T.count_of(low, w) for w in ws]) >= least, F.lit(c)) for c, ws in lexicon.items()]))

    return T.let(F.lower(text), often)


def infer_title(text: Column, rules: Sequence[tuple[str, Sequence[str]]] = tuple(lex.TITLE_RULES), lexicon: Mapping[str, Sequence[str]] = lex.CATEGORY_KEYWORDS, default: str = lex.DEFAULT_TITLE) -> Column:
    """The rule title with most keywords in the first ten sentences, ties to the greater title; else the first
    category with two keywords; else a default."""
    sample = F.lower(F.array_join(F.slice(F.split(text, "[.!?]+"), 1, 10), " "))
    best = F.array_max(F.array(*[F.struct(_total([F.contains(sample, F.lit(w)).cast("int") for w in ws]).alias("s"), F.lit(t).alias("t")) for t, ws in rules]))
    low, by_category = F.lower(text), F.lit(default)
    for c, ws in reversed(list(lexicon.items())):
        enough = _total([F.contains(low, F.lit(w)).cast("int") for w in ws]) >= 2
        by_category = F.when(enough, F.lit(c.replace("_", " ").title() + " Information")).otherwise(by_category)
    return T.let(best, lambda b: F.when(b["s"] >= 1, b["t"]).otherwise(by_category))


def program_scope(text: Column, programs: Mapping[str, Sequence[str]] = lex.PROGRAM_SCOPE, whole_words: bool = False) -> Column:
    """Programs of which a keyword occurs, as a substring or as a whole word; ["ALL"] if none."""
    low = F.lower(text)

    def any_of(ws: Sequence[str]) -> Column:
        out = F.lit(False)
        for w in ws:
            out = out | ((whole_word_hits(text, w) > 0) if whole_words else F.contains(low, F.lit(w)))
        return out

    found = F.array_compact(F.array(*[F.when(any_of(ws), F.lit(p)) for p, ws in programs.items()]))
    return F.when(F.size(found) == 0, F.array(F.lit("ALL"))).otherwise(found)


def section_category(title: Column) -> Column:
    """The category of a regulation's section by its title, the first rule that matches, else GENERAL."""
    upper, out = F.upper(title), F.lit("GENERAL")
    for name, ws in reversed(lex.SECTION_CATEGORIES):
        hit = F.lit(False)
        for w in ws:
            hit = hit | F.contains(upper, F.lit(w))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def route_query(query: Column, routes: Mapping[str, Sequence[str]] = lex.ROUTES, whole_words: bool = False) -> Column:
    """The index that a query belongs to by its keywords (substrings, unless whole words are asked for), the
    first route that matches, else unknown."""
    low, out = F.lower(query), F.lit("unknown")
    for name, ws in reversed(list(routes.items())):
        hit = F.lit(False)
        for w in ws:
            hit = hit | ((whole_word_hits(query, w) > 0) if whole_words else F.contains(low, F.lit(w)))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def is_header(line: Column, strong: Sequence[str] = tuple(lex.STRONG_HEADER_WORDS), weak: Sequence[str] = tuple(lex.WEAK_HEADER_WORDS)) -> Column:
    """Whether a line heads a section of a regulation.

    Ten characters and two words of letters at least, no units or symbols only, none of the rejected shapes, in
    capitals or title case. Then a strong keyword: the line begins with its first word, or is short and no
    sub-header; or a weak keyword in three words or more whose first three aren't all plain words."""
    def test(x: Column) -> Column:
        upper = F.upper(x)
        refused = x.rlike(r"^[()\d\s\-=.:/|]+$") | x.rlike(r"(?i)^(.*\d.*HOURS.*|\d.*MARKS.*|\d.*CREDITS.*|\d.*POINTS.*)$")
        for p in lex.NO_HEADER_PATTERNS:
            refused = refused | upper.rlike(p)
        alphabetic = F.regexp_count(x, F.lit(r"\b[A-Za-z]+\b")) >= 2
        plain = ~upper.rlike(r"\d+\.\d+") & ~F.lower(x).rlike(r"\([a-z]\)") & (T.count_of(upper, ".") <= 1)
        has_strong = F.lit(False)
        for w in strong:
            short = (F.length(upper) <= len(w) + 15) & plain
            has_strong = has_strong | (F.contains(upper, F.lit(w)) & (F.startswith(upper, F.lit(w.split()[0])) | short))
        has_weak = F.lit(False)
        for w in weak:
            has_weak = has_weak | F.contains(upper, F.lit(w))
        has_weak = has_weak & (T.word_count(x) >= 3) & ~x.rlike(r"^\w+\s+\w+\s+\w+")
        # the cheapest tests first: most lines are ordinary prose
        return (F.length(x) >= 10) & (T.is_upper(x) | T.is_title(x)) & (has_strong | has_weak) & alphabetic & ~refused

    return T.let(T.strip(line), test)


def is_rule_title(line: Column) -> Column:
    """Whether a line titles a section by the simple rules: ends in a colon, short title case, or a known start."""
    x, upper = T.strip(line), F.upper(T.strip(line))
    known = F.lit(False)
    for w in lex.RULE_TITLE_WORDS:
        known = known | F.startswith(upper, F.lit(w))
    ignored = F.lit(False)
    for p in lex.RULE_IGNORE_PATTERNS:
        ignored = ignored | x.rlike("(?i)" + p)
    return ((F.endswith(x, F.lit(":")) & (F.length(x) < 80)) | (T.is_title(x) & (F.length(x) < 60)) | known) & ~ignored


def is_bad_title(title: Column) -> Column:
    """Empty, one of the generic titles, or of fewer than three words."""
    t = F.lower(T.strip(F.coalesce(title, F.lit(""))))
    return (t == "") | t.isin(lex.BAD_TITLES) | F.contains(t, F.lit("general information")) | (T.word_count(t) < 3)


def is_valid_title(title: Column) -> Column:
    """Two to twelve words, and no generic pattern."""
    low, generic = F.lower(title), F.lit(False)
    for p in lex.GENERIC_TITLE_PATTERNS:
        generic = generic | low.rlike(p)
    return F.coalesce(T.word_count(title).between(2, 12) & ~generic, F.lit(False))


def best_title(llm_title: Column, section_title: Column) -> Column:
    return T.strip(F.coalesce(T.either(llm_title, section_title), F.lit("")))


def stringify(df: DataFrame, column: str) -> Column:
    """A column of any type as text: null is empty, containers are JSON, all else is cast."""
    kind = dict(df.dtypes)[column]
    c = F.col(f"`{column}`")
    return F.coalesce(F.to_json(c) if kind.startswith(("array", "map", "struct")) else c.cast("string"), F.lit(""))


def normal_category(category: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(T.strip(category)), F.lit("")), F.lit("unknown"))


def regulation_year(text: Column, patterns: Sequence[str] = tuple(lex.ADMIN_YEAR_PATTERNS)) -> Column:
    """The first pattern's first match, null if none matches. Later patterns are looked for only if the first ones fail."""
    def first(rest: Sequence[str]) -> Column:
        if not rest:
            return F.lit(None).cast("string")
        return T.let(F.regexp_extract(text, "(?i)" + rest[0], 1), lambda y: F.when(y != "", y).otherwise(first(rest[1:])))

    out = first(patterns)
    # all of the given patterns hold four digits
    return F.when(text.rlike(r"\d{4}"), out) if tuple(patterns) == tuple(lex.ADMIN_YEAR_PATTERNS) else out


def majority_program(text: Column, file: Column | None = None) -> Column:
    """The program mentioned most, the first of equals; then one in the file name; else Unknown.

    One search finds the mentions of all programs, which can't overlap each other; a mention is then told by its own pattern."""
    mention = f"(?i)(?=[{lex.PROGRAM_LETTERS}])(?:{'|'.join(lex.PROGRAM_PATTERNS.values())})"

    def most(found: Column) -> Column:
        of = lambda p: F.size(F.filter(found, lambda m: m.rlike(rf"(?i)\A(?:{p})")))
        best = F.array_max(F.array(*[F.struct(of(p).alias("s"), F.lit(-i).alias("p"), F.lit(n).alias("n")) for i, (n, p) in enumerate(lex.PROGRAM_PATTERNS.items())]))
        return F.when(F.size(found) > 0, best["n"])

    def best(of: Column) -> Column:
        return T.let(F.regexp_extract_all(of, F.lit(mention), F.lit(0)), most)

    out = best(text)
    if file is not None:
        spaced = F.translate(file, "_-", "  ")
        out = F.coalesce(out, best(spaced))
    return F.coalesce(out, F.lit("Unknown"))


def regulation_name(text: Column, file: Column) -> Column:
    """The first of twenty lines, 11 to 199 characters long, that names a regulation; else the file's name."""
    lines = F.transform(F.split(F.substring_index(text, "\n", 20), "\n"), T.strip)
    named = F.filter(lines, lambda x: (F.length(x) > 10) & (F.length(x) < 200) & F.upper(x).rlike("|".join(lex.REGULATION_NAME_WORDS)))
    clean = T.collapse(F.translate(F.regexp_replace(file, r"(?i)\.pdf$", ""), "_-", "  "))
    return F.coalesce(F.get(named, F.lit(0)), clean)


def _repeats(text: str | None, share: float, least: int) -> bool:
    parts = re.split("[.!?]", (text or "").lower())
    if len(parts) < 3:
        return False
    seen: list[int] = []  # sizes of the sets so far
    at: dict[str, list[int]] = {}  # by word, the sets that hold it
    for p in parts:
        words = set(re.split(r"[ \t-\r]+", p)) - {""}
        if len(words) <= least:
            continue
        lists = [held for w in words if (held := at.get(w))]
        if lists:
            both = np.bincount(np.concatenate([np.asarray(x) for x in lists]), minlength=len(seen))
            if (both > share * np.minimum(np.asarray(seen), len(words))).any():
                return True
        for w in words:
            at.setdefault(w, []).append(len(seen))
        seen.append(len(words))
    return False


def similar_sentences(text: Column, share: float = 0.5, least: int = 5) -> Column:
    """Whether two sentences of more than `least` different words share over `share` of the smaller one's.

    A sentence is compared with those before it by lists of the sentences that hold its words, so memory follows
    the text's words; higher-order functions would take an intersection of arrays for each pair."""

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _repeats(t, share, least))

    return check(text)


def chunk_issues(text: Column, least: int = 200, most: int = 800, bullets: int = 3, pairs: Sequence[tuple[str, str]] = tuple(lex.MIXED_TOPIC_PAIRS)) -> Column:
    """What is wrong with a chunk: its size, its bullets, topics that don't belong together unless adjacent,
    sentences that repeat each other (over half of the words of the smaller of two with more than five), blank.
    A null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    low = F.lower(text)
    n_bullets = T.count_of(text, "\n-") + T.count_of(text, "\n•") + T.count_of(text, "\n*")
    issues = [
        F.when(F.length(text) < least, F.format_string(f"Too short (%d < {least} chars)", F.length(text))),
        F.when(F.length(text) > most, F.format_string(f"Too long (%d > {most} chars)", F.length(text))),
        F.when(n_bullets > bullets, F.format_string(f"Too many bullet points (%d > {bullets})", n_bullets)),
    ]
    for a, b in pairs:
        both = F.contains(low, F.lit(a)) & F.contains(low, F.lit(b)) & ~F.contains(low, F.lit(f"{a} {b}")) & ~F.contains(low, F.lit(f"{b} {a}"))
        issues.append(F.when(both, F.lit(f"Mixed topics detected: '{a}' and '{b}'")))
    issues.append(F.when(similar_sentences(text), F.lit("Repeated/similar sentences detected")))
    issues.append(F.when(T.strip(text) == "", F.lit("Empty or whitespace-only content")))
    return F.array_compact(F.array(*issues))


def margin_class(right: Column, margin: Column, weak: float = 0.05, strong: float = 0.10) -> Column:
    return F.when(~right, "WRONG_DB").when(margin < weak, "WEAK_SEPARATION").when(margin < strong, "MODERATE_MATCH").otherwise("GOOD_MATCH")


def retrieval_status(score: Column, least: Column, keyword_hits: Column) -> Column:
    return F.when((score >= least) & (keyword_hits >= 1), "PASS").when(score >= least, "PARTIAL").otherwise("FAIL")


def foreign_markers(text: Column, markers: Sequence[str]) -> Column:
    """Markers of other domains that occur in a text."""
    low = F.lower(text)
    return F.filter(_strings(markers), lambda m: F.contains(low, F.lower(m)))


# --- record validity: what is missing, as a list ---


def _errors(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(m)) for bad, m in checks]))


def _blank(c: Column) -> Column:
    return F.coalesce(T.strip(c), F.lit("")) == ""


def admin_errors(title: Column, content: Column, regulation: Column) -> Column:
    return _errors((_blank(title), "section_title"), (F.length(T.strip(content)) < 10, "content"), (_blank(regulation), "regulation_name"))


def institutional_errors(ako_id: Column, category: Column, title: Column, content: Column, source: Column) -> Column:
    return _errors((_blank(ako_id), "ako_id"), (_blank(category), "category"), (_blank(title), "section_title"), (F.length(T.strip(content)) < 10, "content"), (_blank(source), "source_file"))


def course_errors(code: Column, name: Column) -> Column:
    return _errors((_blank(code), "course_code"), (_blank(name), "course_name"))


def loadable(kind: str, title: Column, content: Column, *more: Column) -> Column:
    """Whether a record may enter the index of its kind: admin (regulation name), institutional (id, category, source)
    or course (code, name)."""
    if kind == "admin":
        return F.size(admin_errors(title, content, *more)) == 0
    if kind == "institutional":
        ako_id, category, source = more
        return F.size(institutional_errors(ako_id, category, title, content, source)) == 0
    return F.size(course_errors(*more)) == 0


def cleanup_valid(content: Column, title: Column, category: Column, least_words: int = 30) -> Column:
    return (T.word_count(content) >= least_words) & ~_blank(title) & ~_blank(category) & (category != "unknown")


def indexable_admin(title: Column, content: Column, keywords: Sequence[str] = tuple(lex.UNFIXABLE_TITLE_WORDS)) -> Column:
    """Content over 50 characters or a major keyword in the title."""
    major = F.lit(False)
    for w in keywords:
        major = major | F.contains(F.upper(title), F.lit(w))
    return (F.length(F.coalesce(content, F.lit(""))) > 50) | F.coalesce(major, F.lit(False))


def course_flags(units: Column, outcomes: Column, objectives: Column, name: Column, credits: Column) -> Column:
    """Quality flags of a course; `quality_score` takes 0.15 off for each."""
    empty = lambda c: F.coalesce(c, F.lit(0)) == 0
    dangling = F.coalesce(name.rlike(r" (and|of|in|the|for|to|&|or|-)\z"), F.lit(False))
    return F.array_compact(
        F.array(
            F.when(empty(units), F.lit("NO_UNITS")),
            F.when(empty(outcomes), F.lit("NO_OUTCOMES")),
            F.when(empty(objectives), F.lit("NO_OBJECTIVES")),
            F.when(dangling, F.lit("TRUNCATED_NAME")),
            F.when(F.contains(name, F.lit("[NEEDS REVIEW]")), F.lit("NAME_UNRESOLVED")),
            F.when(credits == 0, F.lit("ZERO_CREDITS")),
        )
    )


def quality_score(flags: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - 0.15 * F.size(flags))


def sanitize_credits(total: Column, lecture: Column, tutorial: Column, practical: Column) -> Column:
    """The total if it is from 0 to 10, else the parts' sum if that is, else 0."""
    parts = _total([F.coalesce(c, F.lit(0)) for c in (lecture, tutorial, practical)])
    return F.when(total.between(0, 10), total).when(parts.between(0, 10), parts).otherwise(F.lit(0)).cast("int")
