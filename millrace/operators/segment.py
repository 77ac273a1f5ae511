"""Row generators that cut documents into lines, sections, sentences and chunks.

Order is explicit: every row carries its document and an ordinal, nothing relies on partition order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import ChunkRules
from millrace.functions import classify as C
from millrace.functions import text as T


#: Texts of an Arrow batch that are held as Python objects at once.
SLICE_TEXTS = 128


def document_text(pages: DataFrame, doc: str = "doc", page: str = "page_num", text: str = "text", marked: bool = False, ended: bool = False, parts: bool = False) -> DataFrame:
    """Pages joined into documents by a blank line, in page order, blank pages left out; with page marks if asked,
    and with a blank line behind the last page too (`ended`). `parts` adds the pages: an array of n (page) and t (text)."""
    part = T.strip(F.col(text))
    shown = F.concat(F.lit("--- PAGE "), F.col(page).cast("string"), F.lit(" ---\n"), part) if marked else part
    kept = pages.filter(F.coalesce(part, F.lit("")) != "").select(F.col(doc).alias("doc"), F.struct(F.col(page).alias("n"), shown.alias("t")).alias("p"))
    joined = kept.groupBy("doc").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    whole = F.concat(F.array_join(F.transform("ps", lambda p: p["t"]), "\n\n"), F.lit("\n\n" if ended else ""))
    return joined.select("doc", whole.alias("text"), F.element_at("ps", 1)["n"].alias("first_page"), F.element_at("ps", -1)["n"].alias("last_page"), *[F.col("ps").alias("pages")] * parts)


def lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, line_no (from 0), line."""
    return docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def sections(docs: DataFrame, header: Callable[[Column], Column] = C.is_header, doc: str = "doc_id", text: str = "text", min_chars: int = 50, title: str = "GENERAL REGULATIONS", keep: Sequence[str] = ()) -> DataFrame:
    """A document's sections between header lines: doc, the columns `keep`, section_no, section_title, content.

    `header` is a predicate on a line. A document's row is cut into its sections where it is: no line and no text is shuffled. Lines of under three characters,
    short lines in capitals and lines of symbols are left out of contents, which are then cleaned; sections under
    `min_chars` are dropped. Of sections with the same title and the same first 200 characters the first stays.
    A document without any header is one section if it is longer than `min_chars`. What comes before the first
    header is dropped.
    """
    def section(no: Column, head: Column, body: Column) -> Column:
        made = F.array(T.clean_regulation(F.array_join(body, "\n")))
        return F.transform(made, lambda c: F.struct(head.alias("section_title"), F.substring(F.lower(c), 1, 200).alias("key"), no.cast("long").alias("section_no"), c.alias("content")))

    def kept(line: Column) -> Column:
        x = line["x"]
        return ~line["is_head"] & (F.length(x) >= 3) & ~(T.is_upper(x) & (T.word_count(x) <= 3)) & ~x.rlike(r"^[()\d\s\-=.:/|]+$")

    def between(ls: Column, heads: Column) -> Column:
        def part(at: Column, k: Column) -> Column:
            own = F.slice(ls, at + 2, F.coalesce(F.get(heads, k + 1), F.size(ls)) - at - 1)
            body = F.transform(F.filter(own, kept), lambda p: p["x"])
            return T.let(T.normalize_section_title(F.get(ls, at)["x"]), lambda head: F.when(head != "", F.get(section(k + 1, head, body), F.lit(0))))

        made = F.filter(F.transform(heads, part), lambda s: F.length(s["content"]) >= min_chars)
        # in order of title, beginning and place a section that repeats one stands behind it
        return T.let(F.array_sort(made), lambda ss: F.filter(ss, lambda s, i: ~F.coalesce((F.get(ss, i - 1)["section_title"] == s["section_title"]) & (F.get(ss, i - 1)["key"] == s["key"]), F.lit(False))))

    def cut(ls: Column) -> Column:
        whole = F.filter(section(F.lit(0), F.lit(title), F.array(F.col(text))), lambda s: F.length(s["content"]) > min_chars)
        at = F.array_compact(F.transform(ls, lambda line, i: F.when(line["is_head"], i)))
        return T.let(at, lambda heads: F.when(F.size(heads) > 0, between(ls, heads)).otherwise(whole))

    lines_ = F.transform(F.split(F.col(text), "\n"), lambda line: F.struct(T.strip(line).alias("x"), F.coalesce(header(line), F.lit(False)).alias("is_head")))
    rows = docs.select(F.col(doc).alias("doc"), *keep, F.explode(T.let(lines_, cut)).alias("_s"))
    return rows.select("doc", *keep, "_s.section_no", "_s.section_title", "_s.content")


def rule_sections(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Sections under lines that look like titles by the simple rules; contents of `min_words` or more."""
    order = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    flagged = lines(docs, doc, text).withColumn("is_head", C.is_rule_title(F.col("line")))
    numbered = flagged.withColumn("section_no", F.sum(F.col("is_head").cast("int")).over(order)).filter("section_no > 0")
    got = numbered.groupBy("doc", "section_no").agg(F.max(F.when(F.col("is_head"), T.strip(F.col("line")))).alias("section_title"), F.array_sort(F.collect_list(F.when(~F.col("is_head"), F.struct("line_no", "line")))).alias("ls"))
    return got.select("doc", "section_no", F.regexp_replace("section_title", r":\z", "").alias("section_title"), T.collapse(F.array_join(F.transform("ls", lambda p: p["line"]), " ")).alias("content")).filter(T.word_count(F.col("content")) >= min_words)


def section_gate(sections_: DataFrame, least: int = 3, mean_words: float = 100) -> DataFrame:
    """Documents whose sections are good enough: `least` of them, of `mean_words` on average, titles all different."""
    agg = sections_.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.avg(T.word_count(F.col("content"))).alias("mean_words"), F.countDistinct("section_title").alias("titles"))
    return agg.select("doc", "n", "mean_words", ((F.col("n") >= least) & (F.col("mean_words") >= mean_words) & (F.col("titles") == F.col("n"))).alias("good"))


def hybrid_sections(by_rules: DataFrame, by_meaning: DataFrame, **gate) -> DataFrame:
    """Rule sections of the documents that pass the gate, semantic ones of the others (columns of both)."""
    good = section_gate(by_rules, **gate).filter("good").select("doc")
    shared = [c for c in by_rules.columns if c in by_meaning.columns]
    return by_rules.join(good, "doc", "left_semi").select(*shared).unionByName(by_meaning.join(good, "doc", "left_anti").select(*shared))


# --- folds over arrays: one row a document, no shuffle ---


def smoothed(similarities: Column, half_width: int = 2) -> Column:
    """Moving average over `half_width` neighbours on both sides, the frame clipped at the ends."""
    def mean(x: Column, i: Column) -> Column:
        frame = F.slice(similarities, F.greatest(i - half_width, F.lit(0)) + 1, F.least(i, F.lit(half_width)) + half_width + 1)
        return F.aggregate(frame, F.lit(0.0), lambda a, v: a + v) / F.size(frame)

    return F.transform(similarities, mean)


def boundaries(smooth: Column, n: Column, threshold: float, least: int = 5) -> Column:
    """Places (counted in sentences) where a topic ends: the smoothed similarity is under the threshold and both
    the chunk since the last place and what is left have `least` sentences."""
    def step(acc: Column, i: Column) -> Column:
        last = F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))
        cut = (F.get(smooth, i - 1) < threshold) & (i - last >= least) & (n - i >= least)
        return F.when(cut, F.concat(acc, F.array(i))).otherwise(acc)

    places = F.when(F.size(smooth) > 0, F.sequence(F.lit(1), F.size(smooth))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.array().cast("array<int>"), step)


def chunk_spans(ends: Column, n: Column, least: int = 5, most: int = 20) -> Column:
    """Spans (start, length) between boundaries, those under `least` dropped, longer than `most` cut in windows.

    A tail of fewer than `least` goes into the window before it, if there is one before that; so a chunk of 41 to
    44 ends in a window longer than `most`, and one of 21 to 24 keeps its short tail."""
    edges = F.concat(F.array(F.lit(0)), ends, F.array(n))
    raw = F.transform(F.slice(edges, 2, F.size(edges)), lambda e, i: F.struct(F.get(edges, i).alias("start"), (e - F.get(edges, i)).alias("len")))
    raw = F.filter(raw, lambda s: s["len"] >= least)

    def capped(s: Column) -> Column:
        windows = F.ceil(s["len"] / most).cast("int")
        tail = s["len"] - (windows - 1) * most
        joined = (windows > 2) & (tail < least)
        count = windows - joined.cast("int")
        at = F.sequence(F.lit(0), count - 1)
        return F.transform(at, lambda i: F.struct((s["start"] + i * most).alias("start"), F.when(i == count - 1, s["len"] - i * most).otherwise(F.lit(most)).alias("len")))

    return F.flatten(F.transform(raw, capped))


def _of_sentences(text: Column, min_chars: int, body: Callable[[Column], Column]) -> Column:
    return T.let(T.sentences(text, min_chars), lambda parts: body(parts))


def bisect(sections_: DataFrame, mixed: Column, depth: int = 2, rules: ChunkRules = ChunkRules(), content: str = "content") -> DataFrame:
    """Sections for which `mixed` holds cut in the middle of their sentences, `depth` times at most.

    Only sections of ten sentences or more whose halves both have min_words are cut; `path` orders the parts and
    `bisected` counts the cuts. Others pass as they are."""
    out = sections_.withColumn("path", F.array().cast("array<int>")).withColumn("bisected", F.lit(0))
    for _ in range(depth):
        whole = F.array(F.struct(F.lit(0).alias("k"), F.col(content).alias("c"), F.lit(0).alias("b")))

        def halves(parts: Column, whole: Column = whole) -> Column:
            half = F.floor(F.size(parts) / 2).cast("int")
            pair = F.array(*[F.struct(F.lit(k).alias("k"), F.array_join(p, " ").alias("c"), F.lit(1).alias("b")) for k, p in enumerate((F.slice(parts, 1, half), F.slice(parts, half + 1, F.size(parts))))])
            return F.when((F.size(parts) >= 10) & F.forall(pair, lambda p: T.word_count(p["c"]) >= rules.min_words), pair).otherwise(whole)

        cut = F.when(mixed, _of_sentences(F.col(content), rules.min_sentence_chars, halves)).otherwise(whole)
        rest = [c for c in out.columns if c not in (content, "path", "bisected")]
        out = out.withColumn("_x", F.explode(cut)).select(*rest, F.col("_x.c").alias(content), F.concat("path", F.array("_x.k")).alias("path"), (F.col("bisected") + F.col("_x.b")).alias("bisected"))
    return out


def _oversize_parts(text: str | None, target: int, most: int, least: int) -> list[str] | None:
    if text is None:
        return None
    whole = re.sub(r"[ \t-\r]+", " ", text).strip(" ")
    if len(whole) <= most:
        return [whole]
    out: list[str] = []
    part: list[str] = []  # pieces of the part being filled
    size = 0  # its length when joined
    for sentence in re.split(r"(?<=[.!?]) ", whole):
        for piece in [sentence] if len(sentence) <= most else sentence.split(" "):
            if part and size + 1 + len(piece) > target:
                out.append(" ".join(part))
                part = []
            size = size + 1 + len(piece) if part else len(piece)
            part.append(piece)
    out.append(" ".join(part))
    return [x for x in out if len(x) >= least]


def split_oversize(text: Column, target: int = 800, most: int = 1200, least: int = 20) -> Column:
    """A text's parts of about `target` characters, cut between sentences; a sentence over `most` is cut between
    words. Parts under `least` characters are dropped. A text up to `most` long is one part; null stays null.

    Each part's end depends on the one before, so texts go through Arrow batches, in time linear in their length; SLICE_TEXTS of
    a batch are Python objects at a time."""

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for at in range(0, len(texts), SLICE_TEXTS):
                yield pa.array([_oversize_parts(t, target, most, least) for t in texts.slice(at, SLICE_TEXTS).to_pylist()], pa.list_(pa.string()))

    return cut(text)


def oversize_rows(sections_: DataFrame, title: str = "section_title", content: str = "content", **how) -> DataFrame:
    """A row for each part of an oversize content: chunk_index (from 1), chunk_total, titles marked (part i/n)."""
    rest = [c for c in sections_.columns if c not in (title, content)]
    got = sections_.withColumn("_p", split_oversize(F.col(content), **how)).withColumn("chunk_total", F.size("_p"))
    got = got.select(*rest, title, "chunk_total", F.posexplode("_p").alias("_i", content)).withColumn("chunk_index", F.col("_i") + 1).drop("_i")
    marked = F.concat(F.col(title), F.format_string(" (part %d/%d)", "chunk_index", "chunk_total"))
    return got.withColumn(title, F.when(F.col("chunk_total") > 1, marked).otherwise(F.col(title)))
