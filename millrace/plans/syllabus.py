"""Syllabi: course extraction, name repair, rendering, quality flags, deduplication, embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.operators import courses, dedup, segment, vectors


def extract(pages: DataFrame) -> DataFrame:
    """Courses of pages, in one pass: no text goes through a join or is staged."""
    return courses.extract_courses(segment.document_text(pages, parts=True), file="doc", pages="pages")


def finish(extracted: DataFrame, with_topics: bool = True) -> DataFrame:
    """Courses with repaired names, ako_title, ako_text, quality flags and score, credits made sane, and an ordinal key."""
    titles = F.transform("units", lambda u: u["unit_title"])
    named = extracted.withColumn("course_name", courses.repair_name(F.col("course_name"), titles, F.col("textbook_references")))
    c = F.col("credits")
    sane = C.sanitize_credits(c["total"], c["lecture"], c["tutorial"], c["practical"])
    named = named.withColumn("ako_title", courses.render_title(F.col("course_code"), F.col("course_name"), F.col("program"), F.col("semester"))).withColumn("ako_text", courses.render_text(with_topics))
    flags = C.course_flags(F.size("units"), F.size("course_outcomes"), F.size("course_objectives"), F.col("course_name"), c["total"])
    flagged = named.withColumn("quality_flags", flags).withColumn("quality_score", C.quality_score(F.col("quality_flags"))).withColumn("total_credits", F.when(c.isNotNull(), sane))
    return flagged.withColumn("ordinal", F.format_string("%s#%08d", "doc", "section_no"))


def deduplicate(finished: DataFrame) -> DataFrame:
    return dedup.dedup_courses(finished, "ordinal")


def build(pages: DataFrame, embedder: Callable = vectors.hashing_embedder, skip_without_units: bool = False) -> DataFrame:
    kept = deduplicate(finish(extract(pages)))
    if skip_without_units:
        kept = kept.filter(~F.array_contains("quality_flags", "NO_UNITS"))
    return vectors.embed(kept, "ako_text", embedder)
