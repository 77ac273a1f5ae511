"""Administrative regulations: pages to sections to deduplicated, embedded records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import dedup, segment, vectors


def extract(pages: DataFrame) -> DataFrame:
    """pages (doc, page_num, text) to valid sections: doc, section_no, title, content, category, program, year, name, pages."""
    docs = segment.document_text(pages)
    described = docs.select("doc", "text", C.majority_program(F.col("text"), F.col("doc")).alias("program"), C.regulation_year(F.col("text")).alias("regulation_year"), C.regulation_name(F.col("text"), F.col("doc")).alias("regulation_name"), T.page_range(F.col("first_page"), F.col("last_page")).alias("page_range"))
    cut = segment.sections(described, doc="doc", keep=["program", "regulation_year", "regulation_name", "page_range"])
    titled = cut.withColumn("section_title", T.complete_title(F.col("section_title"), F.col("content")))
    out = titled.select(F.lit("regulation_section").alias("object_type"), "doc", "section_no", "program", "regulation_name", "regulation_year", "section_title", "content", C.section_category(F.col("section_title")).alias("section_category"), "page_range")
    return out.filter(F.size(C.admin_errors(F.col("section_title"), F.col("content"), F.col("regulation_name"))) == 0)


def deduplicate(sections: DataFrame) -> DataFrame:
    """Sections of the same title and program once, the first by document and place."""
    return dedup.keep_first(sections, dedup.title_program_key(), ["doc", "section_no"])


def documents(sections: DataFrame) -> DataFrame:
    """Sections worth indexing with the text to embed; document and metadata are one row."""
    kept = sections.filter(C.indexable_admin(F.col("section_title"), F.col("content")))
    return kept.withColumn("document", T.render_admin(F.col("section_title"), F.col("content")))


def build(pages: DataFrame, embedder: Callable = vectors.hashing_embedder) -> DataFrame:
    return vectors.embed(documents(deduplicate(extract(pages))), "document", embedder)
