"""Institutional texts: semantic sections, gates, cleanup, titles, deduplication, embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import ChunkRules, DedupRules, Thresholds
from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators import dedup, segment, titles, vectors
from millrace.operators.staging import staged
from millrace.sources.readers import stable_id


def curated(*sources: DataFrame, order: str = "ordinal") -> DataFrame:
    """Curated records of several sources in their given order, equal contents once (the first source's)."""
    placed = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(sources)]
    whole = placed[0]
    for df in placed[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return dedup.keep_first(whole, dedup.content_md5(F.col("content")), ["_source", order]).drop("_source")


def sentences(docs: DataFrame, doc: str = "doc", text: str = "text", rules: ChunkRules = ChunkRules()) -> DataFrame:
    """doc, sentence_no, sentence of the cleaned texts."""
    return docs.select(F.col(doc).alias("doc"), F.posexplode(T.sentences(T.clean_institutional(F.col(text)), rules.min_sentence_chars)).alias("sentence_no", "sentence"))


def semantic_sections(docs: DataFrame, thresholds: Thresholds = Thresholds(), rules: ChunkRules = ChunkRules(), embedder: Callable = vectors.hashing_embedder) -> DataFrame:
    """Sections between topic boundaries: doc, section_no, section_title (inferred), content."""
    rows = staged(vectors.embed(sentences(docs, rules=rules), "sentence", embedder))
    ends = vectors.topic_boundaries(rows.select("doc", "sentence_no", "embedding"), "doc", "sentence_no", "embedding", thresholds.similarity_threshold, rules.min_sentences)
    texts = rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("sentence_no", "sentence"))).alias("ss"))
    spans = segment.chunk_spans(F.col("ends"), F.col("n"), rules.min_sentences, rules.max_sentences)
    cut = texts.join(ends, "doc").select("doc", "ss", F.posexplode(spans).alias("section_no", "span"))
    content = F.array_join(F.transform(F.slice("ss", F.col("span.start") + 1, F.col("span.len")), lambda s: s["sentence"]), " ")
    got = cut.select("doc", "section_no", T.reduce_noise(content).alias("content"))
    return got.withColumn("section_title", C.infer_title(F.col("content")))


def candidates(sections: DataFrame, thresholds: Thresholds = Thresholds(), rules: ChunkRules = ChunkRules()) -> DataFrame:
    """Sections with category; mixed ones bisected. Parts keep their order in `path`."""
    c = F.col("content")
    limits = dict(most=thresholds.mixed_category_max_allowed, ratio=thresholds.mixed_category_dominance_ratio)
    mixed = (T.word_count(c) >= rules.min_words) & T.let(C.infer_category(c), lambda p: (p != "") & C.has_mixed_categories(c, p, **limits))
    return segment.bisect(staged(sections), mixed, thresholds.max_bisection_depth, rules).withColumn("category", C.infer_category(c))


def gate(found: DataFrame, thresholds: Thresholds = Thresholds(), rules: ChunkRules = ChunkRules(), embedder: Callable = vectors.hashing_embedder) -> DataFrame:
    """Candidates with purity and `reason`: null if accepted, else too_short, unclear_category, duplicate or
    low_purity, the first that holds. A duplicate is the same first 200 characters in a document; the first that
    comes claims them, before its purity is looked at."""
    keyed = staged(found).withColumn("_id", F.struct("doc", "section_no", "path"))
    short = T.word_count(F.col("content")) < rules.min_words
    early = F.when(short, "too_short").when(F.col("category") == "", "unclear_category")
    keyed = keyed.withColumn("_early", early)
    alive = keyed.filter("_early is null")
    first = dedup.keep_first(alive.select("doc", "_id", F.substring("content", 1, 200).alias("_key")), [F.col("doc"), F.col("_key")], ["_id"]).select("_id", F.lit(True).alias("_first"))
    parts = alive.select("_id", F.explode(T.sentences(F.col("content"), rules.min_sentence_chars)).alias("s"))
    pure = vectors.pairwise_purity(vectors.embed(parts, "s", embedder), "_id", "embedding").select("_id", F.round("purity", 3).alias("semantic_purity_score"))
    out = keyed.join(first, "_id", "left").join(pure, "_id", "left").withColumn("semantic_purity_score", F.coalesce("semantic_purity_score", F.lit(1.0)))
    reason = F.when(F.col("_early").isNotNull(), F.col("_early")).when(F.col("_first").isNull(), "duplicate").when(F.col("semantic_purity_score") < thresholds.purity_floor, "low_purity")
    return out.withColumn("reason", reason).drop("_id", "_early", "_first")


def records(gated: DataFrame, updated: str = "1970-01-01") -> DataFrame:
    """Accepted candidates as records with stable ids."""
    c = F.col("content")
    return gated.filter("reason is null").select(
        stable_id("INST", F.col("doc"), F.col("section_no").cast("string"), F.array_join(F.col("path").cast("array<string>"), ".")).alias("ako_id"), F.lit("institutional").alias("type"), "category", "section_title", "content",
        C.program_scope(c).alias("program_scope"), F.array(F.lit("students")).alias("audience"), F.col("doc").alias("source_file"), "section_no", "path", F.lit(updated).alias("last_updated"), "semantic_purity_score", C.secondary_categories(c, F.col("category")).alias("secondary_categories"),
    )


def cleanup(recs: DataFrame, version: str = "v2.2_rule_based") -> DataFrame:
    """Contents made standalone, repeated first characters dropped (the first id stays), then validity."""
    clean = recs.withColumn("content", T.clean_record(F.col("content"), F.col("section_title"))).withColumn("cleanup_version", F.lit(version))
    clean = staged(clean.withColumn("content_hash", dedup.prefix_md5(F.col("content"))))
    one = dedup.keep_first(clean, F.col("content_hash"), ["source_file", "section_no", "path"])
    return one.filter(C.cleanup_valid(F.col("content"), F.col("section_title"), F.col("category")))


def finish(cleaned: DataFrame, generator: Callable = lambda: titles.no_generator, rules: DedupRules = DedupRules(), embedder: Callable = vectors.hashing_embedder) -> DataFrame:
    """Titles, then exact and semantic deduplication, then the document to embed and its vector."""
    titled = titles.with_titles(cleaned, generator)
    titled = titled.withColumn("_title", C.best_title(F.col("llm_title"), F.col("section_title"))).withColumn("_text", F.substring(F.concat_ws("\n", "_title", "content"), 1, rules.text_chars))
    kept = dedup.soft_dedup(vectors.embed(titled, "_text", embedder, "_vector"), "ako_id", "_vector", title="_title", rules=rules)
    shown = kept.withColumn("document", T.render_institutional(F.col("category"), F.col("_title"), F.array().cast("array<string>"), F.col("content")))
    return vectors.embed(shown.drop("_vector", "_text", "_title"), "document", embedder)


def build(pages: DataFrame, thresholds: Thresholds = Thresholds(), rules: ChunkRules = ChunkRules(), embedder: Callable = vectors.hashing_embedder, generator: Callable = lambda: titles.no_generator) -> DataFrame:
    docs = segment.document_text(pages)
    found = candidates(semantic_sections(docs, thresholds, rules, embedder), thresholds, rules)
    return finish(cleanup(records(gate(found, thresholds, rules, embedder))), generator, embedder=embedder)
