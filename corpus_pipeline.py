"""Corpus pipeline: quality rules, language identification, near duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before has kept. All but the last
return the columns of documents. Between stages the rows are written as Parquet in the shared folder and read
again, so a lost executor costs no stage that is over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, mixing, near, packing, quality
from millrace.llm.common import stored, with_places

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is one half or more and that don't fail the base rules.

    A verdict rests on the document's own text: null and empty texts fail, repeated rows and null ids are judged
    each, long texts are read whole. An empty table stays empty. Extra columns are left behind."""
    return quality.keep_quality(docs).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of one half or more; the label column stays as it came.

    Null and empty texts and texts without a letter go; null labels teach nothing; repeated rows and null ids are
    judged each; long texts are read whole. Without any label all documents go, as nothing can be told. An empty
    table stays empty. Extra columns are left behind."""
    return langid.keep_identified(docs, least=0.5).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by a Jaccard similarity of 0.8 or more, that with the smallest id.

    Of repeated rows one stays; null ids come behind all others; documents without words stay, each; long texts are
    compared whole. An empty table stays empty. Extra columns are left behind."""
    return near.keep_one(docs, threshold=0.8).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix of sources at their target weights.

    A null source is a source; rows of a source go by id, then a hash of the row, null ids first; repeated rows each
    take a place; texts are not looked at. An empty table stays empty. Extra columns are left behind."""
    return mixing.whole_stream(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their sequences and places.

    Sequences are numbered in the order in which docs was written, that of the mix: a sequence's number follows the
    first piece of the mix that it holds, so reading sequences by number keeps the sources near their weights.

    Null and empty texts are one token; repeated rows and null ids are packed each; long texts are cut into full
    sequences and a rest. An empty table gives an empty result. Extra columns are left behind."""
    import public_tokenizers

    placed = with_places(docs, "_place")
    return packing.pack_documents(placed, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, place_col="_place")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", packed),
]

#: Vote models, language models and bin completion are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
