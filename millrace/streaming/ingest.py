"""Incremental ingestion: new page tables become sections as they arrive (an addition; batch plans don't need it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import classify as C
from millrace.functions import text as T


def page_stream(spark: SparkSession, path: str, schema: str = "doc string, page_num int, text string", files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def clean_pages(pages: DataFrame) -> DataFrame:
    """Row-wise cleaning and routing of pages; works on streams and tables alike."""
    t = T.clean_institutional(F.col("text"))
    return pages.select("doc", "page_num", t.alias("text"), C.infer_category(t).alias("category"), T.word_count(t).alias("n_words")).filter("text <> ''")


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends cleaned pages to the Parquet table `sink`, exactly once by its checkpoint; all there is by default."""
    stream = clean_pages(page_stream(spark, source))
    return stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stage_counts(events: DataFrame, time: str, stage: str, delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events of each stage in windows of event time, late ones up to the delay counted."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window), stage).agg(F.count(F.lit(1)).alias("n"))
