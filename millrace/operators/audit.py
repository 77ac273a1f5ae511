"""Stage audit: counts in and out of each stage of a run, losses, and the checks that rest on them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AUDIT = "seq long, timestamp string, stage string, input_file string, output_file string, input_count long, output_count long, extra map<string,string>"


def with_losses(entries: DataFrame, alarm: float = 0.10) -> DataFrame:
    """Entries with delta, delta_pct (to 1 place, null without or with an empty input) and alarm: over `alarm` lost."""
    delta = F.col("output_count") - F.col("input_count")
    return entries.withColumn("delta", delta).withColumn("delta_pct", F.round(F.try_divide(100 * delta, F.col("input_count")), 1)).withColumn(
        "alarm", F.coalesce((delta < 0) & (F.try_divide(-delta, F.col("input_count")) > alarm), F.lit(False))
    )


def record_stage(spark: SparkSession, path: str, stage: str, output_count: int, input_count: int | None = None, input_file: str | None = None, output_file: str | None = None, extra: dict | None = None) -> DataFrame:
    """Appends an entry to the audit table at `path` and returns it with its losses."""
    now = datetime.now(timezone.utc)
    row = (int(now.timestamp() * 1e6), now.isoformat(), stage, input_file, output_file, input_count, output_count, {str(k): str(v) for k, v in (extra or {}).items()})
    one = spark.createDataFrame([row], AUDIT)
    one.write.mode("append").parquet(path)
    return with_losses(one)


def record_stages(entries: DataFrame, path: str) -> None:
    """Appends many entries, a row each, to the audit table at `path`: stage, output_count and any other columns of AUDIT;
    those that are left out are null. They are written as Spark has them, none comes to the driver."""
    given = set(entries.columns)
    kinds = [c.split(" ", 1) for c in AUDIT.split(", ")]
    entries.select(*[(F.col(n) if n in given else F.lit(None)).cast(k).alias(n) for n, k in kinds]).write.mode("append").parquet(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    return with_losses(spark.read.schema(AUDIT).parquet(path)).orderBy("seq")


def latest_counts(entries: DataFrame, order: list[str]) -> DataFrame:
    """The last entry's output count of each stage."""
    return entries.groupBy("stage").agg(F.max_by("output_count", F.struct(*order)).alias("output_count"), F.max(F.struct(*order)).alias("_at")).drop("_at")


def count_mismatch(rows: DataFrame, entries: DataFrame, stage: str, order: list[str]) -> DataFrame:
    """One row: actual rows, the count last recorded for a stage, and whether they differ (null without a record)."""
    actual = rows.agg(F.count(F.lit(1)).alias("actual"))
    return actual.join(latest_counts(entries, order).filter(F.col("stage") == stage).select(F.col("output_count").alias("recorded")), how="left").withColumn("differs", F.col("actual") != F.col("recorded"))


def stage_flow(events: DataFrame, stage: str, unit: str, order: list[str]) -> DataFrame:
    """Losses between stages from a log of events: units that reached each stage, in the order in which stages
    are first seen; the count before is the stage's input."""
    each = events.groupBy(stage).agg(F.countDistinct(unit).alias("output_count"), F.min(F.struct(*order)).alias("_first"))
    w = Window.orderBy("_first")  # one row a stage
    return with_losses(each.withColumn("input_count", F.lag("output_count").over(w)).withColumnRenamed(stage, "stage").drop("_first"))
