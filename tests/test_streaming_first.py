import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup
from millrace.streaming import first

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


@pytest.mark.parametrize("by", ["doc_id", "-doc_id", "hash"])
def test_files_in_any_order_give_the_batch_rows(spark, tmp_path, by):
    """Documents in several files, a file a batch: what stands in the end is what dedup_prefix_hash keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    order = {"doc_id": F.col("doc_id"), "-doc_id": -F.col("doc_id"), "hash": F.xxhash64("doc_id")}[by]
    docs.repartitionByRange(5, order).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DOC).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    changes = first.kept_changes(stream, dedup.prefix_md5(F.col("text")), ["doc_id"])
    changes.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    got = first.current_rows(spark.read.schema(first.CHANGES).parquet(str(tmp_path / "out")), DOC)
    want = dedup.keep_first(docs, dedup.prefix_md5(F.col("text")), ["doc_id"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_last_entry_of_a_stage_with_late_entries(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    kinds = ", ".join(f"{c} {t}" for c, t in events.dtypes)
    events.repartitionByRange(3, F.xxhash64("event_id")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    changes = first.kept_changes(stream, F.col("event_type"), ["ts", "event_id"], last=True)
    changes.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    got = first.current_rows(spark.read.schema(first.CHANGES).parquet(str(tmp_path / "out")), "event_id long, event_type string")
    want = events.groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert {(r.event_type, r.event_id) for r in got.collect()} == {(r.event_type, r.event_id) for r in want.collect()}


def test_a_watermark_bounds_the_state(spark, tmp_path):
    for n, rows in enumerate([[(1, "a", "2024-01-01 00:00:00")], [(2, "b", "2024-01-03 00:00:00")], [(0, "a", "2024-01-01 00:00:01"), (3, "c", "2024-01-05 00:00:00")]]):
        spark.createDataFrame(rows, "o long, k string, at string").select("o", "k", F.col("at").cast("timestamp").alias("at")).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
    stream = spark.readStream.schema("o long, k string, at timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")).withWatermark("at", "1 hour")
    changes = first.kept_changes(stream, F.col("k"), ["o"], event="at", late_ms=1000)
    query = changes.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = first.current_rows(spark.read.schema(first.CHANGES).parquet(str(tmp_path / "out")), "o long, k string")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "b"), (3, "c")]  # the entry behind the watermark is left out
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 3
