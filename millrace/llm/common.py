"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one salted slice of a group holds on average.
SLICE_ROWS = 2_000
#: Rows of a key above which it may be a hot one, and the least number of keys that hot ones are fewer than.
HOT_ROWS, HOT_KEYS = 500, 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors and the driver share.

    Where the setting is unset (tests on one machine) a temporary folder becomes the checkpoint folder;
    on a cluster an unset folder is an error, as a local one would not be seen by the executors.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(found)
        return found.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_made: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    folder = f"{shared_dir(spark)}/millrace/{uuid.uuid4().hex}"
    for held in _made:
        held.append(folder)
    return f"{folder}/{name}"


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes the tables and archives that operators store inside the context when it ends.

    Results read them lazily, so write what is to stay before the end."""
    mine: list[str] = []
    _made.append(mine)
    try:
        yield
    finally:
        _made.remove(mine)
        for folder in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df written as a Parquet table in the shared folder and read again: cuts lineage and outlives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_places(df: DataFrame, name: str) -> DataFrame:
    """df plus each row's place: for a table read from Parquet files the file's part number and the row's number in it,
    so what was written in an order is numbered in it; for other tables the place among its partitions."""
    file, nth = fresh(df, "_file"), fresh(df, "_nth")
    try:
        held = df.select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(nth))
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    part = F.coalesce(F.expr(f"try_cast(regexp_extract({file}, 'part-([0-9]+)', 1) as bigint)"), F.lit(0))
    return held.select(*[held[f"`{c}`"] for c in df.columns], (F.shiftleft(part, 25) + F.col(nth)).alias(name))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case: `name`, lengthened if need be."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def salts_for(rows: int) -> int:
    """Slices into which a group that may hold all `rows` is cut."""
    return max(1, math.ceil(rows / SLICE_ROWS))


def salted_rank(df: DataFrame, keys: list[str], order: list[str], salts: int, name: str) -> DataFrame:
    """df plus a gapless 0-based rank `name` of each row in its group.

    A group is cut into `salts` slices by a hash of the order columns; the slices' counts, summed up, are the
    slices' first ranks, so no task ever sorts a whole group. The rank is total and repeatable for rows that
    differ in the order columns; rows that agree in all of them are exchangeable.
    """
    mine = df.columns
    # one struct as key: null keys are equal in it, and window and join share its partitioning
    at = F.struct(*keys, F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int").alias("_slice")).alias("_at")
    sliced = df.select("*", at)
    counts = sliced.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*[f"_at.{k}" for k in keys]).orderBy("_at._slice").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("_at", F.coalesce(before, F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy("_at").orderBy(*order)) - 1
    ranked = sliced.withColumn("_own", own).join(first, "_at")
    return ranked.select(*mine, (F.col("_first") + F.col("_own")).cast("long").alias(name))


def ordered_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df plus each row's place, from 0 without gaps, when sorted by `order`; rows that tie in it are exchangeable.

    Rows are sorted by ranges and stored; a partition's first place is the sum of the counts before it, one number a
    partition."""
    part, own = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_nth")
    cut = stored(df.orderBy(*order).select("*", part, own), "ordered")
    before, first = 0, []
    for p, n in sorted(map(tuple, cut.groupBy("_part").count().collect())):
        first.append((p, before))
        before += n
    starts = F.broadcast(df.sparkSession.createDataFrame(first, "_part int, _from long"))  # a row a partition
    return cut.join(starts, "_part").select(*df.columns, (F.col("_from") + F.col("_nth")).alias(name))


def hub_join(left: DataFrame, right: DataFrame, key: str, weight: str, rows: int) -> DataFrame:
    """left joined to right by `key`; right has one row a key, `weight` says how many rows of left (`rows` in all) hold it.

    Keys with more than HOT_ROWS rows and more than a HOT_KEYS-th of all rows are sent to all tasks, so none of them
    is a task of its own; there are fewer than HOT_KEYS such keys, whatever the data. The others are shuffled. right
    has to be narrow; left is read twice."""
    hot = max(HOT_ROWS, rows // HOT_KEYS)
    heavy, light = right.filter(F.col(weight) > hot), right.filter(F.col(weight) <= hot)
    held = left.join(F.broadcast(heavy), key)
    return held.unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key).select(*held.columns))


def unit_hash(*cols: Column | str) -> Column:
    """A repeatable number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def crc_mod(col: Column | str, mod: int) -> Column:
    """crc32 of the value as text, modulo `mod`; null for null."""
    return F.pmod(F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")), F.lit(mod))


class WordHash(dict):
    """64-bit hashes of byte words, remembered up to a bound."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def arrow_rows(make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], slice_rows: int = 256):
    """A mapInArrow function: `make` builds a worker's state once a task, then batches come in short slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                yield from work(batch.slice(at, slice_rows))

    return run


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column, null as None."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
