"""Cuts between stages: a stage that several later steps read is computed once and kept in the shared folder."""

from __future__ import annotations

import re
import uuid
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which becomes the checkpoint folder.

    Where the setting is unset a temporary folder serves on one machine; on a cluster that is an error."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not held.isDefined():
        if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found or mkdtemp(prefix="millrace-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return (found or held.get()).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/millrace/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame) -> DataFrame:
    """df checkpointed in the folder of spark.checkpoint.dir; it outlives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
