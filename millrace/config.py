"""Typed settings with the defaults that the operators use, and a reader of their YAML files."""

from __future__ import annotations

import logging
from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Thresholds:
    """Semantic segmentation. Cosine values hold for one embedding model: calibrate for another."""

    similarity_threshold: float = 0.55
    semantic_boundary_threshold: float = 0.70
    mixed_topic_threshold: float = 0.60
    purity_floor: float = 0.25
    mixed_category_max_allowed: int = 3
    mixed_category_dominance_ratio: float = 0.65
    max_bisection_depth: int = 2
    calibrated: bool = False


@dataclass(frozen=True)
class ChunkRules:
    min_sentence_chars: int = 20
    min_sentences: int = 5
    max_sentences: int = 20
    min_words: int = 75
    rule_min_words: int = 50
    half_width: int = 2


@dataclass(frozen=True)
class EmbeddingConfig:
    model: str = "hashing"
    dimension: int = 256
    normalize: bool = True
    batch_size: int = 8


@dataclass(frozen=True)
class DedupRules:
    strict: float = 0.90
    generic: float = 0.80
    text_chars: int = 3000
    jaccard: float = 0.92


def read_settings(spark: SparkSession, path: str, kind: type):
    """A settings object from a flat `key: value` YAML file that Spark can read; unknown keys are ignored,
    absent ones keep their defaults. Thresholds not marked calibrated are warned of."""
    found = {}
    names = {f.name: f.type for f in fields(kind)}
    for (line,) in spark.read.text(path).collect():  # a settings file
        key, colon, value = line.split("#")[0].partition(":")
        key, value = key.strip(), value.strip().strip("\"'")
        if colon and value and key in names:
            cast = {"float": float, "int": int, "bool": lambda x: x.lower() in ("true", "yes", "1"), "str": str}[str(names[key])]
            found[key] = cast(value)
    got = replace(kind(), **found)
    if isinstance(got, Thresholds) and not got.calibrated:
        log.warning("thresholds of %s are not calibrated for the embedding model in use", path)
    return got


def write_settings(spark: SparkSession, path: str, settings) -> None:
    """The settings as a flat YAML text, one file."""
    lines = [(f"{f.name}: {getattr(settings, f.name)}",) for f in fields(settings)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)
