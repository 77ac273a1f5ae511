"""Titles by a generator hook: tried twice, validated, and never a row lost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.functions import text as T
from millrace.operators.segment import SLICE_TEXTS

#: Takes a category and a text and returns a title, empty on failure.
TitleGenerator = Callable[[str, str], str]

PROMPT_CHARS, REWRITE_CHARS = 1200, 1500


def http_generator(url: str, model: str, max_tokens: int = 40, temperature: float = 0.2, timeout: float = 60, strict: bool = False) -> TitleGenerator:
    """A generator that asks an HTTP service which takes {model, prompt, options} and answers {response}; a failure is an
    empty answer, or with `strict` an error, for callers that try again (`answered`)."""

    def ask(category: str, text: str) -> str:
        import json
        import urllib.request

        prompt = f"Write a title of 6-12 words for this text.\nCategory: {category}\nText:\n{text}\n\nTitle:"
        body = {"model": model, "prompt": prompt, "stream": False, "options": {"num_predict": max_tokens, "temperature": temperature}}
        try:
            request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return str(json.load(answer).get("response", "")).strip()
        except (OSError, ValueError):
            if strict:
                raise
            return ""

    return ask


def answered(records: DataFrame, key: str, category: str, content: str, make: Callable[[], TitleGenerator], path: str, in_flight: int = 4, retries: int = 3, backoff: float = 0.5, waves: int = 8) -> DataFrame:
    """key and answer of the records, each asked of the service once: answers are a table at `path`, and only keys that it
    lacks are asked, so a lost task, a failed job or a second call doesn't ask again for what is stored.

    Keys are asked in `waves`, each stored as it ends. A task has `in_flight` requests open at most; a request that fails
    is tried `retries` times more, after `backoff` seconds, then twice as long, and so on; one that fails for good is not
    stored and stays open for the next call. Keys have to be different; null keys are not asked; null texts count as empty."""
    spark = records.sparkSession
    kind = dict(records.dtypes)[key]
    rows = records.select(F.col(key).alias("key"), F.col(category).alias("category"), F.col(content).alias("content")).filter("key is not null")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make()

        def one(row: tuple) -> str | None:
            for k in range(retries + 1):
                try:
                    return generate(row[1] or "", (row[2] or "")[:PROMPT_CHARS])
                except (OSError, ValueError):
                    if k < retries:
                        time.sleep(backoff * 2**k)
            return None

        with ThreadPoolExecutor(in_flight) as pool:
            for pdf in frames:
                answers = pool.map(one, pdf[["key", "category", "content"]].itertuples(index=False))
                yield pd.DataFrame({"key": pdf["key"], "answer": list(answers)}).dropna(subset=["answer"])

    schema = f"key {kind}, answer string"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    for wave in range(waves):
        mine = rows.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave)
        todo = mine.join(spark.read.schema(schema).parquet(path).select("key"), "key", "left_anti")
        todo.mapInPandas(ask, schema).write.mode("append").parquet(path)
    return rows.select("key").join(spark.read.schema(schema).parquet(path), "key").withColumnRenamed("key", key)


def no_generator(category: str, text: str) -> str:
    """The default hook: no title, so the rule-based one stays."""
    return ""


def with_titles(records: DataFrame, make: Callable[[], TitleGenerator] = lambda: no_generator, category: str = "category", content: str = "content", fallback: str = "section_title", attempts: int = 2) -> DataFrame:
    """records with llm_title, title_source (llm or rule_based_fallback) and title_reason (null, empty_response,
    too_short_n, too_long_n, generic). Every row comes out, with the fallback title where none is valid.

    Without a generator nothing leaves the JVM; else the first PROMPT_CHARS of a text do, SLICE_TEXTS of which are Python
    objects at a time."""

    @F.arrow_udf("array<string>")
    def ask(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        generate = make()
        for cats, texts in batches:
            for at in range(0, len(texts), SLICE_TEXTS):
                out = []
                for c, t in zip(cats.slice(at, SLICE_TEXTS).to_pylist(), texts.slice(at, SLICE_TEXTS).to_pylist(), strict=True):
                    tries: list[str] = []
                    while len(tries) < attempts and not any(2 <= len(x.split()) <= 12 for x in tries):
                        tries.append(generate(c or "", t or ""))
                    out.append(tries)
                yield pa.array(out, pa.list_(pa.string()))

    if make() is no_generator:
        tried = records.withColumn("_tries", F.array(F.lit("")))
    else:
        tried = records.withColumn("_tries", ask(F.col(category), F.substring(content, 1, PROMPT_CHARS)))
    cleaned = F.transform("_tries", T.clean_title_candidate)
    good = F.get(F.filter(cleaned, C.is_valid_title), F.lit(0))
    last = F.element_at(cleaned, -1)
    n = T.word_count(last)
    reason = F.when(good.isNotNull(), None).when(last == "", "empty_response").when(n < 2, F.format_string("too_short_%d", n)).when(n > 12, F.format_string("too_long_%d", n)).otherwise("generic")
    got = tried.withColumn("llm_title", F.coalesce(good, F.col(fallback))).withColumn("title_source", F.when(good.isNotNull(), "llm").otherwise("rule_based_fallback")).withColumn("title_reason", reason)
    return got.drop("_tries")


def rewrite(records: DataFrame, make: Callable[[], TitleGenerator], text: str, least: int = 50) -> DataFrame:
    """records with `text` rewritten by the hook from its first characters; answers under `least` keep the text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generate = make()
        for texts in batches:
            for at in range(0, len(texts), SLICE_TEXTS):
                yield pa.array([generate("", t) if t else "" for t in texts.slice(at, SLICE_TEXTS).to_pylist()], pa.string())

    raw = f"{text}_raw"
    answered = records.withColumn(raw, F.col(text)).withColumn("_new", run(F.substring(text, 1, REWRITE_CHARS)))
    return answered.withColumn(text, F.when(F.length(T.strip(F.col("_new"))) >= least, F.col("_new")).otherwise(F.col(raw))).drop("_new")
