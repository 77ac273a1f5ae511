"""Language identification by word-first backoff to shorter and shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, crc_mod, stored, unit_hash

#: Runs of word characters but underscores and decimal digits: letters, and other numbers (powers, fractions, numerals).
RUNS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The runs of letters of a text in lower case."""
    found = RUNS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split(" ") if w]


UNKNOWN = "und"
#: Different labelled texts of a language that the model is fitted on, about; fewer if there are fewer.
TRAIN_DOCS = 2_000
LONGEST = 5


def grams_of(word: str) -> Iterator[tuple[int, str]]:
    """Sizes and n-grams of a word, its ends marked for all but single characters."""
    marked = f"^{word}$"
    for size in range(1, LONGEST + 1):
        text = word if size == 1 else marked
        for i in range(len(text) - size + 1):
            yield size, text[i : i + size]


class Model:
    """Log frequencies by language of words (size 0) and character n-grams, and the rule of backing off.

    A known word scores log((count + a) / (tokens + a * types)) in each language. An unseen word is scored by its
    n-grams of the longest length of which it has a known one, from LONGEST down to 1, each with the like log
    frequency, averaged so that a word counts once whatever its length. A word without any known n-gram says
    nothing.

    counts: rows (language, size, entry, count) of what is known; totals: by (language, size) all tokens.
    """

    def __init__(self, langs: list[str], counts: Iterable[tuple[str, int, str, int]], totals: dict[tuple[str, int], int], smooth: float = 0.5):
        self.langs = sorted(langs)
        at = {k: i for i, k in enumerate(self.langs)}
        self.rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        cells: list[tuple[list, list, list]] = [([], [], []) for _ in range(LONGEST + 1)]
        for lang, size, entry, n in counts:
            row = self.rows[size].setdefault(entry, len(self.rows[size]))
            for part, v in zip(cells[size], (row, at[lang], n), strict=True):
                part.append(v)
        self.logs = []
        for size, (row, col, n) in enumerate(cells):
            table = np.full((len(self.rows[size]), len(self.langs)), smooth)
            table[row, col] += n
            below = [totals.get((k, size), 0) + smooth * (len(table) + 1) for k in self.langs]
            self.logs.append((np.log(table) - np.log(below)).astype(np.float32))

    def score(self, word: str) -> np.ndarray:
        """Log scores of a lower-case word by language."""
        if (row := self.rows[0].get(word)) is not None:
            return self.logs[0][row]
        for size in range(LONGEST, 0, -1):
            text = word if size == 1 else f"^{word}$"
            known = self.rows[size]
            found = [r for i in range(len(text) - size + 1) if (r := known.get(text[i : i + size])) is not None]
            if found:
                return self.logs[size][found].mean(0)
        return np.zeros(len(self.langs), np.float32)


class Scores(dict):
    """Row numbers of words in a growing matrix of scores, remembered up to a bound."""

    def __init__(self, model: Model, most: int = 300_000):
        super().__init__()
        self.model, self.most = model, most
        self.rows = np.zeros((1024, max(1, len(model.langs))), np.float32)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at, : len(self.model.langs)] = self.model.score(word)
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        if len(self) > self.most:
            self.clear()
        found = words_of(text) if text else []
        if not found or not self.model.langs:
            return UNKNOWN, 0.0
        at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        scores = self.rows[at]
        mean = scores.sum(0, dtype=np.float64) / max(1, np.count_nonzero(scores.any(1)))
        odds = np.exp(mean - mean.max())
        best = int(mean.argmax())
        return self.model.langs[best], float(odds[best] / odds.sum())


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, text_col: str = "text", lang_col: str = "lang", known_words: int | None = None, known_grams: int | None = None) -> Model:
    """The model of the labelled rows of docs, from a sample of about `train_docs` different texts a language.

    The sample is by hash, from the whole table, all texts of a language that has no more. Copies of a text in a
    language count as one, so they neither keep a language out of the sample nor make it large. Counts of words and
    n-grams are summed by Spark, a row for each entry of a task; all come to the driver and to the tasks, so what the
    sample holds bounds the model. `known_words` and `known_grams`, where given, keep no more than so many words and
    n-grams of each length a language, the most frequent, ties in the entries' order. The label values must fit the
    driver. Rows with a null language or text teach nothing; null ids teach like others; texts are counted whole,
    however long; an empty table gives a model without languages.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in rows.select("lang", F.xxhash64("text").alias("key")).distinct().groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [], {})
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_docs / n))])
    some = rows.filter(unit_hash("text") < shares[F.col("lang")]).dropDuplicates(["lang", "text"]).select("lang", "text")

    def count(batches):
        by: dict[str, Counter] = {}
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(k, Counter()).update(words_of(t))
        for k, words in by.items():
            flat: Counter = Counter()
            for w, n in words.items():
                flat[0, w] += n
                for size, g in grams_of(w):
                    flat[size, g] += n
            columns = [[k] * len(flat), [x[0] for x in flat], [x[1] for x in flat], list(flat.values())]
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "size", "entry", "n"])

    counted = stored(some.mapInArrow(count, "lang string, size int, entry string, n long").groupBy("lang", "size", "entry").agg(F.sum("n").alias("n")), "counted")
    totals = {(r[0], r[1]): r[2] for r in counted.groupBy("lang", "size").agg(F.sum("n")).collect()}
    known = counted
    if known_words is not None or known_grams is not None:
        nth = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "entry"))
        most = F.when(F.col("size") == 0, F.lit(known_words)).otherwise(F.lit(known_grams))
        known = counted.withColumn("nth", nth).filter(F.coalesce(F.col("nth") <= most, F.lit(True)))
    known = known.select("lang", "size", "entry", "n").toArrow()
    columns = [known.column(i) for i in range(4)]
    learned = [k for k in sizes if totals.get((k, 0))]
    return Model(learned, ((a.as_py(), b.as_py(), c.as_py(), d.as_py()) for a, b, c, d in zip(*columns, strict=True)), totals)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: `und` and 0 for a null text or one without letters.

    The score is the best language's posterior share by the average word, words that say nothing left out: what one
    word of the text says for it, so it doesn't grow with the text's length; 1 / languages where nothing is known.

    Words are the runs of letters of the whole lower-cased text, however long. Languages that score alike go to the
    first by name. Repeated rows and null ids are each predicted; an empty table gives an empty result; a model
    without languages predicts `und`. Other columns don't matter."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scores = Scores(shipped.value)

        def work(batch: pa.RecordBatch):
            got = [scores.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

        return work

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(arrow_rows(make), "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Fits on the labelled rows outside the held-out fold (crc32 of the id as text) and predicts all rows.

    Rows with a null id are held out. For odd input see `fit` and `predict`."""
    part = F.coalesce(crc_mod(id_col, folds), F.lit(held_fold))
    model = fit(docs.filter(part != held_fold), text_col=text_col, lang_col=lang_col)
    got = predict(docs, model, id_col, text_col)
    return got.select("doc_id", (F.coalesce(crc_mod("doc_id", folds), F.lit(held_fold)) == held_fold).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1) -> DataFrame:
    """The documents whose language is told with a score of `least` or more.

    The model is fitted as in `identify`. Rows are judged where they stand: nothing is shuffled. Columns of any names
    come along; repeated rows and null ids are judged each; an empty table stays empty."""
    part = F.coalesce(crc_mod(id_col, folds), F.lit(held_fold))
    shipped = docs.sparkSession.sparkContext.broadcast(fit(docs.filter(part != held_fold), text_col=text_col, lang_col=lang_col))

    def make():
        scores = Scores(shipped.value)

        def work(batch: pa.RecordBatch):
            got = [scores.predict(t) for t in batch.column(text_col).cast(pa.string()).to_pylist()]
            yield batch.filter(pa.array([k != UNKNOWN and s >= least for k, s in got], pa.bool_()))

        return work

    return docs.mapInArrow(arrow_rows(make), docs.schema)
