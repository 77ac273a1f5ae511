"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from millrace.llm.common import WordHash, arrow_rows, fresh, mix, stored, text_bytes

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
#: Words of a window that may repeat.
WINDOW = 5
COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_distinct long, n_letters long, n_upper long, n_marks long, n_stops long"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _count_batch(texts: list[bytes | None], memo: WordHash) -> dict[str, np.ndarray]:
    docs = [t or b"" for t in texts]
    words = [t.split() for t in docs]
    sizes = np.array([len(w) for w in words], np.int64)
    hashes = [memo.of(w) for w in words]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    salt = mix(np.arange(1, len(docs) + 1, dtype=np.uint64))[doc]
    ends = np.repeat(np.cumsum(sizes), sizes)

    distinct = np.bincount(doc[np.unique(mix(flat + salt), return_index=True)[1]], minlength=len(docs)) if len(flat) else np.zeros(len(docs), np.int64)
    repeat = np.zeros(len(docs), np.int64)
    if len(flat) >= WINDOW:
        n = len(flat) - WINDOW + 1
        window = salt[:n].copy()
        for k in range(WINDOW):
            window = mix(window ^ (flat[k : k + n] + np.uint64(k)))
        inside = np.arange(n) + WINDOW <= ends[:n]
        _, where, times = np.unique(window, return_inverse=True, return_counts=True)
        # windows over a text's end are told apart by the next text's words only by chance: they never count
        good = np.bincount(where[inside], minlength=len(times))[where] >= 2
        hit = inside & good
        edge = np.zeros(len(flat) + 1, np.int64)
        at = np.flatnonzero(hit)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        covered = np.cumsum(edge[:-1]) > 0
        repeat = np.bincount(doc[covered], minlength=len(docs))

    def dup_lines(t: bytes) -> tuple[int, int]:
        lines = [x for x in t.split(b"\n") if x.strip(WHITE)]
        return len(lines), len(lines) - len(set(lines))

    lines = [dup_lines(t) for t in docs]
    without = lambda t, chars: len(t) - len(t.translate(None, chars))
    code_points = [len(t.decode("utf-8", "replace")) if not t.isascii() else len(t) for t in docs]
    return {
        "n_words": sizes,
        "word_chars": [c - without(t, WHITE) for t, c in zip(docs, code_points, strict=True)],
        "n_symbols": [without(t, SYMBOLS) for t in docs],
        "n_lines": [x[0] for x in lines],
        "n_dup_lines": [x[1] for x in lines],
        "n_repeat_words": repeat,
        "n_distinct": distinct,
        "n_letters": [without(t, _LETTERS) for t in docs],
        "n_upper": [without(t, _UPPER) for t in docs],
        "n_marks": [without(t, _MARKS) for t in docs],
        "n_stops": [t.count(b". ") + t.count(b".\n") + t.endswith(b".") for t in docs],
    }


NAMES = [x.split()[0] for x in COUNTS.split(", ")]


def beside_counts(docs: DataFrame, text_col: str = "text", name: str = "counts") -> DataFrame:
    """docs with a struct column `name` of the counts of COUNTS of each whole text; rows stay where they are.

    Words are runs without ASCII white space. n_repeat_words: words in 5-word windows found twice or more in the
    text, the first included. n_dup_lines: lines with a word that equal an earlier line. A null or empty text has
    zeros; a text is counted whole, however long; an empty table stays empty."""
    at = docs.columns.index(text_col)

    def make():
        memo = WordHash()

        def work(batch: pa.RecordBatch):
            got = _count_batch(text_bytes(batch.column(at)), memo)
            counts = pa.StructArray.from_arrays([pa.array(got[n], pa.int64()) for n in NAMES], names=NAMES)
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, name])

        return work

    schema = StructType([*docs.schema.fields, StructField(name, _parse_datatype_string(COUNTS))])
    return docs.mapInArrow(arrow_rows(make), schema)


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of `beside_counts`, one row a document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return beside_counts(rows).select("doc_id", "counts.*")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Each rule's vote on the counts: -1 bad, 1 good, 0 for an abstention."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    length = F.col("word_chars") / words
    never = F.lit(False)
    return {
        "symbols": _vote(F.col("n_symbols") > 0.1 * words, F.col("n_symbols") <= 0.01 * words),
        "capitals": _vote(share("n_upper", "n_letters") > 0.3, never),
        "marks": _vote(share("n_marks", "word_chars") > F.when(F.col("n_words") < 40, 0.25).otherwise(0.12), never),
        "repeats": _vote(F.col("n_repeat_words") > 0.2 * words, never),
        "lines": _vote((F.col("n_dup_lines") > 0.5 * F.col("n_lines")) & (F.col("n_lines") > 2), never),
        "variety": _vote((F.col("n_words") >= 30) & (F.col("n_distinct") <= 0.2 * words), (F.col("n_words") >= 40) & (F.col("n_distinct") > 0.35 * words)),
        "word_length": _vote((length < 2) | (length > 15), never),
        "letters": _vote((F.col("n_words") >= 40) & (share("n_letters", "word_chars") < 0.7), never),
        "sentences": _vote((F.col("n_words") >= 40) & (F.col("n_stops") * 100 < F.col("n_words")), (F.col("n_stops") * 40 > F.col("n_words")) & (F.col("n_stops") * 2 < F.col("n_words"))),
    }


def fit_votes(patterns: np.ndarray, weights: np.ndarray, rounds: int = 100) -> dict[str, np.ndarray]:
    """Class-conditional vote probabilities and the share of good texts, by expectation-maximisation.

    patterns: different vote vectors (-1, 0, 1); weights: their numbers. The start trusts each rule: a text with
    a bad vote starts as likely bad. Counts are smoothed by a prior in which a rule is right rather than wrong,
    so the classes keep their meaning. An abstention says nothing. Returns log prior odds, and for each rule the
    log odds of good that each vote adds, plus the estimated accuracies among votes cast.
    """
    n_rules = patterns.shape[1] if patterns.ndim == 2 else 0
    bads, goods = (patterns == -1).sum(1), (patterns == 1).sum(1)
    good = np.where(bads == 0, 0.95, np.where(bads == 1, 0.35, 0.05)) * np.where(goods == 0, 0.8, 1.0)
    onehot = np.stack([patterns == v for v in (-1, 1)], 2).astype(float)  # pattern, rule, vote
    total = max(weights.sum(), 1.0)
    pull = 0.02 * total
    prior_good = np.array([0.02, 0.98]) * pull
    prior_bad = np.array([0.60, 0.40]) * pull
    for _ in range(rounds):
        w1, w0 = weights * good, weights * (1 - good)
        p1 = np.einsum("p,prv->rv", w1, onehot) + prior_good
        p0 = np.einsum("p,prv->rv", w0, onehot) + prior_bad
        p1, p0 = p1 / p1.sum(1, keepdims=True), p0 / p0.sum(1, keepdims=True)
        share = np.clip((w1.sum() + 0.5 * pull) / (total + pull), 0.02, 0.98)
        prior = math.log(share / (1 - share))
        odds = np.log(p1) - np.log(p0)
        new = 1 / (1 + np.exp(-np.clip(prior + np.einsum("prv,rv->p", onehot, odds), -60, 60)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    cast = weights[:, None] * (patterns != 0)
    right = weights[:, None] * ((patterns == 1) * good[:, None] + (patterns == -1) * (1 - good)[:, None])
    accuracy = right.sum(0) / np.maximum(cast.sum(0), 1e-9) if n_rules else np.zeros(0)
    return {"prior": np.array(prior), "odds": odds, "accuracy": accuracy}


def _judged(counts: DataFrame, threshold: float, min_words: int, max_repeat_percent: int) -> DataFrame:
    """counts with a vote column a rule, quality, base_failed and kept.

    The model sees only how many documents cast each vote vector (3 ** rules at most, whatever the input), so
    the fit covers all rows."""
    voted = counts.select("*", *[v.alias(f"vote_{k}") for k, v in rules().items()])
    names = [f"vote_{k}" for k in rules()]
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    seen = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([[r[n] for n in names] for r in seen], np.int64).reshape(-1, len(names))
    model = fit_votes(patterns, np.array([r["n"] for r in seen], float))
    logit = F.lit(float(model["prior"]))
    for n, odds in zip(names, model["odds"], strict=True):
        logit = logit + F.when(F.col(n) == -1, float(odds[0])).when(F.col(n) == 1, float(odds[1])).otherwise(0.0)
    judged = voted.withColumn("quality", 1 / (1 + F.exp(-logit))).withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def judge_quality(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Counts, votes, the posterior probability of good quality and the verdict, one row a document.

    kept: not base_failed (under min_words words, or over max_repeat_percent of the words in repeated windows)
    and quality >= threshold. Null and empty texts fail the base. Repeated rows and null ids are judged each;
    texts are judged whole, however long; an empty table gives an empty result. Only the id and the text are
    read, so other columns' names don't matter."""
    return _judged(stored(text_counts(docs, id_col, text_col), "counts"), threshold, min_words, max_repeat_percent)


def keep_quality(docs: DataFrame, threshold: float = 0.5, text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """The documents that `judge_quality` would keep, with the columns of docs, each row as often as it came.

    The rows are written once with their counts beside them, and that table is filtered: nothing is shuffled but
    the numbers of vote vectors. Columns of any names may come along; null ids, ties and repeated rows need no
    rule, as a row's verdict rests on its own text; an empty table stays empty."""
    name = fresh(docs, "counts")
    beside = stored(beside_counts(docs.withColumn(text_col, F.col(text_col).cast("string")), text_col, name), "beside")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = _judged(beside.select(row, F.col(f"`{name}`.*")), threshold, min_words, max_repeat_percent)
    return judged.filter("kept").select("_row.*")
