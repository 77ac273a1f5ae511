import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, quality

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(spark, odd):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a ", "b ", "é ", "a\n", "# ", "b\x0b", " "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for frame in (df, odd.select("doc_id", "text")):
        want = Counter((r.doc_id, *slow_counts(r.text)) for r in frame.collect())
        got = Counter(tuple(r) for r in quality.text_counts(frame).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        assert got == want


def test_vote_model_finds_the_bad_rule():
    rng = np.random.default_rng(0)
    n = 20_000
    good = rng.random(n) < 0.85
    votes = np.zeros((n, 3), int)
    for k, (hit, miss) in enumerate(((0.8, 0.01), (0.6, 0.02), (0.3, 0.3))):  # the third says nothing
        votes[:, k] = np.where(rng.random(n) < np.where(good, miss, hit), -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = quality.fit_votes(patterns, counts.astype(float))
    logit = m["prior"] + np.array([sum(m["odds"][k, int(v == 1)] for k, v in enumerate(row)) for row in votes])
    assert ((logit > 0) == good).mean() > 0.93
    assert m["accuracy"][0] > 0.9


def test_no_votes():
    m = quality.fit_votes(np.zeros((0, 4), int), np.zeros(0))
    assert m["odds"].shape == (4, 2)


def test_quality_edge_cases(odd, none):
    got = quality.judge_quality(odd)
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4))
    assert quality.judge_quality(none).count() == 0 and quality.keep_quality(none).count() == 0
    assert quality.keep_quality(odd).columns == odd.columns


def test_quality_against_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    r = quality.judge_quality(docs).join(labels.withColumnRenamed("quality", "gold"), "doc_id").filter("not base_failed")
    clean, junk = r.filter("gold = 1"), r.filter("gold = 0")
    assert clean.filter("kept").count() >= 0.98 * clean.count() and junk.filter("not kept").count() >= 0.9 * junk.count()


def test_words_first_then_shorter_grams():
    words = {"xx": Counter({"alpha": 5, "beta": 5}), "yy": Counter({"gamma": 5, "alpha": 1})}
    rows, totals = [], Counter()
    for k, c in words.items():
        for w, n in c.items():
            rows.append((k, 0, w, n))
            totals[k, 0] += n
            for size, g in langid.grams_of(w):
                rows.append((k, size, g, n))
                totals[k, size] += n
    grouped = Counter()
    for k, size, e, n in rows:
        grouped[k, size, e] += n
    m = langid.Model(list(words), [(*key, n) for key, n in grouped.items()], totals)
    assert m.score("alpha").argmax() == 0 and m.score("gamma").argmax() == 1
    five = m.rows[5]
    assert not any(f"^alphx$"[i : i + 5] in five for i in range(1, 3)) and m.score("alphx").argmax() == 0  # by ^alph
    assert m.score("mmm").argmax() == 1  # by single characters
    assert not m.score("qqq").any()


def test_langid_edge_cases(odd, none):
    got = langid.identify(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 10)} == {"und"}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert langid.identify(none).count() == 0 and langid.keep_identified(odd).columns == odd.columns
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_prediction_uses_the_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    one = langid.predict(docs, model)
    other = langid.predict(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), model)
    assert one.exceptAll(other).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert r.filter("lang = lang_pred").count() >= 0.98 * r.count()


@pytest.mark.parametrize("text,want", [(None, "und"), ("12 !", "und"), ("alpha", "xx")])
def test_scores_object(text, want):
    m = langid.Model(["xx"], [("xx", 0, "alpha", 2)], {("xx", 0): 2})
    assert langid.Scores(m).predict(text)[0] == want


def test_copies_neither_hide_a_language_nor_fill_the_sample(spark):
    one = [(None, f"palabra{c} otra{c} mas", "l" + c) for c in "abcdefgh" for _ in range(60)]
    many = [(i, "hot text here" if i % 2 else "rare " + "abcdefghij"[i % 10] * (i // 10 % 30 + 1), "zz") for i in range(2000)]
    docs = spark.createDataFrame(one + many, "doc_id long, text string, lang string")
    model = langid.fit(docs, train_docs=20)
    assert model.langs == [*["l" + c for c in "abcdefgh"], "zz"]
    got = {r.lang_pred for r in langid.predict(docs.filter("lang <> 'zz'"), model).collect()}
    assert got == set(model.langs) - {"zz"}


def test_predictions_against_slow(spark, odd):
    from test_pipeline import slow_tongue

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.filter("doc_id < 150").unionByName(odd.select("doc_id", "text", "lang"))
    rows = docs.collect()
    tell = slow_tongue([(r.lang, r.text) for r in rows if r.lang is not None and r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1])
    want = sorted((str(r.doc_id), *tell(r.text)) for r in rows)
    got = sorted((str(r.doc_id), r.lang_pred, r.score) for r in langid.identify(docs).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(abs(a[2] - b[2]) < 1e-4 for a, b in zip(got, want, strict=True))


def test_only_letters_make_words(spark):
    rows = [(1, "²"), (2, "½²"), (3, "Ⅷ"), (4, "一"), (5, "a½b"), (6, "_1٣")]
    model = langid.Model(["de", "en"], [("de", 1, "a", 3), ("en", 1, "b", 3)], {("de", 1): 3, ("en", 1): 3})
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [i for i in got if got[i] == "und"] == [1, 2, 3, 6]


def test_known_words_and_grams_can_be_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole, part = langid.fit(docs), langid.fit(docs, known_words=50, known_grams=60)
    assert all(len(p) <= (50 if size == 0 else 60) * len(part.langs) < len(w) for size, (w, p) in enumerate(zip(whole.rows, part.rows, strict=True)) if size not in (1, 2))
