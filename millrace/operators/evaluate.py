"""Reports: distributions, length and title statistics, completeness, retrieval and routing metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import classify as C
from millrace.functions import text as T


def _share(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(100 * part, whole), places)


def _count(test: Column) -> Column:
    return F.coalesce(F.count_if(test), F.lit(0))


def distribution(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Rows of each key and their share in percent, most first, equals by key."""
    n = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("_t"))
    return n.join(F.broadcast(total)).select(name, "n", _share(F.col("n"), F.col("_t")).alias("share_pct")).orderBy(F.desc("n"), name)


def purity_summary(df: DataFrame, score: str) -> DataFrame:
    s = F.col(score)
    return df.agg(F.avg(s).alias("mean"), _count(s >= 0.80).alias("high"), _count((s >= 0.70) & (s < 0.80)).alias("medium"), F.count(F.lit(1)).alias("n"))


def purity_calibration(df: DataFrame, score: str, gate: float) -> DataFrame:
    """Share of scores of 0.70 or more and under the gate, with a warning for under 5 % or over 40 % rejected."""
    got = df.agg(F.count(F.lit(1)).alias("n"), _share(F.count_if(F.col(score) >= 0.70), F.count(F.lit(1))).alias("high_pct"), _share(F.count_if(F.col(score) < gate), F.count(F.lit(1))).alias("rejected_pct"))
    return got.withColumn("warning", F.when(F.col("rejected_pct") < 5, "gate rejects little").when(F.col("rejected_pct") > 40, "gate rejects much"))


def granularity(sections: DataFrame, docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Sections a document on average, share of documents with one at most, and a warning over 30 %."""
    per = docs.select(doc).distinct().join(sections.groupBy(doc).agg(F.count(F.lit(1)).alias("n")), doc, "left")
    got = per.agg(F.avg(F.coalesce("n", F.lit(0))).alias("mean_sections"), _share(F.count_if(F.coalesce("n", F.lit(0)) <= 1), F.count(F.lit(1))).alias("coarse_pct"))
    return got.withColumn("warning", F.col("coarse_pct") > 30)


def cleanup_summary(df: DataFrame, content: str, duplicate: Column, invalid: Column) -> DataFrame:
    w = T.word_count(F.col(content))
    return df.agg(F.avg(w).alias("mean_words"), _share(F.count_if(w.between(75, 500)), F.count(F.lit(1))).alias("optimal_pct"), _count(duplicate).alias("duplicates"), _count(invalid).alias("invalid"))


def length_stats(df: DataFrame, content: str) -> DataFrame:
    n = F.length(content).cast("long")
    return df.agg(F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.avg(n).alias("mean_chars"), F.median(n).alias("median_chars"))


def length_buckets(df: DataFrame, content: str, low: int = 50, high: int = 1000, target_pct: float = 70) -> DataFrame:
    w = T.word_count(F.col(content))
    got = df.agg(_count(w < low).alias("short"), _count(w.between(low, high)).alias("optimal"), _count(w > high).alias("long"), F.count(F.lit(1)).alias("n"))
    return got.withColumn("optimal_pct", _share(F.col("optimal"), F.col("n"))).withColumn("good", F.col("optimal_pct") >= target_pct)


def title_issues(df: DataFrame, title: str) -> DataFrame:
    """Titles that are empty, short, long, not in capitals, with digits, or end in punctuation; and a verdict."""
    t = F.coalesce(F.col(title), F.lit(""))
    checks = {"empty": t == "", "short": (t != "") & (F.length(t) <= 5), "long": F.length(t) > 80, "mixed_case": (t != "") & ~T.is_upper(t), "with_digits": t.rlike(r"\d"), "punctuation": t.rlike(r"[^\w\s)]\z")}
    got = df.agg(*[_count(c).alias(k) for k, c in checks.items()], F.count(F.lit(1)).alias("n"))
    issues = sum((F.col(k) for k in checks), F.lit(0))
    return got.withColumn("verdict", F.when(issues == 0, "PERFECT").when(issues <= 0.05 * F.col("n"), "GOOD").otherwise("NEEDS WORK"))


def completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of rows in which each field is there (neither null nor empty), and their mean, in percent."""
    kinds = dict(df.dtypes)

    def there(c: str) -> Column:
        if kinds[c] == "string":
            return F.coalesce(T.strip(F.col(c)) != "", F.lit(False))
        if kinds[c].startswith("array"):
            return F.coalesce(F.size(c) > 0, F.lit(False))
        return F.col(c).isNotNull()

    got = df.agg(*[F.round(100 * F.avg(there(c).cast("int")), 2).alias(f"{c}_pct") for c in fields])
    return got.withColumn("mean_pct", F.round(sum((F.col(f"{c}_pct") for c in fields), F.lit(0.0)) / len(fields), 2))


def duplicate_counts(df: DataFrame, title: str, content: str, prefix: int = 100) -> DataFrame:
    """Rows beyond the first of equal titles, content prefixes, contents and stripped contents."""
    extra = lambda c: (F.count(c) - F.countDistinct(c))
    return df.agg(extra(F.col(title)).alias("titles"), extra(F.substring(content, 1, prefix)).alias("prefixes"), extra(F.md5(content)).alias("contents"), extra(F.md5(T.strip(F.col(content)))).alias("stripped"))


def issue_histogram(df: DataFrame, issues: str) -> DataFrame:
    """How often each kind of issue occurs; a kind is what stands before a bracket."""
    kind = F.trim(F.substring_index(F.col("issue"), "(", 1))
    return df.select(F.explode(issues).alias("issue")).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def validation_summary(df: DataFrame, issues: str) -> DataFrame:
    ok = F.size(issues) == 0
    return df.agg(F.count(F.lit(1)).alias("total"), _count(ok).alias("valid"), _count(~ok).alias("invalid"), _share(F.count_if(ok), F.count(F.lit(1))).alias("valid_pct"))


def routing_accuracy(df: DataFrame, predicted: str, label: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), _count(F.col(predicted) == F.col(label)).alias("correct"), _share(F.count_if(F.col(predicted) == F.col(label)), F.count(F.lit(1))).alias("accuracy_pct"))


def chunk_sizes(df: DataFrame, content: str, most: int = 800) -> DataFrame:
    """Smallest, largest and mean length of chunks, and how many are longer than `most` characters."""
    n = F.length(content).cast("long")
    return df.agg(F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.avg(n).alias("mean_chars"), _count(n > most).alias("oversized"))


def check_summary(results: DataFrame, status: str = "status") -> DataFrame:
    """Of checks with a status pass, warn or fail: how many of each, of all, and whether none failed."""
    s = F.lower(F.col(status))
    got = results.agg(_count(s == "pass").alias("passed"), _count(s == "warn").alias("warned"), _count(s == "fail").alias("failed"), F.count(F.lit(1)).alias("total"))
    return got.withColumn("ok", F.col("failed") == 0)


QUERY_SET = "set string, qid int, query string, label string, expected array<string>, min_score double"


def labelled_queries(spark: SparkSession, path: str) -> DataFrame:
    """The labelled query sets of a JSON array: set, qid, query, label, expected, min_score; fields left out are null.

    A query to be routed has a label, one to be answered expected keywords and a least score."""
    return spark.read.schema(QUERY_SET).option("multiLine", True).json(path)


def retrieval_report(hits: DataFrame, queries: DataFrame, content: str) -> DataFrame:
    """Status of each query by its hits (query_id, score, `content`) and its expected keywords and least score:
    query_id, top_score, keywords (how many of them occur in its hits), status. A query without hits fails."""
    low = F.lower(F.concat_ws(" ", F.collect_list(F.col(content))))
    per = hits.groupBy("query_id").agg(F.max("score").alias("top_score"), low.alias("_t"))
    joined = queries.select("query_id", "expected", "min_score").join(per, "query_id", "left")
    n = F.size(F.filter(F.coalesce("expected", F.array().cast("array<string>")), lambda w: F.contains(F.coalesce(F.col("_t"), F.lit("")), F.lower(w))))
    score = F.coalesce("top_score", F.lit(0.0))
    return joined.select("query_id", score.alias("top_score"), n.alias("keywords"), C.retrieval_status(score, F.coalesce("min_score", F.lit(0.0)), n).alias("status"))


def retrieval_metrics(hits: DataFrame, title: str, complete: Column, good: float = 0.6, targets: Mapping[str, float] | None = None) -> DataFrame:
    """Of hits (query_id, rank, score, title, ...): share of queries whose first hit scores `good`, share of results
    whose title repeats among a query's results, share of complete metadata; and whether each meets its target."""
    t = {"good_pct": 60.0, "duplicate_pct": 15.0, "complete_pct": 95.0} | dict(targets or {})
    top = hits.filter("rank = 1").agg(_share(F.count_if(F.col("score") >= good), F.count(F.lit(1))).alias("good_pct"))
    same = hits.groupBy("query_id", title).agg(F.count(F.lit(1)).alias("c")).agg(_share(F.sum(F.col("c") - 1), F.sum("c")).alias("duplicate_pct"))
    full = hits.agg(_share(F.count_if(complete), F.count(F.lit(1))).alias("complete_pct"))
    one = top.join(same).join(full)  # one row each
    return one.withColumn("targets_met", (F.col("good_pct") >= t["good_pct"]) & (F.col("duplicate_pct") < t["duplicate_pct"]) & (F.col("complete_pct") >= t["complete_pct"]))


def tally(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of each combination of keys, such as (document, reason) of rejections."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def term_coverage(df: DataFrame, content: str, terms: Sequence[str]) -> DataFrame:
    """Each expected term and whether a record contains it. One pass: a list of terms is a parameter."""
    low = F.lower(F.col(content))
    got = df.agg(F.array(*[F.coalesce(F.bool_or(F.contains(low, F.lit(t.lower()))), F.lit(False)) for t in terms]).alias("f"))
    names = F.array(*[F.lit(t) for t in terms])
    return got.select(F.explode(F.arrays_zip(names.alias("term"), F.col("f").alias("found"))).alias("x")).select("x.term", "x.found")


def query_coverage(df: DataFrame, content: str, queries: Mapping[str, Sequence[str]], least: int = 2) -> DataFrame:
    """Queries and whether some record has `least` of their expected terms. One pass: queries are a parameter."""
    low = F.lower(F.col(content))
    hit = {q: sum((F.contains(low, F.lit(t.lower())).cast("int") for t in ts), F.lit(0)) >= least for q, ts in queries.items()}
    got = df.agg(F.array(*[F.coalesce(F.bool_or(h), F.lit(False)) for h in hit.values()]).alias("f"))
    return got.select(F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in hit]).alias("query"), F.col("f").alias("passed"))).alias("x")).select("x.query", "x.passed")


def smoke_checks(df: DataFrame, ids: str, content: str, title: Column, category: Column, source: str) -> DataFrame:
    """Eight structural checks in one row of counts of offending rows, and whether all are 0.

    Ids have to be unique, not only there."""
    blank = lambda c: F.coalesce(T.strip(c), F.lit("")) == ""
    got = df.agg(
        (F.count(F.lit(1)) == 0).cast("int").alias("empty_table"),
        _count(blank(F.col(ids))).alias("missing_id"),
        (F.count(ids) - F.countDistinct(ids)).alias("repeated_id"),
        _count(blank(F.col(content))).alias("missing_content"),
        _count(blank(title)).alias("missing_title"),
        _count(C.normal_category(category) == "unknown").alias("missing_category"),
        _count(blank(F.col(source))).alias("missing_source"),
        (F.count(content) - F.countDistinct(T.strip(F.col(content)))).alias("repeated_content"),
    )
    errors = sum((F.col(c) for c in got.columns), F.lit(0))
    return got.withColumn("passed", errors == 0)


def readiness(df: DataFrame, document: str, least: int = 30) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), _count(F.length(document) > least).alias("ready"))


def baseline_delta(now: DataFrame, before: DataFrame, key: str, content: str) -> DataFrame:
    """Rows and mean content length of each key now and before, missing as 0, with differences."""
    agg = lambda df, p: df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{p}_n"), F.avg(F.length(content)).alias(f"{p}_chars"))
    both = agg(now, "now").join(agg(before, "before"), key, "full_outer")
    c = lambda n: F.coalesce(F.col(n), F.lit(0))
    return both.select(key, c("now_n").alias("now_n"), c("before_n").alias("before_n"), (c("now_n") - c("before_n")).alias("delta"), _share(c("now_n") - c("before_n"), F.col("before_n")).alias("delta_pct"), F.round(c("now_chars") - c("before_chars"), 4).alias("delta_chars"))


def new_keys(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    return now.select(key).distinct().join(before.select(key).distinct(), key, "left_anti")


def marker_contamination(df: DataFrame, ids: str, content: str, markers: DataFrame, marker_id: str, marker: str, most_bytes: int = 16 << 20) -> DataFrame:
    """Records that contain a marker phrase in whole words: ids, marker_id. Markers without words are found nowhere.

    Markers of up to `most_bytes` in all are sent to all workers, which look each up by its longest word, the
    likeliest to be rare, in a record's words: records stay where they are. More markers are found by an equi-join
    on that word; then a record's text moves once."""
    phrase = markers.select(F.col(marker_id).alias("marker_id"), T.words(F.col(marker)).alias("mw")).filter(F.size("mw") > 0)
    anchor = F.array_max(F.transform("mw", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    heads = phrase.select("marker_id", F.concat(F.lit(" "), F.array_join("mw", " "), F.lit(" ")).alias("whole"), anchor.alias("word"))
    rec = df.select(F.col(ids).alias("id"), T.words(F.col(content)).alias("w"))
    size = heads.agg(F.coalesce(F.sum(F.octet_length("whole")), F.lit(0))).first()[0]
    if size <= most_bytes:
        heads = F.broadcast(heads)
    spaced = rec.select("id", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("t"), F.array_distinct("w").alias("w"))
    if size <= most_bytes:
        found = spaced.select("id", "t", F.explode("w").alias("word")).join(heads, "word")
    else:
        met = spaced.select("id", F.explode("w").alias("word")).join(heads, "word").select("id", "marker_id", "whole")
        found = met.join(spaced.select("id", "t"), "id")
    return found.filter(F.contains("t", F.col("whole"))).select(F.col("id").alias(ids), "marker_id").distinct()
