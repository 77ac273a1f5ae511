"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import align, exact, hamming, langid, mixing, near, ngram_lm, packing, quality, repair, sharding, token_counts, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, posterior quality and verdict of every document."""
    got = quality.judge_quality(_read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from those outside the held-out third."""
    return langid.identify(_read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, revisits resolved, and the archives read back."""
    path = warc.write_archives(_read(spark, sf_dir, "pages"))
    records = warc.resolve_revisits(warc.read_archives(spark, path, payloads=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


OP3_SQL = """
WITH h AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, url, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hexed FROM h
), b AS (
  SELECT page_id, url, payload_bytes, (
    SELECT string_agg(
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hexed, 5 * (CAST(i AS INT) // 4) + 1, 5) AS BIGINT) >> (5 * (3 - CAST(i AS INT) % 4))) & 31 AS INT) + 1, 1), '' ORDER BY i)
    FROM range(32) AS t(i)) AS payload_digest
  FROM d
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS leader FROM b
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = leader THEN NULL ELSE leader END AS refers_to, url
FROM m
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of 2048."""
    return packing.pack_documents(_read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and interpolated bigram scores of every document."""
    return ngram_lm.score_documents(_read(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes, equal texts together."""
    got = sharding.shard_by_bytes(_read(spark, sf_dir, "documents"), shards=40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors, by Hamming distance of sign codes, of each whose id is divisible by 50."""
    rows = _read(spark, sf_dir, "embeddings")
    return hamming.nearest(rows, rows.filter("vec_id % 50 = 0"), k=10)


OP8_SQL = """
WITH c AS (
  SELECT vec_id,
    CAST(list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS BIGINT) << (32 - i) ELSE 0 END FOR i IN range(1, 33)]) AS BIGINT) AS hi,
    CAST(list_sum([CASE WHEN embedding[i] > 0 THEN CAST(1 AS BIGINT) << (64 - i) ELSE 0 END FOR i IN range(33, 65)]) AS BIGINT) AS lo
  FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, CAST(bit_count(xor(q.hi, c.hi)) + bit_count(xor(q.lo, c.lo)) AS INTEGER) AS distance
  FROM c AS q, c WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM d
)
SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= 10
"""


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 5-word shingles, Jaccard similarity of 0.8 or more."""
    return near.jaccard_join(_read(spark, sf_dir, "documents"), threshold=0.8)


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[!-/:-@\[-`{-~]', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS shingles
  FROM w WHERE len(words) > 0
), n AS (
  SELECT doc_id, len(shingles) AS size FROM s
), e AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM e AS a JOIN e AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT p.a, p.b, 5 * p.inter >= 4 * (x.size + y.size - p.inter) AS linked, p.inter = x.size AND p.inter = y.size AS same
  FROM p JOIN n AS x ON x.doc_id = p.a JOIN n AS y ON y.doc_id = p.b
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM r JOIN l ON l.a = r.b AND l.linked
)
SELECT d.doc_id,
  least(d.doc_id, (SELECT min(b) FROM l WHERE l.a = d.doc_id AND l.same)) AS copy_id,
  (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS class_id,
  CAST((SELECT count(*) FROM l WHERE l.a = d.doc_id AND l.linked) AS BIGINT) AS n_links
FROM documents AS d
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in the stream that mixes the sources to tempered weights."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs).select("doc_id", "source", "mix_slot", "mix_offset", "in_mix")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's alignment of the byte-level and the SentencePiece tokenizer, and the counts of its linked ids."""
    return align.align_documents(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))[0]


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner of every document's text: of equal texts the row with the largest id stays."""
    return exact.exact_owners(_read(spark, sf_dir, "documents"), keep="largest")


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a rule, with its faults and its cheapest repair."""
    rows = repair.damaged(_read(spark, sf_dir, "conversations"))
    return repair.repair_report(repair.repair_conversations(rows))


#: crc32 of an ASCII text: each byte is mixed in, then eight bits are shifted out.
_CRC = "xor(list_reduce(flatten(list_transform(string_split({}, ''), lambda c: list_concat([CAST(ord(c) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295), 4294967295)"


def _way(z: str, cost: str, letter: str, line: str) -> str:
    """A way to a state (cost, audit, lines) with one edit more; null where there is none."""
    more = f" || chr(10) || {line}" if line else ""
    return f"CASE WHEN {z} IS NOT NULL THEN {{'c': {z}.c + {cost}, 'a': {z}.a || '{letter}', 'o': {z}.o{more}}} END"


def _with_insertions(source: str) -> str:
    """The four states with rows put in: a user row leads to 2, an assistant row from 2 to 3."""
    ins = lambda z, role: _way(z, "3", "I", f"'{role}:'")
    one = f"SELECT *, list_min([z2, {', '.join(ins(z, 'user') for z in ('z0', 'z1', 'z3'))}]) AS y2 FROM {source}"
    return f"SELECT * EXCLUDE (y2), y2, list_min([z3, {ins('y2', 'assistant')}]) AS y3 FROM ({one})"


def _edits(to: str, role: str, sources: tuple[str, ...], initial: str) -> str:
    """Keeping or re-roling a row from the sources, deleting it from the state itself."""
    stays = "fault NOT IN ('blank', 'duplicate')"
    ways = [_way(to, "4", "D", "")]
    for z in sources:
        ways.append(f"CASE WHEN {stays} AND ini = '{initial}' THEN {_way(z, 'cut', 'K', "role || ':' || text")} END")
        if role:
            ways.append(f"CASE WHEN {stays} THEN {_way(z, '(3 + cut)', 'R', f"'{role}:' || text")} END")
    return f"list_min([{', '.join(ways)}])"


OP13_SQL = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS nth
  FROM k WHERE fate <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d
), f AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault
  FROM o
), g AS (
  SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM f
), w AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS z0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS z1,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS z2, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS z3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_edits("z0", "", (), "")}, {_edits("z1", "", ("z0",), "s")}, {_edits("y2", "user", ("z0", "z1", "y3"), "u")}, {_edits("y3", "assistant", ("y2",), "a")}
  FROM (
    SELECT y.conv_id, g.i, z0, z1, y2, y3, role, text, ini, fault, cut
    FROM ({_with_insertions("w")}) AS y JOIN g ON g.conv_id IS NOT DISTINCT FROM y.conv_id AND g.i = y.i + 1
  )
), e AS (
  SELECT conv_id, list_min([z0, y3]) AS b FROM ({_with_insertions("w")}) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), s AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit, sha256(substr(b.o, 2)) AS repaired_sha256
FROM e LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


# --- what SQL can say of operators whose whole result it can't express ---

_TOKENS = r"list_filter(string_split_regex(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op1_quality."""
    return op1_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUALITY_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {_TOKENS.format("text")} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM t WHERE len(ws) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i+4], chr(10))) AS times FROM w),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM g WHERE times > 1) GROUP BY 1),
c AS (SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
"""


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op6_lm_score."""
    got = op6_lm_score(spark, sf_dir)
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


LM_SQL = rf"""
WITH d AS (SELECT doc_id, {_CRC.format("CAST(doc_id AS VARCHAR)")} % 10 = 0 AS held_out,
    list_append({_TOKENS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, chr(10)) AS ws FROM documents),
e AS (SELECT doc_id, held_out, unnest(ws) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM e WHERE NOT held_out GROUP BY 1),
n AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.1) / (n + 0.1 * (v + 1)))), 6) AS base_score
FROM e LEFT JOIN c ON c.w = e.w, n GROUP BY 1, 2
"""


def shard_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of op7_sharding: all rows, their sizes, shards within the largest group of the mean, whole groups, gapless slots."""
    got = op7_sharding(spark, sf_dir).join(_read(spark, sf_dir, "documents").select("doc_id", F.xxhash64("text").alias("t")), "doc_id")
    per = got.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"))
    shards = per.agg(F.count(F.lit(1)).alias("shards"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min((F.col("slots") == F.col("n")) & (F.col("last") == F.col("n") - 1)).alias("gapless"), (F.max("bytes") - F.min("bytes")).alias("spread"))
    groups = got.groupBy("t").agg(F.sum("size").alias("g"), F.countDistinct("shard").alias("s")).agg(F.max("g").alias("largest"), (F.max("s") == 1).alias("together"))
    return shards.join(groups).select("shards", "n", "bytes", "gapless", "together", (F.col("spread") <= F.col("largest")).alias("balanced"))  # one row each


SHARD_SQL = "SELECT CAST(40 AS BIGINT) AS shards, count(*) AS n, CAST(sum(coalesce(strlen(text), 0) + 16) AS BIGINT) AS bytes, true AS gapless, true AS together, true AS balanced FROM documents"


def mix_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of op10_mixing by source: all rows placed, each block's slot its own, and in the mix each full."""
    got = op10_mixing(spark, sf_dir)
    blocks = got.groupBy("source", "mix_slot").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("mix_offset").alias("places"), F.max("in_mix").alias("in_mix"))
    own = got.groupBy("mix_slot").agg(F.countDistinct(F.coalesce("source", F.lit(""))).alias("sources")).agg((F.max("sources") == 1).alias("own"))
    per = blocks.groupBy("source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks"), F.min((F.col("n") == F.col("places")) & (~F.col("in_mix") | (F.col("n") == 8))).alias("full"))
    return per.join(own).select("source", "n", "blocks", "full", "own")  # own is one row


MIX_SQL = "SELECT source, count(*) AS n, CAST(ceil(count(*) / 8) AS BIGINT) AS blocks, true AS full, true AS own FROM documents GROUP BY 1"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_langid, op3_warc, op4_packing, op5_token_counts, op6_lm_score, op7_sharding, op8_hamming, op9_ngram_join, op10_mixing, op11_alignment, op12_exact_dedup, op13_conversation_repair, quality_counts, lm_base_scores, shard_laws, mix_laws)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op8_hamming": OP8_SQL, "op9_ngram_join": OP9_SQL, "op12_exact_dedup": OP12_SQL, "op13_conversation_repair": OP13_SQL, "quality_counts": QUALITY_SQL, "lm_base_scores": LM_SQL, "shard_laws": SHARD_SQL, "mix_laws": MIX_SQL}
