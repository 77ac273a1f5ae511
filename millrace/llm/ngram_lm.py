"""Language-model scores by deleted interpolation of word bigrams, counts kept in hash partitions.

No table of counts is ever in one place. Texts become batches of token numbers with the batch's own vocabulary.
A batch asks for the counts of its different n-grams: one block of sorted hashes for each hash partition, with the
batch's own multiplicities. A partition adds up all multiplicities it was sent and answers each block with totals,
in the block's order. Both batches and partitions grow in size with the root of the corpus, so their numbers do too,
and the number of blocks, their product, grows in proportion to the corpus, until tasks are as large as they may be;
beyond that a block only gets smaller, and there is never more than one for each different n-gram of a batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHash, crc_mod, mix, stored, text_bytes

#: Text bytes of a batch, and tokens for which there is one hash partition, for a corpus of up to BASE_BYTES; by how
#: much they grow for larger ones at most.
BATCH_BYTES, PARTITION_TOKENS, BASE_BYTES, MOST_GROWTH = 8 << 20, 2_000_000, 1 << 30, 4.0
#: Parts that documents play: counted, counted and held out from the counts when weights are learned, only scored.
COUNTED, WEIGHING, SCORED = 0, 1, 2
#: Context frequencies 0, 1, 2-3, 4-7, ... share weights, those of 2 ** (BUCKETS - 2) and more too.
BUCKETS = 16
#: Steps of an octave to which probabilities are rounded when weights are learned, and octaves.
STEPS, OCTAVES = 4, 48

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END, _BEGIN = b"\n", b"\r"  # no word has white space
BATCHES = "batch long, part int, n_tokens long, doc_ids array<long>, lens binary, vocab binary, tokens binary"
BLOCKS = "p int, ngram int, batch long, part int, hashes binary, times binary"
ANSWERS = "batch long, ngram int, p int, part int, total binary, without binary, n_types long, n_types_without long"


#: Integer arrays of fewer bytes are stored as they are.
SMALL = 256
_RAW, _PACKED = b"\0", b"\1"


def _zip(x: np.ndarray) -> bytes:
    """An integer array by byte planes, compressed if that is worth it."""
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return _RAW + planes if len(planes) < SMALL else _PACKED + zstandard.ZstdCompressor(level=1).compress(planes)


def _unzip(data: bytes, kind: type) -> np.ndarray:
    rest = memoryview(data)[1:]
    raw = np.frombuffer(rest if data[:1] == _RAW else zstandard.ZstdDecompressor().decompress(rest), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _zip_sorted(x: np.ndarray) -> bytes:
    return _zip(np.diff(x, prepend=np.uint64(0)))


def _unzip_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unzip(data, np.uint64), dtype=np.uint64)


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "double": pa.float64(), "boolean": pa.bool_()}
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def growth(text_bytes_: int) -> float:
    """By how much batches and partitions are larger than for a corpus of BASE_BYTES."""
    return min(MOST_GROWTH, max(1.0, math.sqrt(text_bytes_ / BASE_BYTES)))


def token_batches(docs: DataFrame, id_col: str, text_col: str, folds: int, held_fold: int, weigh_fold: int, batch_bytes: int) -> DataFrame:
    """Documents of one part in batches of about `batch_bytes`: their tokens as numbers in the batch's sorted
    vocabulary of hashes, each text between a beginning and an end."""
    fold = F.coalesce(crc_mod(id_col, folds), F.lit(held_fold))
    part = F.when(fold == held_fold, SCORED).when(fold == weigh_fold, WEIGHING).otherwise(COUNTED).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), F.col(text_col).cast("string").alias("text"))

    def pack(batches):
        memo, made = WordHash(), 0
        first = TaskContext.get().partitionId() << 32
        begin, end = memo[_BEGIN], memo[_END]
        held: dict[int, list] = {}

        def flush(part: int) -> pa.RecordBatch:
            nonlocal made
            ids, hashes, _ = held.pop(part)
            flat = np.concatenate(hashes)
            vocab, tokens = np.unique(flat, return_inverse=True)
            lens = np.array([len(h) for h in hashes], np.uint32)
            made += 1
            row = [first + made, part, len(flat) - len(ids), ids, _zip(lens), _zip_sorted(vocab), _zip(tokens.astype(np.uint32))]
            return _batch([[x] for x in row], BATCHES)

        for batch in batches:
            for i, part, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
                words = (t or b"").translate(_LOWER).split()
                h = np.empty(len(words) + 2, np.uint64)
                h[0], h[-1], h[1:-1] = begin, end, memo.of(words)
                at = held.setdefault(part, [[], [], 0])
                at[0].append(i)
                at[1].append(h)
                at[2] += len(t or b"") + 16
                if at[2] >= batch_bytes:
                    yield flush(part)
        for part in sorted(held):
            yield flush(part)

    return rows.mapInArrow(pack, BATCHES)


def _bigrams(vocab: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs in a batch's texts, and the places of their second tokens."""
    at = np.flatnonzero(vocab[tokens] != np.uint64(WordHash()[_BEGIN]))
    h = mix(vocab)
    return mix(h[tokens[at - 1]] * np.uint64(3) + vocab[tokens[at]]), at


def _cuts(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    p = ((hashes >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)
    return p, np.flatnonzero(np.r_[True, p[1:] != p[:-1], True])


def _requests(batches: DataFrame, partitions: int) -> DataFrame:
    def ask(found):
        for some in found:
            for row in some.to_pylist():
                vocab, tokens = _unzip_sorted(row["vocab"]), _unzip(row["tokens"], np.uint32)
                pairs, _ = _bigrams(vocab, tokens)
                for ngram, (hashes, times) in enumerate(((vocab, np.bincount(tokens, minlength=len(vocab))), np.unique(pairs, return_counts=True)), 1):
                    p, cut = _cuts(hashes, partitions)
                    times = times.astype(np.uint32)
                    out = [(int(p[a]), ngram, row["batch"], row["part"], _zip_sorted(hashes[a:b]), _zip(times[a:b]) if row["part"] != SCORED else None) for a, b in zip(cut[:-1], cut[1:], strict=True) if b > a]
                    yield _batch([list(c) for c in zip(*out, strict=True)] if out else [[]] * 6, BLOCKS)

    return batches.mapInArrow(ask, BLOCKS)


def _answers(requests: DataFrame) -> DataFrame:
    """For each block its n-grams' totals over all counted texts, for those of the weighing part also the totals
    without that part, and for each partition a row (batch null) with the numbers of different words."""
    begin = WordHash()[_BEGIN]

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [_unzip_sorted(r["hashes"]) for r in rows]
        hashes, where = np.unique(np.concatenate(parts), return_inverse=True)
        sums = np.zeros((2, len(hashes)), np.int64)
        ends = np.cumsum([0, *map(len, parts)])
        places = [where[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for r, at in zip(rows, places, strict=True):
            if r["part"] != SCORED:
                sums[r["part"], at] += _unzip(r["times"], np.uint32)
        total, without = sums.sum(0).astype(np.uint64), sums[COUNTED].astype(np.uint64)
        out = [(r["batch"], r["ngram"], r["p"], r["part"], _zip(total[at]), _zip(without[at]) if r["part"] == WEIGHING else None, None, None) for r, at in zip(rows, places, strict=True)]
        if rows[0]["ngram"] == 1:
            word = hashes != np.uint64(begin)
            out.append((None, 1, rows[0]["p"], None, None, None, int((word & (total > 0)).sum()), int((word & (without > 0)).sum())))
        return pa.Table.from_batches([_batch([list(c) for c in zip(*out, strict=True)], ANSWERS)])

    return requests.groupBy("p", "ngram").applyInArrow(answer, ANSWERS)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never counted, else 1 + floor(log2) of its count, up to BUCKETS - 1."""
    return np.minimum(np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0), BUCKETS - 1).astype(np.int64)


def _counts(left: dict, right: list[dict], name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of a batch: its count, its pair's and its context's, and whether it is no beginning."""
    vocab, tokens = _unzip_sorted(left["vocab"]), _unzip(left["tokens"], np.uint32)
    pairs, at = _bigrams(vocab, tokens)
    found = {}
    for ngram in (1, 2):
        blocks = [_unzip(r[name], np.uint64) for r in sorted((r for r in right if r["ngram"] == ngram), key=lambda r: r["p"])]
        found[ngram] = np.concatenate(blocks).astype(np.float64) if blocks else np.zeros(0)
    _, where = np.unique(pairs, return_inverse=True)
    if len(found[1]) != len(vocab) or len(found[2]) != (where.max(initial=-1) + 1):
        raise ValueError("a batch was not answered in full")
    return found[1][tokens[at]], found[2][where], found[1][tokens[at - 1]], at, tokens


def interpolated(word: np.ndarray, pair: np.ndarray, context: np.ndarray, tokens: float, types: float) -> np.ndarray:
    """The three estimates to be mixed: of the pair, of the word, and of any of types + 1 words alike."""
    return np.stack([pair / np.maximum(context, 1), word / max(tokens, 1), np.full(len(word), 1 / (types + 1))])


def learn_weights(cells: list[tuple[int, int, int, int]], types: float, rounds: int = 200) -> np.ndarray:
    """Weights of the three estimates for each bucket of context frequencies, by expectation-maximisation.

    cells: (bucket, rounded log2 of the pair's and of the word's estimate, tokens), -1 for an estimate of 0. A
    bucket without tokens takes equal weights of what is left without pairs."""
    weights = np.full((3, BUCKETS), 1 / 3)
    if cells:
        b, e2, e1, n = np.array(cells, np.int64).T
        back = lambda e: np.where(e < 0, 0.0, 2.0 ** (-e / STEPS))
        p = np.stack([back(e2), back(e1), np.full(len(b), 1 / (types + 1))])
        for _ in range(rounds):
            got = weights[:, b] * p
            got *= n / got.sum(0)
            # a hundredth of a token each keeps all weights above 0
            sums = np.stack([np.bincount(b, g, minlength=BUCKETS) for g in got]) + 0.01
            new = sums / sums.sum(0)
            if np.abs(new - weights).max() < 1e-7:
                break
            weights = new
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0, weigh_fold: int = 1, alpha: float = 0.1) -> DataFrame:
    """Unigram and interpolated bigram log10 probabilities of all whole texts.

    Tokens: runs without ASCII white space, A-Z in lower case, and one end a text. Documents whose crc32 of the
    id as text modulo `folds` is held_fold are only scored; the others are counted. Of these, weigh_fold is the
    part that is deleted from the counts while the mixture weights are learned on it, and then put back. All
    counts cover all counted documents. Bigrams of a context, words, and a uniform share for any word are mixed
    with weights by the context's frequency; log10 probabilities add up to `score`. base_score is the unigram
    model with `alpha` added to each count.

    Null and empty texts are one end token. A null id is only scored. Repeated rows count and are scored each.
    Texts are scored whole, however long; ties don't arise. Without training documents every token gets
    1 / (0 + 1), log10 probability 0; an empty table gives an empty result. Only the id and the text are read.
    """
    spark = docs.sparkSession
    larger = growth(docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0])
    batches = token_batches(docs, id_col, text_col, folds, held_fold, weigh_fold, round(BATCH_BYTES * larger))
    batches = stored(batches, "batches", "uncompressed")
    sizes = {r[0]: r[1] for r in batches.groupBy("part").agg(F.sum("n_tokens")).collect()}
    without = sizes.get(COUNTED, 0)
    total = without + sizes.get(WEIGHING, 0)
    partitions = max(1, math.ceil(sum(sizes.values()) / (PARTITION_TOKENS * larger)))
    answers = stored(_answers(_requests(batches, partitions)), "answers", "uncompressed")
    types, types_without = answers.filter("batch is null").agg(F.coalesce(F.sum("n_types"), F.lit(0)), F.coalesce(F.sum("n_types_without"), F.lit(0))).first()
    answers = answers.filter("batch is not null").select("batch", "ngram", "p", "part", "total", "without")

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        rounded = lambda x: np.where(x > 0, np.clip(np.rint(-np.log2(np.maximum(x, 1e-300)) * STEPS), 0, OCTAVES * STEPS), -1).astype(np.int64)
        for row in left.to_pylist():
            word, pair, context, _, _ = _counts(row, right.to_pylist(), "without")
            p = interpolated(word, pair, context, without, types_without)
            base = OCTAVES * STEPS + 2
            key, n = np.unique((bucket_of(context) * base + rounded(p[0]) + 1) * base + rounded(p[1]) + 1, return_counts=True)
            out.append(_batch([key // base // base, key // base % base - 1, key % base - 1, n], "b long, e2 long, e1 long, n long"))
        return pa.Table.from_batches(out)

    weigh = f"part = {WEIGHING}"
    seen = batches.filter(weigh).groupBy("batch").cogroup(answers.filter(weigh).groupBy("batch")).applyInArrow(cells, "b long, e2 long, e1 long, n long")
    # at most BUCKETS * (OCTAVES * STEPS + 2) ** 2 rows, whatever the input
    weights = learn_weights([tuple(r) for r in seen.groupBy("b", "e2", "e1").agg(F.sum("n").alias("n")).collect()], types_without)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            word, pair, context, _, _ = _counts(row, right.to_pylist(), "total")
            p = (weights[:, bucket_of(context)] * interpolated(word, pair, context, total, types)).sum(0)
            n = _unzip(row["lens"], np.uint32).astype(np.int64) - 1
            start = np.cumsum(n) - n
            base = np.log10((word + alpha) / (total + alpha * (types + 1)))
            add = lambda x: np.add.reduceat(x, start)  # noqa: E731, B023
            k = len(n)
            out.append(_batch([row["doc_ids"], [row["part"] == SCORED] * k, n, add((word > 0).astype(np.int64)), [total] * k, add(base), add(np.log10(p))], schema))
        return pa.Table.from_batches(out)

    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)
