"""Alignment of two tokenizers over the bytes of a text: byte-owner arrays, and the corpus's counts of linked ids."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

SPACE = "▁"
#: Documents that a task works on at a time; different linked pairs of documents after which a batch ends.
SLICE, BATCH_PAIRS = 256, 2_000_000
#: Chunks, and their characters, that a worker remembers.
MOST_CHUNKS, MOST_CHARS = 300_000, 8 << 20
#: Pairs of a group above which its links are counted by different ids, not laid out one by one.
WIDE = 4_096
#: Keys of a row of a batch's table of pairs.
KEY_ROW = 16_384

GROUPS = "array<struct<start:bigint,a:array<int>,b:array<int>>>"
ALIGNED = "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at binary, times binary, base long, keys array<long>, n array<long>"


def byte_level_pieces(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file: its letters stand for bytes, printable ones for themselves."""
    from tokenizers import Tokenizer

    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
    entries = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def spaced_pieces(path: str) -> list[bytes]:
    """The bytes of each id of a SentencePiece model: SPACE is a space, byte pieces are their bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    piece = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode()
    return [piece(i) for i in range(model.get_piece_size())]


def owner_groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The groups of two sequences of tokens over the same bytes: each A and each B token's group, and the overlaps.

    Each byte is given the number of the A token and of the B token that own it. Where both owners change at once there
    is a cut, and the cuts make the groups; each different pair of owners is an overlap (A token, B token)."""
    a_owner, b_owner = np.repeat(np.arange(len(a_sizes)), a_sizes), np.repeat(np.arange(len(b_sizes)), b_sizes)
    a_new, b_new = np.diff(a_owner, prepend=-1) != 0, np.diff(b_owner, prepend=-1) != 0
    group = np.cumsum(a_new & b_new) - 1
    either = a_new | b_new
    return group[np.cumsum(a_sizes) - a_sizes], group[np.cumsum(b_sizes) - b_sizes], a_owner[either], b_owner[either]


def group_links(a_group: np.ndarray, b_group: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray, b_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All A-B links of each group: key (A id * b_count + B id), times and group."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    na, nb = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    first = np.cumsum(nb) - nb
    narrow = (na * nb <= WIDE)[a_group]
    many = np.where(narrow, nb[a_group], 0)
    a_at = np.repeat(np.arange(len(a_group)), many)
    b_at = np.arange(len(a_at)) - np.repeat(np.cumsum(many) - many, many) + first[a_group[a_at]]
    keys, times, where = [a_ids[a_at] * b_count + b_ids[b_at]], [np.ones(len(a_at), np.int64)], [a_group[a_at]]
    for g in np.flatnonzero(na * nb > WIDE):
        a, a_n = np.unique(a_ids[a_group == g], return_counts=True)
        b, b_n = np.unique(b_ids[b_group == g], return_counts=True)
        keys.append((a[:, None] * b_count + b).ravel())
        times.append((a_n[:, None] * b_n).ravel())
        where.append(np.full(len(a) * len(b), g))
    return np.concatenate(keys), np.concatenate(times), np.concatenate(where)


class Aligner:
    """Aligns texts by their chunks, remembered up to a bound.

    A chunk is a space and what follows up to the next single space: there both tokenizers begin a token, as no token of
    either holds a space behind another character, so a text's tokens and groups are those of its chunks. A text of
    which a chunk's tokens don't spell the chunk is aligned as a whole."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a_tok, self.b_tok = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_tok.encode_special_tokens = True
        self.a_bytes, self.b_bytes = byte_level_pieces(a_path), spaced_pieces(b_path)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        self.b_count = len(self.b_bytes)
        self.clear()

    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.spelt: list[bool] = []
        self.groups: list[str] = []
        self.figures = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.starts, self.keys, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.chars = 0

    @staticmethod
    def cut(text: str) -> list[str]:
        """The chunks, without the space before each; a run of white space is not cut."""
        parts = text.split(" ")
        if all(parts) and not any(p[0].isspace() for p in parts):
            return parts
        out: list[list[str]] = []
        open_ = False
        for p in parts:
            if out and (open_ or not p or p[0].isspace()):
                out[-1].append(p)
            else:
                out.append([p])
            open_ = not p
        return [" ".join(x) for x in out]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a_tok.encode_batch_fast([f" {c}" for c in chunks], add_special_tokens=False)], self.b_tok.encode(chunks, num_threads=1)

    def learn(self, chunks: list[str]) -> None:
        """Encodes and aligns chunks that aren't known yet, all at once."""
        a, b = self.encode(chunks)
        spell = lambda ids, pieces: b"".join([pieces[i] for i in ids])
        spelt = []
        for k, c in enumerate(chunks):
            want = f" {c}".encode()
            ok = spell(b[k], self.b_bytes) == want and spell(a[k], self.a_bytes) == want
            spelt.append(ok)
            if not ok:
                a[k], b[k] = [], []
        sizes_a, sizes_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        a_group, b_group, _, _ = owner_groups(self.a_sizes[a_ids], self.b_sizes[b_ids])
        keys, times, where = group_links(a_group, b_group, a_ids, b_ids, self.b_count)
        n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
        chunk = np.zeros(n_groups, np.int64)
        chunk[a_group] = np.repeat(np.arange(len(a)), sizes_a)
        owner = chunk[where]
        order = np.argsort(owner, kind="stable")
        per = np.bincount(owner, minlength=len(a))
        links = np.bincount(owner, times, minlength=len(a)).astype(np.int64)
        self.figures = np.concatenate([self.figures, np.stack([sizes_a, sizes_b, np.bincount(chunk, minlength=len(a)), links], 1)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(per)])
        self.keys, self.times = np.concatenate([self.keys, keys[order]]), np.concatenate([self.times, times[order]])
        self.groups += self._spelt_groups(a_group, b_group, a_ids, b_ids, chunk, len(a))
        self.spelt += spelt
        self.chars += sum(map(len, chunks))

    @staticmethod
    def _spelt_groups(a_group: np.ndarray, b_group: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray, chunk: np.ndarray, many: int) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each chunk."""
        out: list[list[str]] = [[] for _ in range(many)]
        a_end, b_end = (np.cumsum(np.bincount(x, minlength=len(chunk))).tolist() for x in (a_group, b_group))
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        i = j = 0
        for g, (c, p, q) in enumerate(zip(chunk.tolist(), a_end, b_end, strict=True)):
            out[c].append(f"{a_text[i] if p == i + 1 else ','.join(a_text[i:p])}|{b_text[j] if q == j + 1 else ','.join(b_text[j:q])}")
            i, j = p, q
        return [";".join(x) for x in out]

    def rows_of(self, texts: list[str | None]) -> list[list[int]]:
        """The numbers of each text's chunks; none for a text that has no tokens."""
        if len(self.chunks) > MOST_CHUNKS or self.chars > MOST_CHARS:
            self.clear()
        cut = [self.cut(t) if t else [] for t in texts]
        self._know(dict.fromkeys(chain.from_iterable(cut)))
        rows = [list(map(self.chunks.__getitem__, c)) for c in cut]
        odd = [k for k, r in enumerate(rows) if not all(map(self.spelt.__getitem__, r))]
        self._know(dict.fromkeys(texts[k] for k in odd))
        for k in odd:
            whole = self.chunks[texts[k]]
            rows[k] = [whole] if self.spelt[whole] else []
        return rows

    def _know(self, chunks: dict[str, None]) -> None:
        new = [c for c in chunks if c not in self.chunks]
        if new:
            at = len(self.chunks)
            self.chunks.update(zip(new, range(at, at + len(new)), strict=True))
            self.learn(new)

    def pairs_of(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, key and times of each document's different linked pairs, in this order."""
        doc, row = np.repeat(np.arange(len(rows)), list(map(len, rows))), np.fromiter(chain.from_iterable(rows), np.int64)
        held, each = np.unique(doc << 32 | row, return_counts=True)
        doc, row = held >> 32, held & 0xFFFFFFFF
        many = self.starts[row + 1] - self.starts[row]
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.starts[row], many)
        doc, times = np.repeat(doc, many), self.times[at] * np.repeat(each, many)
        keys = self.keys[at]
        order = np.lexsort((keys, doc))
        doc, keys, times = doc[order], keys[order], times[order]
        first = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(keys, prepend=-1) != 0))
        return doc[first], keys[first], np.add.reduceat(times, first) if len(first) else times


def _aligned(a_path: str, b_path: str, batch_pairs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents in batches: their figures and pairs (places in the batch's table, times), then the table: keys, documents."""
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, batch, held, pairs = Aligner(a_path, b_path), TaskContext.get().partitionId() << 24, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([k for _, k, _ in held]) if held else np.zeros(0, np.int64)
            table, at, n = np.unique(keys, return_inverse=True, return_counts=True)
            columns: list[list] = [[] for _ in names]
            lo = 0
            for (figures, k, times) in held:
                mine = at[lo : lo + len(k)]
                lo += len(k)
                row = (batch, *figures, np.diff(mine, prepend=0).astype("<u4").tobytes(), times.astype("<u4").tobytes(), None, None, None)
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            for base in range(0, len(table), KEY_ROW):
                row = (batch, *[None] * 8, base, table[base : base + KEY_ROW].tolist(), n[base : base + KEY_ROW].tolist())
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
            for at_ in range(0, whole.num_rows, 1024):
                yield whole.slice(at_, 1024)

        for got in batches:
            ids, texts = got.column(0).to_pylist(), got.column(1).to_pylist()
            for lo in range(0, len(ids), SLICE):
                rows = aligner.rows_of(texts[lo : lo + SLICE])
                doc, keys, times = aligner.pairs_of(rows)
                ends = np.searchsorted(doc, np.arange(len(rows) + 1))
                for k, r in enumerate(rows):
                    digest = hashlib.sha256(";".join(map(aligner.groups.__getitem__, r)).encode()).hexdigest() if r else ""
                    figures = aligner.figures[r].sum(0).tolist() if r else [0] * 4
                    held.append(((ids[lo + k], *figures, digest), keys[ends[k] : ends[k + 1]], times[ends[k] : ends[k + 1]]))
                pairs += len(keys)
                if pairs > batch_pairs:
                    yield from out()
                    batch, held, pairs = batch + 1, [], 0
        yield from out()

    return run


def _answered(docs: pa.Table, table: pa.Table) -> pa.Table:
    """A batch's documents with what their links' pairs come to."""
    size = table.num_rows
    counts, best = np.zeros(size, np.int64), np.zeros(size, bool)
    at = table.column("at").to_numpy()
    counts[at], best[at] = table.column("count").to_numpy(), table.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for places, times in zip(docs.column("at").to_pylist(), docs.column("times").to_pylist(), strict=True):
        where, n = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64)), np.frombuffer(times, "<u4").astype(np.int64)
        sums.append(int((counts[where] * n).sum()))
        bests.append(int(n[best[where]].sum()))
    out = [docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), docs.column("groups_sha256")]
    return pa.table(out, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", batch_pairs: int = BATCH_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Each document's alignment in figures, and the corpus's table of linked ids: (documents, pairs).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A is a byte-level tokenizer file,
    applied to a space and the text, B a SentencePiece model, applied to the text, before which it puts a space itself;
    special tokens' strings are plain text. Offsets at which a token of both ends cut the bytes into groups; an A and a B
    token of the same group are linked. pairs: a_id, b_id, count (documents that hold the pair linked), best (no other B
    id is linked with the A id in more). n_best: a document's links whose pair is best; count_sum: the counts of its
    links added up; groups_sha256: of the ids by group, as `spelt_groups` has them.

    A task aligns its documents in batches; a batch keeps its different pairs in a table of its own, so a pair is one row
    a batch, however many documents hold it. These rows meet by pair for the counts and go back by batch; only the best
    count of each A id, as many numbers as its vocabulary has, is sent to all tasks.

    Null and empty texts, and texts that the tokens' bytes don't spell, have no tokens: zeros and ''. Repeated rows count
    as documents of their own; null ids stay; texts are aligned whole, however long; an empty table gives an empty result.
    Only the id and the text are read, so other columns' names don't matter.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    b_count = len(spaced_pieces(b_path))
    found = stored(rows.mapInArrow(_aligned(a_path, b_path, batch_pairs), ALIGNED), "aligned")
    each = found.filter("keys is not null").select("batch", "base", F.posexplode(F.arrays_zip("keys", "n")).alias("nth", "x"))
    each = each.select("batch", (F.col("base") + F.col("nth")).cast("int").alias("at"), F.col("x.keys").alias("key"), F.col("x.n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("key"))
    counted = stored(each.select("batch", "at", "key", total.alias("count")), "counted")
    a_id = F.expr(f"cast(key div {b_count} as int)")
    most = counted.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))  # a row an A id at most
    ranked = counted.withColumn("a_id", a_id).join(F.broadcast(most), "a_id").select("batch", "at", "key", "a_id", "count", (F.col("count") == F.col("most")).alias("best"))
    left = found.filter("keys is null").select("batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times").groupBy("batch")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    documents = left.cogroup(ranked.select("batch", "at", "count", "best").groupBy("batch")).applyInArrow(_answered, schema)
    pairs = ranked.groupBy("key").agg(F.first("a_id").alias("a_id"), F.first("count").alias("count"), F.first("best").alias("best"))
    return documents, pairs.select("a_id", F.expr(f"cast(key % {b_count} as int)").alias("b_id"), "count", "best")


def spelt_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and groups: each group's first byte in the spaced text, and its A and B ids. For odd input see `align_documents`."""
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part, out = batch.slice(lo, SLICE), []
                for rows in aligner.rows_of(part.column(1).to_pylist()):
                    groups, start = [], 0
                    for g in ";".join(map(aligner.groups.__getitem__, rows)).split(";") if rows else ():
                        a, b = ([int(x) for x in side.split(",")] for side in g.split("|"))
                        groups.append({"start": start, "a": a, "b": b})
                        start += sum(len(aligner.a_bytes[i]) for i in a)
                    out.append(groups)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kinds)], names=["doc_id", "groups"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, groups {GROUPS}")
