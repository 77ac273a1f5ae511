"""Token counts of a unigram tokenizer without its pieces: Aho-Corasick matches and a count-only Viterbi."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows

SPACE = "▁"
#: An unknown character scores this much less than the worst piece.
UNK_PENALTY = 10.0


def load_pieces(path: str) -> list[tuple[str, float]]:
    """A unigram vocabulary: the pieces of a SentencePiece file, by id, with log probabilities by Zipf's law.

    The public files are of the merging kind: what they call scores are merge ranks, not log probabilities, and
    adding them up means nothing. So a piece's probability is taken as 1 / (its place in the file's order), over
    the sum of these; the file lists pieces in about the order of their frequency. Tokenizers are not trained here,
    so the rule stands in for a fit. Unknown, control, byte and unused pieces get the least probability. Counts are
    those of the Unigram tokenizer with this vocabulary, not of the merging tokenizer that the file describes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    special = [model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or (len(model.id_to_piece(i)) > 1 and not model.id_to_piece(i).strip(SPACE)) for i in range(n)]
    places = np.cumsum(~np.array(special, bool))
    total = math.log(sum(1 / k for k in range(1, int(places[-1]) + 1))) if n and places[-1] else 0.0
    least = -math.log(n + 1) - total
    return [(model.id_to_piece(i), least if special[i] else -math.log(int(places[i])) - total) for i in range(n)]


class Counter:
    """Counts a chunk's tokens as the `tokenizers` library's Unigram model with byte fallback would make them.

    Its tie rules: places are visited from left to right and a place keeps the first of equally good ways to
    reach it, which is the one with the longest last piece; a character without a piece of its own may be taken
    as unknown, after all pieces that end there, at the worst score less UNK_PENALTY; adjacent unknown
    characters become one, which is then spelt in bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]], unk_id: int = 0):
        import ahocorasick

        self.unk = pieces[unk_id][0]
        self.unk_score = min(s for _, s in pieces) - UNK_PENALTY
        ids = {p: i for i, (p, _) in enumerate(pieces)}
        self.spells = all(f"<0x{b:02X}>" in ids for b in range(256))
        self.auto = ahocorasick.Automaton()
        for p, i in ids.items():
            if p:
                self.auto.add_word(p, (len(p), pieces[i][1]))
        self.auto.make_automaton()

    def count(self, chunk: str) -> tuple[int, float]:
        """Tokens and best score of a chunk."""
        n = len(chunk)
        # by place: best score to reach it, tokens closed so far, the open unknown run's length in bytes, whether
        # that run is the unknown piece itself and no more
        best, tokens, run, lone = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        place, last, single = 0, None, False
        spelt_unk = self.unk in chunk

        def close(at: int) -> int:
            return tokens[at] + ((1 if lone[at] or not self.spells else run[at]) if run[at] else 0)

        def settle(end: int, score: float | None, size: int, single: bool) -> None:
            """Fixes the best way to reach `end`; size: of the best piece that ends there."""
            if not single:
                other = best[end - 1] + self.unk_score
                if score is None or other > score:
                    best[end], tokens[end] = other, tokens[end - 1]
                    run[end] = run[end - 1] + len(chunk[end - 1].encode("utf-8", "replace"))
                    return
            best[end] = score
            if spelt_unk and chunk[end - size : end] == self.unk:
                tokens[end], run[end], lone[end] = tokens[end - size], run[end - size] + size, run[end - size] == 0
            else:
                tokens[end] = close(end - size) + 1

        for at, (size, score) in self.auto.iter(chunk):
            end = at + 1
            while place < end - 1:
                place += 1
                settle(place, last[0] if last else None, last[1] if last else 0, single)
                last, single = None, False
            total = best[end - size] + score
            if last is None or total > last[0]:
                last = (total, size)
            single = single or size == 1
        while place < n:
            place += 1
            settle(place, last[0] if last else None, last[1] if last else 0, single)
            last, single = None, False
        return close(n), best[n]


class Chunks(dict):
    """Row numbers of chunks in growing arrays of counts and scores, remembered up to a bound."""

    def __init__(self, counter: Counter, most: int = 300_000):
        super().__init__()
        self.counter, self.most = counter, most
        self.counts, self.scores = np.zeros(1024, np.int64), np.zeros(1024)

    def __missing__(self, chunk: str) -> int:
        at = self[chunk] = len(self)
        if at == len(self.counts):
            self.counts, self.scores = np.concatenate([self.counts] * 2), np.concatenate([self.scores] * 2)
        self.counts[at], self.scores[at] = self.counter.count(SPACE + chunk)
        return at

    def of(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if len(self) > self.most:
            self.clear()
        chunks = text.replace(SPACE, " ").split(" ")
        if chunks[0] == "":  # the text begins with a space, so none is put before it
            del chunks[0]
        at = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
        return int(self.counts[at].sum()), float(self.scores[at].sum())


def count_tokens(docs: DataFrame, model_path: str, unk_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, n_tokens, score (of the best segmentation) of each whole text.

    Spaces become SPACE, one is put before the text, and the text is cut before each: no piece spans the cuts,
    so chunks are counted by themselves and remembered. Null and empty texts have no tokens. Repeated rows and null
    ids are counted each; texts are counted whole, however long; an empty table gives an empty result. Only the id
    and the text are read, so other columns' names don't matter.
    """

    def make():
        chunks = Chunks(Counter(load_pieces(model_path), unk_id))

        def work(batch: pa.RecordBatch):
            texts = batch.column(1).to_pylist()
            got = [chunks.of(t) for t in texts]
            columns = [batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "n_tokens", "score"])

        return work

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(arrow_rows(make), "doc_id long, n_chars long, n_tokens long, score double")
