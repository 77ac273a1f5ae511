"""Best-fit packing of token pieces into sequences by bin completion over the histogram of lengths."""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, salted_rank, salts_for, stored, text_bytes

#: Nodes that the branch-and-bound visits before it settles for its incumbent.
MOST_NODES = 6_000
#: At every so manieth node the rest is packed by best fit, for a better incumbent.
EACH = 32
#: Fillings that a node branches on at a time, those of least waste; steps of the enumeration between two of its sorts.
MOST_FILLINGS = 12
STEPS = 1_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

Bins = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, times), ...) of a bin, and how many such bins


#: Pieces into which the tokenizer's pattern cuts lower-case Latin text without apostrophes.
_LATIN = re.compile(r"[^\W\d_]+|\d|(?:[^\w]|_)+")
_PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-įı-ňŊ-ſ]*")
#: The byte-level alphabet of public BPE vocabularies: printable bytes stand for themselves, others follow from 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class ChunkIds(dict):
    """Token ids, as little-endian uint32 bytes, of chunks between ASCII white space, remembered up to a bound.

    The tokenizer drops white space and no token spans it, so a text's ids are its chunks' ids joined. Unknown
    chunks of plain Latin letters, digits and ASCII marks are cut as the tokenizer cuts them, and the pieces go
    to its BPE model directly; all others are encoded by the whole tokenizer.
    """

    def __init__(self, path: str, most: int = 500_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tok, self.most = Tokenizer.from_file(path), most
        self.model = self.tok.model
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def plain(text: str) -> bool:
        """Whether a chunk has only composed Latin letters below U+0180, digits and printable ASCII marks, and
        nothing that the tokenizer treats by context (apostrophes, special tokens)."""
        return _PLAIN.fullmatch(text) is not None

    def piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            raw = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            got = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in self.model.tokenize(raw)]) else b""
        return got

    def encode(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not self.plain(text):
            return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        text = text.lower()
        return self.piece(text) if text.isalpha() else b"".join(map(self.piece, _LATIN.findall(text)))

    def __missing__(self, chunk: bytes) -> bytes:
        got = self[chunk] = self.encode(chunk)
        return got

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
        if len(self.pieces) > self.most:
            self.pieces.clear()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, place_col: str | None = None) -> DataFrame:
    """Each document's ids, then `end_id`, cut into pieces of `capacity` where longer: one row a piece.

    doc_id, piece (from 0), start (the document's ids before it), length, ids_crc32 (of the little-endian
    uint32 ids), with `with_ids` the ids as bytes, and with `place_col` the document's place. A null or empty text has
    `end_id` alone; repeated rows have pieces each; null ids stay null; an empty table gives an empty result.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, *["place"] * (place_col is not None)]

    def make():
        memo, tail = ChunkIds(tokenizer_path), np.asarray([end_id], "<u4").tobytes()

        def work(batch: pa.RecordBatch):
            texts = [(t or b"").split() for t in text_bytes(batch.column(1))]
            memo.trim()
            docs_, pieces, starts, lengths, sums, parts, at_ = out = [[] for _ in range(7)]
            places = batch.column(2).to_pylist() if place_col is not None else [None] * len(texts)
            for i, chunks, place in zip(batch.column(0).to_pylist(), texts, places, strict=True):
                ids = b"".join([*map(memo.__getitem__, chunks), tail])
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    docs_.append(i)
                    pieces.append(k)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    at_.append(place)
                    if with_ids:
                        parts.append(part)
            columns = dict(zip(("doc_id", "piece", "start", "length", "ids_crc32", "ids", "place"), out, strict=True))
            kinds = {"piece": pa.int32(), "ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], kinds.get(n, pa.int64())) for n in names], names=names)

        return work

    place = [F.col(place_col).cast("long").alias("place")] if place_col is not None else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *place)
    return rows.mapInArrow(arrow_rows(make), PIECES + ", ids binary" * with_ids + ", place long" * len(place))


def best_fit(counts: Counter, capacity: int) -> Bins:
    """Best-fit decreasing over a histogram: all bins alike are filled in one step, so the work follows the
    number of different lengths, not of items."""
    open_bins: dict[int, list[list]] = {}  # room left: [filling, bins]
    rooms: list[int] = []
    done: Bins = []

    def put(room: int, filling: tuple, bins: int) -> None:
        if room == 0:
            done.append((filling, bins))
        elif bins:
            if room not in open_bins:
                open_bins[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            open_bins[room].append([filling, bins])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                room, filling, bins = capacity, (), left
            else:
                room = rooms[at]
                filling, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            each = room // size
            full, rest = divmod(left, each)
            if full >= bins:
                full, rest = bins, 0
            put(room - each * size, (*filling, (size, each)), full)
            if rest:
                put(room - rest * size, (*filling, (size, rest)), 1)
            left -= full * each + rest
            if filling and (spare := bins - full - bool(rest)):
                put(room, filling, spare)
    return done + [(f, n) for found in open_bins.values() for f, n in found]


def lower_bound(counts: Counter, capacity: int) -> int:
    """The Martello-Toth L2 bound: for each k, items over capacity - k stand alone, and those of k and more
    have to go into what the ones over half a bin leave."""
    n = np.zeros(capacity + 1, np.int64)
    for size, times in counts.items():
        n[size] = times
    sizes = np.arange(capacity + 1)
    count, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * sizes)])
    best, half = -(-int(total[-1]) // capacity), capacity // 2
    k = np.arange(1, half + 1)
    alone = count[-1] - count[capacity - k + 1]
    big, big_sum = count[capacity - k + 1] - count[half + 1], total[capacity - k + 1] - total[half + 1]
    small = total[half + 1] - total[k]
    return max(best, int((alone + big + np.maximum(0, -(-(small - (big * capacity - big_sum)) // capacity))).max(initial=0)))


def _fits(items: tuple[int, ...], holes: tuple[int, ...]) -> bool:
    """Whether items can be dealt to the holes within their sizes."""
    if not items:
        return True
    if sum(items) > sum(holes):
        return False
    return any(h >= items[0] and _fits(items[1:], (*holes[:i], h - items[0], *holes[i + 1 :])) for i, h in enumerate(holes))


def _grown(counts: Counter, sizes: list[int], gap: int) -> Iterator[tuple[int, tuple[int, ...]] | None]:
    """All fillings of a gap to which no item can be added, with the room left, those of the largest items first;
    None for each step without one."""
    used: Counter = Counter()
    taken: list[int] = []
    room = gap
    tries = [bisect_right(sizes, room) - 1]  # by items taken, the place in sizes of the next one to try
    new = True
    while True:
        if new:
            smallest = next((s for s in sizes if used[s] < counts[s]), room + 1)
            full = smallest > room
            yield (room, tuple(taken)) if full else None
            if full:
                tries[-1] = -1
        at, new = tries[-1], False
        if at >= 0:
            tries[-1] -= 1
            if used[sizes[at]] < counts[sizes[at]]:
                used[sizes[at]] += 1
                taken.append(sizes[at])
                room -= sizes[at]
                tries.append(min(at, bisect_right(sizes, room) - 1))
                new = True
        elif taken:
            tries.pop()
            used[taken[-1]] -= 1
            room += taken.pop()
        else:
            return


def filling_batches(counts: Counter, gap: int, most: int | None = None) -> Iterator[list[tuple[int, ...]]]:
    """Undominated fillings of a gap, in batches of `most` at most (MOST_FILLINGS), one batch at least.

    A filling dominates another if the other's items fit into its items' places; then a packing with the other
    can be exchanged for one with it. Fillings to which a remaining item could be added are left out. The
    enumeration stops after each STEPS steps, gives what it found, least waste first, and goes on when it is
    asked for more, until all have come.
    """
    most = most or MOST_FILLINGS
    sizes = sorted(s for s, n in counts.items() if n and s <= gap)
    if not sizes or sizes[-1] == gap:
        yield [(gap,)] if sizes else [()]  # an item that fills the gap dominates all others
        return
    walk, given, going = _grown(counts, sizes, gap), [], True
    while going:
        part = list(islice(walk, STEPS))
        going = len(part) == STEPS
        found = sorted(filter(None, part), key=lambda x: (x[0], len(x[1]), [-s for s in x[1]]))
        for at in range(0, len(found), 8 * most):
            kept: list[tuple[int, ...]] = []
            for _, f in found[at : at + 8 * most]:
                if not any(len(f) <= 6 and _fits(f, k) for k in given):
                    given.append(f)
                    kept.append(f)
                    if len(kept) == most:
                        yield kept
                        kept = []
            if kept:
                yield kept


def fillings(counts: Counter, gap: int) -> list[tuple[int, ...]]:
    """All undominated fillings of a gap, see `filling_batches`."""
    return [f for batch in filling_batches(counts, gap) for f in batch]


def bin_completion(counts: Counter, capacity: int, most_nodes: int | None = None) -> Bins:
    """Bins for all items of the histogram, as few as the search can find.

    The incumbent is best-fit decreasing; if its number of bins meets the lower bound it is optimal. Else the
    largest item's bin is completed by each undominated filling in turn, as many such bins at once as the
    histogram allows; a branch ends when its waste exceeds what a packing with one bin less could waste, or its
    lower bound doesn't beat the incumbent. At every EACH-th node, and where few lengths are left, the best-fit
    packing of the rest may become the incumbent.

    A node branches on its best fillings first. When all branches made so are done, the nodes are visited again,
    the first ones first, for their other fillings. The search ends when the incumbent meets the lower bound, when
    nothing is left to try, or after `most_nodes` visits (MOST_NODES). Taking as many alike bins at once as there can
    be leaves out packings that use a filling fewer times, so an incumbent above the lower bound is not proven best.
    """
    counts = Counter({s: n for s, n in counts.items() if n > 0})
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths have to be from 1 to {capacity}")
    total = sum(s * n for s, n in counts.items())
    best, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    most, nodes = sum(n for _, n in best), 0

    def children(left: Counter, made: tuple, bins: int, waste: int, batch: list[tuple[int, ...]]) -> Iterator[tuple]:
        size = max(left)
        for f in batch:
            use = Counter(f) + Counter({size: 1})
            times = min(left[s] // n for s, n in use.items())
            after = Counter({s: n - times * use[s] for s, n in left.items() if n > times * use[s]})
            filled = tuple(sorted(use.items(), reverse=True))
            yield after, (made, (filled, times)), bins + times, waste + times * (capacity - size - sum(f))

    def batches_of(left: Counter) -> Iterator[list[tuple[int, ...]]]:
        size = max(left)
        own = left.copy()
        own[size] -= 1
        return filling_batches(own, capacity - size)

    def listed(made: tuple) -> Bins:
        out: Bins = []
        while made:
            made, last = made
            out.append(last)
        return out[::-1]

    def hopeless(left: Counter, bins: int, waste: int) -> bool:
        return waste > (most - 1) * capacity - total or bins + lower_bound(left, capacity) >= most

    stack: list[tuple[Counter, tuple, int, int]] = [(counts, (), 0, 0)]
    later: deque[tuple[tuple, int, int]] = deque()  # nodes whose fillings have not all come
    again: tuple | None = None  # the one of them that is being continued
    while (stack or again or later) and most > bound and nodes < (most_nodes or MOST_NODES):
        nodes += 1
        if stack:
            left, made, bins, waste = stack.pop()
            if hopeless(left, bins, waste):
                continue
            if nodes % EACH == 1 or len(left) <= EACH:
                rest = best_fit(left, capacity)
                if (n := bins + sum(x for _, x in rest)) < most:
                    best, most = listed(made) + rest, n
            if not left:
                continue
            stack += reversed(list(children(left, made, bins, waste, next(batches_of(left)))))
            later.append((made, bins, waste))
            continue
        if not again:
            made, bins, waste = later.popleft()
            left = counts.copy()
            for filled, times in listed(made):
                left.subtract({s: times * n for s, n in filled})
            left = +left
            again = left, made, bins, waste, islice(batches_of(left), 1, None)
        left, made, bins, waste, batches = again
        batch = None if hopeless(left, bins, waste) else next(batches, None)
        if batch is None:
            again = None
        else:
            stack += reversed(list(children(left, made, bins, waste, batch)))
    return best


def pack_pieces(pieces: DataFrame, capacity: int = 2048, most_nodes: int | None = None) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset.

    Only the histogram of lengths (at most `capacity` entries) goes to the driver, and only the fillings, whose
    number follows the different lengths, come back. A piece's rank among those of its length decides which bin
    it takes. Sequences are filled without gaps; numbers are from 0 without gaps. Repeated rows are placed each, and
    null ids like others; empty in, empty out.
    """
    hist = Counter({r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()})
    starts: dict[int, list] = {}
    base, used = 0, Counter()
    for filling, bins in bin_completion(hist, capacity, most_nodes):
        offset = 0
        for size, times in filling:
            starts.setdefault(size, []).append((used[size], times, base, offset))
            used[size] += bins * times
            offset += size * times
        base += bins
    tables = {s: np.array(rows, np.int64).T for s, rows in starts.items()}
    ranked = salted_rank(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], salts_for(max(hist.values(), default=0)), "_rank")
    keep = pieces.columns

    def place(batches):
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                rows = np.flatnonzero(size == s)
                first, times, at, offset = tables[int(s)]
                k = np.searchsorted(first, rank[rows], "right") - 1
                nth = rank[rows] - first[k]
                seq[rows], off[rows] = at[k] + nth // times[k], offset[k] + nth % times[k] * s
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return ranked.select(*keep, "_rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


#: Pieces of a document that its place leaves room for.
PLACE_PIECES = 1 << 18


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, place_col: str | None = None) -> DataFrame:
    """Documents tokenized, cut where longer than a sequence, and packed: see `token_pieces` and `pack_pieces`.

    With `place_col`, a column of docs with different whole numbers, sequences are read in the documents' order: a
    sequence's number is the smallest place of a piece that it holds, a document's place times PLACE_PIECES plus the
    piece; else they are numbered from 0.

    Repeated rows are packed each; null ids stay null; empty and null texts take one token; texts are packed whole,
    however long; pieces that tie in length are exchangeable; an empty table gives an empty result. Only the id, the
    text and the place are read, so other columns' names don't matter."""
    packed = pack_pieces(stored(token_pieces(docs, tokenizer_path, capacity, end_id, place_col=place_col), "pieces"), capacity)
    if place_col is None:
        return packed
    first = F.min(F.col("place") * PLACE_PIECES + F.col("piece")).over(Window.partitionBy("sequence_id"))
    return packed.withColumn("sequence_id", first).drop("place")
