"""Exact deduplication: whole texts in radix tries, whose terminal nodes hold the owner of each text."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HOT_KEYS, HOT_ROWS, stored, text_bytes

#: Bytes of different texts, and rows, that a task's first trie holds before it passes on what it has and starts anew.
LOCAL_BYTES, LOCAL_ROWS = 32 << 20, 100_000
#: Bytes of different texts that a partition's trie holds before it spills its heaviest subtrees.
TRIE_BYTES = 96 << 20
#: Bytes of texts in a batch that a task puts out.
BATCH_BYTES = 4 << 20

CLASSES = "c long, length long, sha binary, text binary, owner long, owner_class long, owner_place long, n long, ids array<long>"
MET = "c long, up long, owner long, owner_class long, owner_place long, n long, length long, sha binary, text binary"

Node = list  # label, children by first byte, entry (-1: none)


class Tries:
    """Compressed radix tries over byte strings, one for each length and first byte: the subtrees that are spilled.

    Strings of a trie have the same length, so each ends in a leaf. An edge holds the run of bytes down to the next
    branch; a string is followed edge by edge, and whole bytes are compared."""

    def __init__(self):
        self.roots: dict[tuple[int, int], Node] = {}
        self.weights: dict[tuple[int, int], int] = {}
        self.entries, self.bytes = 0, 0

    def place(self, text: bytes) -> tuple[int, bool]:
        """The number of the text's entry, and whether it is new."""
        key = (len(text), text[0] if text else -1)
        node = self.roots.get(key)
        if node is None:
            return self._grown(key, len(text), self.roots, key, text), True
        into, slot, at = self.roots, key, 0
        while True:
            label = node[0]
            if text.startswith(label, at):
                at += len(label)
                if at == len(text):
                    return node[2], False
                into, slot = node[1], text[at]
                if slot not in into:
                    return self._grown(key, len(text) - at, into, slot, text[at:]), True
                node = into[slot]
                continue
            same = _common(label, text, at)
            node[0] = label[same:]
            fork: Node = [label[:same], {label[same]: node}, -1]
            into[slot] = fork
            at += same
            return self._grown(key, len(text) - at, fork[1], text[at], text[at:]), True

    def _grown(self, key: tuple[int, int], size: int, into: dict, slot, label: bytes) -> int:
        into[slot] = [label, {}, self.entries]
        self.weights[key] = self.weights.get(key, 0) + size
        self.bytes += size
        self.entries += 1
        return self.entries - 1

    def heaviest(self) -> tuple[int, int]:
        return max(self.weights, key=self.weights.__getitem__)

    def take(self, key: tuple[int, int]) -> Iterator[tuple[int, bytes]]:
        """Entries and texts of a subtree, which is removed."""
        self.bytes -= self.weights.pop(key)
        open_ = [(self.roots.pop(key), b"")]
        while open_:
            (label, below, entry), above = open_.pop()
            text = above + label
            if entry >= 0:
                yield entry, text
            open_ += [(n, text) for n in below.values()]


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the prefix that label shares with text from `at`; they are known to differ somewhere."""
    low, high = 0, len(label)
    while low < high:
        mid = (low + high + 1) // 2
        if text.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class Owners:
    """For each entry: the owner's id, class and place, and the rows so far."""

    def __init__(self, largest: bool):
        self.sign = -1 if largest else 1
        self.best: list[tuple] = []
        self.rows = array("q")

    def add(self, entry: int, new: bool, owner: int | None, c: int, place: int, n: int) -> None:
        mine = (owner is None, self.sign * owner if owner is not None else 0, c, place)
        if new:
            self.best.append(mine)
            self.rows.append(n)
        else:
            self.rows[entry] += n
            if mine < self.best[entry]:
                self.best[entry] = mine

    def of(self, entry: int) -> tuple[int | None, int, int, int]:
        none, owner, c, place = self.best[entry]
        return None if none else self.sign * owner, c, place, self.rows[entry]


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], text_at: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or b"") + 100
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), kinds)], names=names)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _gathered(largest: bool, local_bytes: int, local_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Equal texts of a task become one row, with all their ids, before anything is shuffled."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 33
        tries, owners, ids, seen = Tries(), Owners(largest), [], 0

        def out() -> Iterator[tuple]:
            for key in list(tries.roots):
                for entry, text in tries.take(key):
                    owner, c, place, n = owners.of(entry)
                    yield first + entry, len(text), hashlib.sha256(text).digest(), text, owner, c, place, n, ids[entry]

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                entry, new = tries.place(text or b"")
                if new:
                    ids.append([])
                owners.add(entry, new, i, first + entry, len(ids[entry]), 1)
                ids[entry].append(i)
                seen += 1
                if tries.bytes > local_bytes or seen >= local_rows:
                    yield from out()
                    first += len(ids)
                    tries, owners, ids, seen = Tries(), Owners(largest), [], 0
        yield from out()

    return lambda batches: _batches(rows(batches), _names(CLASSES), kinds, 3)


def _met(largest: bool, trie_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The classes of a partition in one trie: a row for each class (c) with its text's owner, or, where the text may
    be in other partitions too (its key is salted) or its subtree was spilled, with the number (up) of a row that
    holds the text and goes on to the next round."""
    kinds = [pa.int64()] * 7 + [pa.binary()] * 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        nodes = TaskContext.get().partitionId() << 33
        tries, owners, salted, spilled = Tries(), Owners(largest), set(), set()
        classes, entry_of, up = array("q"), array("q"), {}

        def passed_on(key: tuple[int, int], texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple]:
            nonlocal nodes
            for entry, text in texts:
                if key in spilled or entry in salted:
                    up[entry] = nodes
                    yield nodes, None, *owners.of(entry), len(text), hashlib.sha256(text).digest(), text
                    nodes += 1

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for c, text, owner, owner_class, place, n, salt in zip(*columns, strict=True):
                entry, new = tries.place(text)
                owners.add(entry, new, owner, owner_class, place, n)
                classes.append(c)
                entry_of.append(entry)
                if salt:
                    salted.add(entry)
                while tries.bytes > trie_bytes and len(tries.roots) > 1:
                    key = tries.heaviest()
                    spilled.add(key)
                    yield from passed_on(key, tries.take(key))
        for key in list(tries.roots):
            yield from passed_on(key, tries.take(key))
        for c, entry in zip(classes, entry_of, strict=True):
            yield c, up.get(entry), *owners.of(entry), None, None, None

    return lambda batches: _batches(rows(batches), _names(MET), kinds, 8)


def _resolved(classes: DataFrame, largest: bool, trie_bytes: int, depth: int = 0) -> DataFrame:
    """c, owner, owner_class, owner_place and n (of the whole text) for each class."""
    spark = classes.sparkSession
    hot = max(HOT_ROWS, classes.count() // HOT_KEYS)
    heavy = classes.groupBy("length", "sha").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > hot)
    salts = heavy.select("length", "sha", F.ceil(F.col("times") / hot).cast("long").alias("salts"))
    salted = classes.join(F.broadcast(salts), ["length", "sha"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("c"), "salts") + 1, F.lit(0)))
    keys = [F.col("length"), F.col("sha"), F.col("salt"), F.lit(depth)]
    dealt = salted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")) << depth, *keys) if depth else salted.repartition(*keys[:3])
    met = stored(dealt.select("c", "text", "owner", "owner_class", "owner_place", "n", "salt").mapInArrow(_met(largest, trie_bytes), MET), "met")
    nodes = met.filter("text is not null")
    found = ["c", "owner", "owner_class", "owner_place", "n"]
    ended = met.filter("text is null and up is null").select(*found)
    if not nodes.limit(1).count():
        return ended
    above = _resolved(nodes, largest, trie_bytes, depth + 1).withColumnRenamed("c", "up")
    return ended.unionByName(met.filter("text is null and up is not null").select("c", "up").join(above, "up").select(*found))


def exact_owners(
    docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text", normal: Callable[[Column], Column] | None = None, local_bytes: int = LOCAL_BYTES, local_rows: int = LOCAL_ROWS, trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """doc_id, keep_id (the id of the row that stays of the equal texts), group_size, kept, text_sha256: one row a document.

    Texts are equal if all their bytes are, after `normal` (a function of the text column) where it is given. Of equal
    texts the row with the smallest id stays, or with keep="largest" that with the largest.

    A task first puts its texts into tries of its own and passes on one row a text, with all the ids. These rows are
    partitioned by length and content hash (SHA-256), and each partition inserts the full byte strings into compressed
    radix tries, whose terminal nodes keep the owner and the number of rows. A text of very many tasks is dealt to
    several partitions by a salt, and a trie that outgrows `trie_bytes` spills its heaviest subtrees; both go on to
    another round, as narrow as what is left. Tables between the rounds lie in the shared folder.

    Null texts count as empty; a null id stays only where no other row of the text has an id; of repeated rows and of
    rows that tie in the id exactly one has `kept`; very long texts are compared whole. An empty table gives an empty
    result. Only the id and the text are read, so other columns' names don't matter.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    largest, text = keep == "largest", F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (normal(text) if normal else text).alias("text"))
    classes = stored(rows.mapInArrow(_gathered(largest, local_bytes, local_rows), CLASSES), "classes")
    owners = _resolved(classes.drop("ids"), largest, trie_bytes)
    members = classes.select("c", "sha", "ids").join(owners, "c").select("c", "sha", "owner", "owner_class", "owner_place", "n", F.posexplode("ids").alias("place", "doc_id"))
    kept = (F.col("c") == F.col("owner_class")) & (F.col("place") == F.col("owner_place"))
    return members.select("doc_id", F.col("owner").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the copies that `exact_owners` finds; columns of any names come along.

    Of repeated rows with the same id and text one stays. For odd input see `exact_owners`."""
    stays = exact_owners(docs, keep, id_col, text_col).filter("kept").select(F.struct("doc_id", "text_sha256").alias("_at"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    at = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256).alias("text_sha256")).alias("_at")
    held = docs.select(row, at).join(stays, "_at", "left_semi")
    return held.groupBy("_at").agg(F.first("_row").alias("_row")).select("_row.*")
