"""Repair of conversations' turns at least cost: a dynamic program over time-major arrays of many conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import stored

#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a; where the one role that may be put in leads.
STATES = 4
ON = np.array([2, 2, 3, 2])
ASKED = ["user", "user", "assistant", "user"]
FINAL = (0, 3)
#: Where keeping a row leads from each state, by its role's initial: s, u, a, any other; -1 where the grammar forbids it.
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
FAULTS = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
FAR = np.int64(1) << 40
#: Rows of a piece of a conversation; rows that a task repairs at once, and bytes of a batch that it puts out.
PIECE_ROWS, BATCH_ROWS, BATCH_BYTES = 4_096, 16_384, 8 << 20
#: Characters of a text that decide its range of rows; those that agree in conversation, turn, role and these go together.
RANGE_CHARS = 64
WHITE = " \t\n\x0b\x0c\r"

ROWS = "array<struct<turn:bigint,role:string,text:string,fault:string>>"
FIGURES = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, repaired array<struct<role:string,text:string>>"
PLACE = "conv_id long, part long, piece long"


# --- the dynamic program ---


def kind_of(role: str) -> int:
    """The row of KEPT for a role; an empty role is none that the grammar knows."""
    return "sua".find(role[0]) % 4 if role else 3


def _settled(cost: np.ndarray) -> np.ndarray:
    """Costs to go where rows may be inserted first; more than two in one place never pay."""
    for _ in range(2):
        cost = np.minimum(cost, INSERT + cost[:, ON])
    return cost


def _moves(kind: np.ndarray, must: np.ndarray, cut: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs to go from each state by deleting, keeping and re-roling a row, `after` being those behind it."""
    extra = np.where(cut, CUT, 0)[:, None]
    to = KEPT[kind]
    keep = np.where((to >= 0) & ~must[:, None], extra + np.take_along_axis(after, np.maximum(to, 0), 1), FAR)
    role = np.where(must[:, None], FAR, REROLE + extra + after[:, ON])
    return DELETE + after, keep, role


def backward(kind: np.ndarray, must: np.ndarray, cut: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Costs to go of many conversations of one length: [turns + 1, conversations, states].

    kind, must, cut: [turns, conversations], the rows' kinds, whether they have to go, whether they are truncated.
    end: the costs behind the last row, insertions there included. All conversations take a step at a time."""
    cost = np.empty((len(kind) + 1, *end.shape), np.int64)
    cost[-1] = end
    for t in range(len(kind) - 1, -1, -1):
        cost[t] = np.minimum(FAR, _settled(np.minimum.reduce(_moves(kind[t], must[t], cut[t], cost[t + 1]))))
    return cost


def trace(kind: np.ndarray, must: np.ndarray, cut: np.ndarray, cost: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest edits from `state` on, of equals those with the least initials: letters and the states at the end.

    Letters: [3 * turns + 2, conversations] of bytes, 0 where nothing is done; a row has two places for insertions
    before it and one for its own edit. From a state a letter leads to one state, so one is followed for each
    conversation. last: whether it ends behind its last row, so that insertions there are taken too."""
    n, many = kind.shape
    letters = np.zeros((3 * n + 2, many), np.uint8)
    state, rows = state.copy(), np.arange(many)
    for t in range(n + 1):
        if t < n:
            gone, keep, _ = _moves(kind[t], must[t], cut[t], cost[t + 1])
        for k in range(2):
            left = cost[t, rows, state]
            more = gone[rows, state] != left if t < n else last & ~np.isin(state, FINAL)
            more &= left == INSERT + cost[t, rows, ON[state]]
            letters[3 * t + k, more] = ord("I")
            state = np.where(more, ON[state], state)
        if t < n:
            left = cost[t, rows, state]
            drop = gone[rows, state] == left
            hold = ~drop & (keep[rows, state] == left)
            letters[3 * t + 2] = np.where(drop, ord("D"), np.where(hold, ord("K"), ord("R")))
            state = np.where(drop, state, np.where(hold, KEPT[kind[t], state], ON[state]))
    return letters, state


def end_costs(many: int) -> np.ndarray:
    """Costs behind the last row of conversations."""
    cost = np.full((many, STATES), FAR)
    cost[:, FINAL] = 0
    return np.minimum(FAR, _settled(cost))


def crossing(kind: np.ndarray, must: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The cheapest cost of pieces of conversations from each state to each: [pieces, from, to]."""
    many = kind.shape[1]
    end = np.full((STATES, many, STATES), FAR)
    for s in range(STATES):
        end[s, :, s] = 0
    wide = [np.tile(x, (1, STATES)) for x in (kind, must, cut)]
    return backward(*wide, end.reshape(-1, STATES))[0].reshape(STATES, many, STATES).transpose(1, 2, 0)


# --- pieces of conversations ---


class Piece:
    """Rows of a conversation in order (turn, role, text, first fault), and where they lie."""

    def __init__(self, conv: int | None, part: int, piece: int, rows: list[tuple]):
        self.conv, self.part, self.piece, self.rows = conv, part, piece, rows

    def figures(self, cost: int, audit: str, repaired: list[dict]) -> tuple:
        """What FIGURES names: the turns' ends and number, faults, illegal neighbours, initials at the ends, the edits."""
        turns, roles, faults = [r[0] for r in self.rows if r[0] is not None], [r[1][:1] for r in self.rows], [r[3] for r in self.rows]
        ends = (min(turns), max(turns)) if turns else (None, None)
        return *ends, len(set(turns)), *map(faults.count, ("blank", "duplicate", "truncated")), illegal(roles), roles[0] if roles else None, roles[-1] if roles else None, cost, audit, repaired


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def first_fault(text: str, known: bool) -> str:
    """blank, duplicate, truncated or nothing."""
    if not (said := text.strip(WHITE)):
        return "blank"
    return "duplicate" if known else "" if said[-1] in ".!?" else "truncated"


def _by_length(pieces: list[Piece]) -> Iterator[tuple[list[int], list[Piece], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Pieces of one length together: their places in the list, and their time-major arrays."""
    by: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        by.setdefault(len(p.rows), []).append(k)
    for n, ks in by.items():
        same = [pieces[k] for k in ks]
        kind = np.array([kind_of(r[1]) for p in same for r in p.rows], np.int64).reshape(len(same), n).T
        fault = np.array([FAULTS[r[3]] for p in same for r in p.rows], np.int64).reshape(len(same), n).T
        yield ks, same, (kind, fault > 1, fault == 1)


def _edited(letters: np.ndarray, state: int, rows: list[tuple]) -> tuple[str, list[dict]]:
    """The edits' initials and the rows that they leave."""
    audit, left = [], []
    for at in np.flatnonzero(letters).tolist():
        letter, t = chr(letters[at]), at // 3
        audit.append(letter)
        if letter == "K":
            left.append({"role": rows[t][1], "text": rows[t][2]})
            state = int(KEPT[kind_of(rows[t][1]), state])
        elif letter != "D":
            left.append({"role": ASKED[state], "text": rows[t][2] if letter == "R" else ""})
            state = int(ON[state])
    return "".join(audit), left


def solved(pieces: list[Piece], ends: np.ndarray, states: np.ndarray, last: np.ndarray) -> Iterator[tuple[Piece, tuple]]:
    """Figures of pieces with the costs behind them, their first states and whether they end a conversation."""
    for ks, same, arrays in _by_length(pieces):
        cost = backward(*arrays, ends[ks])
        letters, out = trace(*arrays, cost, states[ks], last[ks])
        for j, (k, p) in enumerate(zip(ks, same, strict=True)):
            spent = cost[0, j, states[k]] - (0 if last[k] else cost[-1, j, out[j]])
            yield p, p.figures(int(spent), *_edited(letters[:, j], int(states[k]), p.rows))


def _put_out(rows: Iterator[tuple], schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches; text_at: the column that decides a row's size, a list of dicts."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += 200 + sum(40 + len(x["text"]) for x in row[text_at] or ())
        if size > BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


HELD = f"{PLACE}, whole boolean, {FIGURES}, held {ROWS}"
NOTHING = (None,) * 12


def _first_pass(piece_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a range of rows in order: conversations that lie in it whole, repaired; pieces of the first, the last and of long ones."""
    schema = _arrow(HELD)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        waiting: list[Piece] = []
        many = 0

        def repaired() -> Iterator[tuple]:
            n = len(waiting)
            for p, figures in solved(waiting, end_costs(n), np.zeros(n, np.int64), np.ones(n, bool)):
                yield p.conv, p.part, 0, True, *figures, None

        def as_piece(p: Piece) -> tuple:
            held = [{"turn": r[0], "role": r[1], "text": r[2], "fault": r[3]} for r in p.rows]
            return p.conv, p.part, p.piece, False, *NOTHING, held

        one, seen, inner = None, set(), False
        for batch in batches:
            for conv, turn, role, text, live in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if one is None or conv != one.conv:
                    if one is not None and inner and one.piece == 0:
                        waiting.append(one)
                        many += len(one.rows)
                        if many > BATCH_ROWS:
                            yield from repaired()
                            waiting, many = [], 0
                    elif one is not None:
                        yield as_piece(one)
                    inner = one is not None
                    one, seen = Piece(conv, part, 0, []), set()
                elif len(one.rows) >= piece_rows:
                    yield as_piece(one)
                    one = Piece(conv, part, one.piece + 1, [])
                if live:
                    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                    one.rows.append((turn, role, text, first_fault(text, key in seen)))
                    seen.add(key)
        if one is not None:
            yield as_piece(one)
        yield from repaired()

    return lambda batches: _put_out(rows(batches), schema, 16)


def _read(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[Piece, list]]:
    """Pieces of a batch (conv_id, part, piece, held, others) and their other columns."""
    for conv, part, piece, held, *rest in zip(*[batch.column(i).to_pylist() for i in range(4 + columns)], strict=True):
        yield Piece(conv, part, piece, [(r["turn"], r["role"], r["text"], r["fault"]) for r in held]), rest


# --- conversations that lie in several ranges, or are long ---


def _across(pieces: DataFrame) -> DataFrame:
    """Repaired pieces of conversations, each from the costs behind it and the state before it.

    A row is a duplicate too if an earlier piece has seen it. The costs of crossing a piece from state to state, 16
    numbers, are put together along a conversation from its end; with the costs behind it each piece is traced from
    all four states, and where these lead is put together from the start."""
    at = ["at", "part", "piece"]
    pieces = pieces.select(F.struct("conv_id").alias("at"), "part", "piece", "held")
    each = pieces.select(*at, F.posexplode("held").alias("nth", "r")).filter("r.fault in ('', 'truncated')")
    keyed = each.select(*at, "nth", F.sha2(F.concat_ws(":", F.length("r.role"), "r.role", "r.text"), 256).alias("key"))
    first = keyed.groupBy("at", "key").agg(F.min(F.struct("part", "piece")).alias("first"))
    again = keyed.join(first, ["at", "key"]).filter(F.struct("part", "piece") != F.col("first")).groupBy(*at).agg(F.collect_list("nth").alias("again"))
    marked = F.transform("held", lambda r, i: F.when(F.array_contains("again", i), r.withField("fault", F.lit("duplicate"))).otherwise(r))
    pieces = pieces.join(again, at, "left").select(*at, F.when(F.col("again").isNull(), F.col("held")).otherwise(marked).alias("held"))
    pieces = stored(pieces, "pieces")
    flat = [F.col("at.conv_id").alias("conv_id"), "part", "piece", "held"]

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p for p, _ in _read(batch, 0)]
            out = [(p.conv, p.part, p.piece, m.ravel().tolist()) for ks, same, arrays in _by_length(found) for p, m in zip(same, crossing(*arrays), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*out, strict=True), costs, strict=True)], schema=costs) if out else pa.RecordBatch.from_pylist([], costs)

    costs = _arrow(f"{PLACE}, costs array<long>")
    ends = _arrow(f"{PLACE}, behind array<long>, ends boolean")
    exits = _arrow(f"{PLACE}, exits array<long>")
    states = _arrow(f"{PLACE}, state long")
    along = lambda df, value: df.groupBy(F.struct("conv_id").alias("at")).agg(F.array_sort(F.collect_list(F.struct("part", "piece", value))).alias("all")).select(F.col("at.conv_id").alias("conv_id"), "all")

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, all_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                behind, out = end_costs(1)[0], []
                for k, x in enumerate(reversed(all_)):
                    out.append((conv, x["part"], x["piece"], behind.tolist(), k == 0))
                    behind = np.minimum(FAR, (np.array(x["costs"]).reshape(STATES, STATES) + behind).min(1))
                yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*out, strict=True), ends, strict=True)], schema=ends)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = list(_read(batch, 2))
            found, out = [p for p, _ in read], []
            for ks, same, arrays in _by_length(found):
                behind, last = np.array([read[k][1][0] for k in ks], np.int64).reshape(-1, STATES), np.array([read[k][1][1] for k in ks], bool)
                cost = backward(*arrays, behind)
                to = [trace(*arrays, cost, np.full(len(same), s), last)[1] for s in range(STATES)]
                out += [(p.conv, p.part, p.piece, [int(t[j]) for t in to]) for j, p in enumerate(same)]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*out, strict=True), exits, strict=True)], schema=exits) if out else pa.RecordBatch.from_pylist([], exits)

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, all_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                state, out = 0, []
                for x in all_:
                    out.append((conv, x["part"], x["piece"], state))
                    state = x["exits"][state]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*out, strict=True), states, strict=True)], schema=states)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                read = list(_read(batch, 3))
                ends_ = np.array([r[0] for _, r in read], np.int64).reshape(-1, STATES)
                for p, figures in solved([p for p, _ in read], ends_, np.array([r[2] for _, r in read], np.int64), np.array([r[1] for _, r in read], bool)):
                    yield p.conv, p.part, p.piece, False, *figures

        yield from _put_out(rows(), schema, 15)

    schema = _arrow(f"{PLACE}, whole boolean, {FIGURES}")
    keyed_by = lambda df: df.withColumn("at", F.struct("conv_id")).drop("conv_id")
    crossings = pieces.select(*flat).mapInArrow(crossed, f"{PLACE}, costs array<long>")
    behind = along(crossings, "costs").mapInArrow(composed, f"{PLACE}, behind array<long>, ends boolean")
    pieces = stored(pieces.join(keyed_by(behind), at).select(*at, "held", "behind", "ends"), "behind")
    leaving = pieces.select(*flat, "behind", "ends").mapInArrow(left, f"{PLACE}, exits array<long>")
    before = along(leaving, "exits").mapInArrow(followed, f"{PLACE}, state long")
    return pieces.join(keyed_by(before), at).select(*flat, "behind", "ends", "state").mapInArrow(finished, f"{PLACE}, whole boolean, {FIGURES}")


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Conversations repaired at least cost: one row a conversation, or a piece of one, with what was wrong and the edits.

    rows: conv_id, turn, role, text, and `live`, false for a row that only says that a conversation exists. A row's
    first fault is blank (no text but white space), duplicate (role and text seen earlier in the conversation) or
    truncated (its last character that isn't white space is none of `.!?`). Edits lead to roles whose initials read
    (s?(ua)+)?: keep (0), re-role to user or assistant (3), delete (4, a must for blank and duplicate rows), insert an
    empty user or assistant row (3); a truncated row left in costs 3 more. Of equal costs the edits whose initials are
    least in ASCII.

    Rows are sorted by ranges of conversation, turn (nulls first), role and text, and a task repairs the conversations
    of its range that lie in it whole, in buckets by length: costs of all conversations of a bucket are updated for
    each turn at once, stored, and traced at once. Of the first and last conversation of a range, and of those of more
    than `piece_rows` rows, pieces go on to `_across`, so no task holds a long conversation.

    Returns conv_id, part, piece (a conversation's pieces in order), whole, low and high (the least and greatest turn),
    turns (different ones), blank, duplicate, truncated, illegal (neighbours in the piece whose initials aren't su, ua
    or au), first and last (initials), cost, audit (the edits' initials), repaired (rows of role and text).

    Null roles and texts count as one space; a null conv_id is a conversation; null turns come first and count for no
    gap; rows of one turn go by role, then text; repeated rows are duplicates; an empty role is none of the three. Very
    long texts are read whole. An empty table gives an empty result. Other columns don't matter.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    one = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.coalesce(F.col("live"), F.lit(True)).alias("live"))
    ranged = one.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("conv_id", "turn", "role", "text")
    found = stored(ranged.mapInArrow(_first_pass(piece_rows), HELD), "repaired")
    return found.filter("whole").drop("held").unionByName(_across(found.filter("not whole").select("conv_id", "part", "piece", "held")))


# --- what a repair comes to ---


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, put together conversation by conversation; the digest is fed piece by piece."""
    schema = _arrow_answer
    one: dict = {}

    def answer() -> pa.RecordBatch:
        gaps = one["high"] - one["low"] + 1 - one["turns"] if one["turns"] else 0
        row = one["conv_id"], gaps, one["blank"], one["duplicate"], one["truncated"], one["illegal"], one["cost"], "".join(one["audit"]), one["digest"].hexdigest()
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    for batch in batches:
        for x in batch.to_pylist():
            if not one or one["conv_id"] != x["conv_id"]:
                if one:
                    yield answer()
                one = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"conv_id": x["conv_id"], "low": None, "high": None, "end": None, "audit": [], "digest": hashlib.sha256(), "fed": False}
            for k in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                one[k] += x[k]
            if x["turns"]:
                one["turns"] -= one["high"] is not None and one["high"] == x["low"]
                one["low"] = x["low"] if one["low"] is None else one["low"]
                one["high"] = x["high"]
            if x["first"] is not None:
                one["illegal"] += one["end"] is not None and illegal([one["end"], x["first"]])
                one["end"] = x["last"]
            one["audit"].append(x["audit"])
            for row in x["repaired"]:
                one["digest"].update((("\n" if one["fed"] else "") + f"{row['role']}:{row['text']}").encode())
                one["fed"] = True
    if one:
        yield answer()


_arrow_answer = pa.schema([("conv_id", pa.int64()), *[(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repair_report(repaired: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row a conversation.

    gaps: turns missing between the least and the greatest; repaired_sha256: of the repaired `role:text` rows joined
    by newlines. Conversations in pieces stream through one task each, in order, as the digest asks for; only its
    state and the audit are held. For odd input see `repair_conversations`."""
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0).cast("long")
    alone = repaired.filter("whole").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parts = repaired.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    ddl = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return alone.unionByName(parts.mapInArrow(_summed_up, ddl))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32 of `conv_id:turn` modulo 20, nulls being one space: 0 drops the row, 1
    empties its text, 2 takes `.!?` out of it, 3 repeats it, 4 makes its role user. A dropped row stays as one that
    isn't `live`. Rows with the same id and turn fare alike; an empty table stays empty."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20))
    live: Column = fate != 0
    role = F.when(live, F.when(fate == 4, "user").otherwise(space("role")))
    text = F.when(live, F.when(fate == 1, "").when(fate == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text")))
    times = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    turn = F.when(live, F.col("turn"))
    return rows.select("conv_id", turn.alias("turn"), role.alias("role"), text.alias("text"), live.alias("live"), times.alias("_nth")).drop("_nth")
