import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import repair

TURN = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Cheapest cost, least audit and repaired rows of small conversations, by trying all edits."""
    n, best = len(rows), None
    choices = []
    for k, (role, _, fault) in enumerate(rows):
        mine = ["D"]
        if fault not in ("blank", "duplicate"):
            mine += ["K", "Ru", "Ra"]
        choices.append(mine)
    inserts = ["", "u", "a", "ua", "au"]
    for edits in product(*choices):
        for ins in product(inserts, repeat=n + 1):
            cost, audit, out = 0, "", []
            for k in range(n + 1):
                for c in ins[k]:
                    cost, audit = cost + 3, audit + "I"
                    out.append(("user" if c == "u" else "assistant", ""))
                if k == n:
                    break
                role, text, fault = rows[k]
                e = edits[k]
                audit += e[0]
                if e == "D":
                    cost += 4
                    continue
                cost += 3 * (fault == "truncated") + 3 * (e[0] == "R")
                out.append((role if e == "K" else {"u": "user", "a": "assistant"}[e[1]], text))
            if all(r for r, _ in out) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out)):
                if best is None or (cost, audit) < best[:2]:
                    best = (cost, audit, out)
    return best


def slow(rows):
    """What repair_report returns, conversation by conversation, with a forward program over (cost, audit, rows)."""
    by = defaultdict(list)
    for c, t, r, x, live in rows:
        by[c] += [(t is not None, t or 0, t, r, x)] if live else []
    out = []
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[0], r[1], (r[3] if r[3] is not None else " ").encode(), (r[4] if r[4] is not None else " ").encode()))
        seen, marked, numbers = set(), [], []
        for _, _, t, r, x in turns:
            r, x = " " if r is None else r, " " if x is None else x
            word = re.findall(r"[^\x20\x09-\x0D]", x)
            fault = "blank" if not word else "duplicate" if (r, x) in seen else "truncated" if word[-1] not in ".!?" else ""
            seen.add((r, x))
            marked.append((r, x, fault))
            numbers += [t] if t is not None else []
        ways = {0: (0, "", ())}

        def put(new, s, way):
            if s not in new or way[:2] < new[s][:2]:
                new[s] = way

        def grown(ways):
            for _ in range(3):
                for s, (cost, audit, left) in list(ways.items()):
                    role = "assistant" if s == 2 else "user"
                    put(ways, 3 if s == 2 else 2, (cost + 3, audit + "I", (*left, f"{role}:")))
            return ways

        for r, x, fault in marked:
            new = {}
            for s, (cost, audit, left) in grown(ways).items():
                put(new, s, (cost + 4, audit + "D", left))
                if fault in ("blank", "duplicate"):
                    continue
                cost += 3 * (fault == "truncated")
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(r[:1], {}).get(s)
                if to is not None:
                    put(new, to, (cost, audit + "K", (*left, f"{r}:{x}")))
                put(new, 3 if s == 2 else 2, (cost + 3, audit + "R", (*left, f"{'assistant' if s == 2 else 'user'}:{x}")))
            ways = new
        ways = grown(ways)
        cost, audit, left = min(ways[s] for s in (0, 3) if s in ways)
        faults = [f for _, _, f in marked]
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out.append((c, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), bad, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


ROLES = ["user", "assistant", "system", "tool", "", None, "under"]
TEXTS = ["A b.", "Yes!", "what?", "cut off", "", "\t \n", None, "ends in space. \n", "é", "x" * 5000 + "."]


def made(rng, convs, longest):
    rows = []
    for c in [*range(convs), None]:
        turns = [None if rng.random() < 0.1 else rng.randrange(longest) for _ in range(rng.randrange(1, longest + 1))]
        rows += [(c, t, rng.choice(ROLES), rng.choice(TEXTS), rng.random() > 0.05) for t in turns]
    rows += [(1000, 1, "user", "x", False)]
    return rows


def test_slow_is_least():
    rng = random.Random(3)
    for _ in range(12):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"{k} {rng.choice(['a.', 'b'])}", "") for k in range(rng.randrange(0, 3))]
        rows = [(r, t, rng.choice(["blank", "duplicate"]) if rng.random() < 0.2 else "" if t[-1] == "." else "truncated") for r, t, _ in rows]
        cost, audit, left = brute(rows)
        kind, fault = np.array([[repair.kind_of(r)] for r, _, _ in rows], np.int64).reshape(-1, 1), np.array([[repair.FAULTS[f]] for _, _, f in rows], np.int64).reshape(-1, 1)
        arrays = kind, fault > 1, fault == 1
        costs = repair.backward(*arrays, repair.end_costs(1))
        letters, _ = repair.trace(*arrays, costs, np.zeros(1, np.int64), np.ones(1, bool))
        mine, rest = repair._edited(letters[:, 0], 0, [(None, r, t, f) for r, t, f in rows])
        assert (costs[0, 0, 0], mine, [(x["role"], x["text"]) for x in rest]) == (cost, audit, left)


@pytest.mark.parametrize("piece_rows", [1, 3, 4096])
def test_against_slow(spark, piece_rows):
    """Conversations in pieces of any size, over several ranges, come to the same as one at a time."""
    rows = made(random.Random(piece_rows), 60, 7) + [(77, t, ["user", "assistant"][t % 2], f"turn {t % 50}{'.' * (t % 3)}", True) for t in range(300)]
    df = spark.createDataFrame(rows, TURN + ", live boolean").select("*", *[F.lit("x").alias(c) for c in ("at", "part", "piece", "held", "r", "key", "whole", "cost")])
    assert got(repair.repair_report(repair.repair_conversations(df, piece_rows))) == slow(rows)


def test_pieces_are_bounded(spark):
    rows = [(5, t, "user", f"t {t}.", True) for t in range(500)]
    df = spark.createDataFrame(rows, TURN + ", live boolean")
    pieces = repair.repair_conversations(df, 40).select("part", F.size("repaired").alias("n"), F.length("audit").alias("m")).collect()
    assert len(pieces) > 500 / 41 and max(r.m for r in pieces) <= 3 * 40 + 2
    assert got(repair.repair_report(repair.repair_conversations(df, 40))) == slow(rows)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in [*range(30), None] for t in [*range(4), None]]
    want = []
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fate == 4 else r, "" if fate == 1 else "One Two" if fate == 2 else x, True)
        want += [(c, None, None, None, False)] if fate == 0 else [row] * (2 if fate == 3 else 1)
    df = repair.damaged(spark.createDataFrame(rows, TURN))
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))
    assert got(repair.repair_report(repair.repair_conversations(df))) == slow(want)


def test_empty_table(spark):
    df = spark.createDataFrame([(1, 1, "user", "x")], TURN).limit(0)
    assert repair.repair_report(repair.repair_conversations(repair.damaged(df))).count() == 0
