"""Keep-first, and keep-last, over records that arrive bit by bit: keyed state that takes back what a late row replaces."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGES = "key string, place string, row string, change int"


def _place(rows: DataFrame, order: list[str]) -> Column:
    """A text that sorts as numbers or times do, nulls first."""
    kinds = dict(rows.dtypes)
    number = lambda c: (F.col(c).cast("timestamp") if kinds[c].startswith(("timestamp", "date")) else F.col(c)).cast("decimal(30,6)")
    digits = lambda c: F.lpad((number(c) + F.expr("cast('1e23' as decimal(30,6))")).cast("string"), 40, "0")
    return F.concat_ws("|", *[F.coalesce(digits(c), F.lit("")) for c in order])


def kept_changes(rows: DataFrame, key: Column, order: list[str], last: bool = False, event: str | None = None, late_ms: int = 0) -> DataFrame:
    """A stream's keep-first as a stream of changes: key, place, row (as JSON), change (1 taken, -1 taken back).

    State holds one row a key: of all that have arrived the first by `order` (numbers or times; nulls come first), or with
    `last` the last. A row that arrives late but comes before the one that was kept takes its place, and that one is taken
    back. So what `current_rows` makes of the changes doesn't depend on the order in which rows or files arrive. Of rows
    that tie in the order the one with the least JSON stays; null keys are a key.

    event: a time column with a watermark. Then rows behind the watermark are left out, and a key is forgotten when the
    watermark is `late_ms` past the one of its last row, which bounds the state; without it there is an entry a key."""
    named = F.to_json(F.struct(key.cast("string").alias("k")), {"ignoreNullFields": "false"}).alias("key")
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")
    one = rows.select(named, _place(rows, order).alias("place"), row, *([F.col(event).alias("event")] if event else []))

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = tuple(state.get) if state.exists else None
        best = held
        for pdf in frames:
            if event:
                pdf = pdf[pdf["event"] >= pd.Timestamp(max(0, state.getCurrentWatermarkMs()), unit="ms")]
            for found in zip(pdf["place"], pdf["row"], strict=True):
                if best is None or ((found[0] > best[0]) if last else (found[0] < best[0])) or (found[0] == best[0] and found[1] < best[1]):
                    best = found
        if event:
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + late_ms + 1)
        if best == held:
            return
        state.update(best)
        yield pd.DataFrame([(key[0], *best, 1)] + ([(key[0], *held, -1)] if held else []), columns=["key", "place", "row", "change"])

    timeout = GroupStateTimeout.EventTimeTimeout if event else GroupStateTimeout.NoTimeout
    return one.groupBy("key").applyInPandasWithState(update, CHANGES, "place string, row string", "append", timeout)


def current_rows(changes: DataFrame, schema: str) -> DataFrame:
    """The rows that stand after all changes, with the columns of `schema`; the order of the changes doesn't matter."""
    standing = changes.groupBy("key", "place", "row").agg(F.sum("change").alias("n")).filter("n > 0")
    return standing.select(F.from_json("row", schema).alias("r")).select("r.*")
