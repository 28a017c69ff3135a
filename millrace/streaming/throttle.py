"""A counter per key that advances at most once a minute.

An event advances its key's count only when more than `gap` seconds have passed since
the last advance; the first one sets it to 1. At `limit` no event has an effect. A
reset event clears the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.cleaning import q

GAP_SECONDS = 60
LIMIT = 10
START = (0, -1)  # last advance, count
OUTPUT = "key string, at_second bigint, is_reset boolean, batch_number int, advanced boolean"
STATE = "last_at bigint, count int"


def step(state: tuple[int, int], at: int, is_reset: bool, gap: int = GAP_SECONDS, limit: int = LIMIT) -> tuple[int, int]:
    """The state after one event."""
    last, count = state
    if is_reset:
        return START
    if count >= limit or at - last <= gap:
        return state
    return at, 1 if count == -1 else count + 1


def _advance(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    current = state.get if state.exists else START
    rows = pd.concat(list(frames)).sort_values(["at_second", "is_reset"], kind="stable")
    counts, advanced = [], []
    for at, is_reset in zip(rows["at_second"], rows["is_reset"]):
        after = step(current, int(at), bool(is_reset))
        advanced.append(not is_reset and after != current)
        counts.append(after[1])
        current = after
    state.update(current)
    yield rows.assign(batch_number=pd.Series(counts, index=rows.index, dtype="int32"), advanced=advanced)[
        ["key", "at_second", "is_reset", "batch_number", "advanced"]
    ]


def throttle(events: DataFrame, key: str, ts: str, is_reset: Column, watermark: str = "1 hour") -> DataFrame:
    """The counter of each key over a stream: one row per key, second and kind of event.

    Only the second of an event matters to the counter. Repeats inside one second are
    removed first by (key, second, kind), which spreads a busy key over all tasks; the
    state function then sees at most two rows per key and second of the micro-batch, in
    event time order. The count after any single event is the row of its key and second.
    """
    timed = events.select(
        q(key).cast("string").alias("key"),
        q(ts).cast("timestamp").alias("event_time"),
        is_reset.alias("is_reset"),
    ).withColumn("at_second", F.unix_timestamp("event_time"))
    return (
        timed.withWatermark("event_time", watermark)
        .dropDuplicatesWithinWatermark(["key", "at_second", "is_reset"])
        .select("key", "at_second", "is_reset")
        .groupBy("key")
        .applyInPandasWithState(_advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
    )
