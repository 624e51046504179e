"""Structured Streaming front ends over the event stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, time: str = "ts", width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling counts by type with a watermark: an extension, the batch operators have no event time."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def session_windows(events: DataFrame, time: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), user).agg(F.count("*").alias("n"))


def carry_turns(events: DataFrame, key: str, opens: str, closes: str, time: str = "ts", ttl_ms: int = 3_600_000) -> DataFrame:
    """The open turn of each key carried over micro-batches; state is one counter and one id, dropped after ttl_ms idle.

    Within a batch rows are taken in order of time and event_id; a row of type `closes` is the last of its turn.
    """
    kind = events.schema[key].dataType.simpleString()

    def step(name: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        number, open_ = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values([time, "event_id"])
        turns = []
        for t in rows["event_type"]:
            if t == opens:
                number += 1
                open_ = number
            turns.append(open_ or None)
            if t == closes:
                open_ = 0
        state.update((number, open_))
        state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame({key: name[0], "event_id": rows["event_id"].to_numpy(), "turn_no": pd.array(turns, dtype="Int64")})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, event_id long, turn_no long", "number long, open long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def write_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; files and checkpoint make each row appear once."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(path)


def upsert_batches(df: DataFrame, apply, checkpoint: str) -> StreamingQuery:
    """apply(batch, epoch) for each micro-batch; the epoch makes a repeated batch recognisable."""
    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
