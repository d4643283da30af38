"""File events as a stream: the state machine by file, and counts in windows of event time."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.operators.state import NO_STATE, advance, relevant, split_moves

EVENTS = "event_id long, ts timestamp, file_path string, dest_path string, kind string, file_hash string"
_OUT = "file_path string, sync_status string, sync_error_count long, events long"
_STATE = "sync_status string, sync_error_count long, events long, last_hash string"


def _advance(key: tuple, frames, state: GroupState):
    now = state.get if state.exists else NO_STATE
    rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
    for kind, digest in zip(rows["kind"], rows["file_hash"], strict=True):
        now = advance(now, kind, digest if isinstance(digest, str) else None)
    state.update(now)
    yield pd.DataFrame({"file_path": [key[0]], "sync_status": [now[0]], "sync_error_count": [now[1]], "events": [now[2]]})


def file_states(events: DataFrame) -> DataFrame:
    """The status of each file that a batch of events touches; columns file_path, kind, file_hash, ts, event_id."""
    return events.groupBy("file_path").applyInPandasWithState(_advance, _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)


def operations_by_window(events: DataFrame, ts: str = "ts", kind: str = "event_type", length: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by kind in windows of event time; events later than ``late`` behind the newest drop out."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, length).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")


def event_source(spark: SparkSession, folder: str, schema: str = EVENTS, files_per_batch: int | None = None) -> DataFrame:
    """A stream of file events from JSON lines that a watcher drops into a folder: those of supported files, moves as a
    deletion and an arrival."""
    reader = spark.readStream.schema(schema)
    reader = reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
    return split_moves(relevant(reader.json(folder)))


def monitor(events: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start the state machine over a stream. Its checkpoint is the queue: an event counts once, however often the
    monitor is started again."""
    out = file_states(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (out.trigger(availableNow=True) if once else out).start()


def stop(query: StreamingQuery, wait: bool = True) -> None:
    """Stop a monitor, after what has arrived if it is to ``wait``."""
    if wait and query.isActive:
        query.processAllAvailable()
    query.stop()


def status(query: StreamingQuery) -> dict:
    """Whether a monitor runs, batches and rows so far as its last progress says, and what ended it."""
    last = query.lastProgress or {}
    error = query.exception()
    return {"running": query.isActive, "batches": last.get("batchId", -1) + 1, "rows": last.get("numInputRows", 0), "error": None if error is None else str(error)}
