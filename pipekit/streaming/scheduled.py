"""Bodies that run at a fixed rate, over what has arrived since the last run."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def at_rate(rows: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, every: str = "1 minute",
            name: str | None = None) -> StreamingQuery:
    """Run ``body`` on the new rows of a stream at each tick of ``every`` that finds some; a tick without new rows runs
    nothing. The checkpoint holds what was done, so a restart goes on from there; a tick that was cut short runs again
    with the same rows and number."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(body)
    return (writer.queryName(name) if name else writer).start()


def run_ticks(query: StreamingQuery, ticks: int, timeout: float = 120, idle: float = 0) -> list[dict]:
    """Wait for the progress of ``ticks`` runs with rows (and ``idle`` seconds beyond), stop the query and give their
    progress events. A query that fails raises its error; one too slow raises TimeoutError."""
    end, seen = time.monotonic() + timeout, {}
    try:
        while len(seen) < ticks:
            if time.monotonic() > end:
                raise TimeoutError(f"{len(seen)} of {ticks} ticks after {timeout} s")
            if query.awaitTermination(0.1):
                break
            seen |= {p["batchId"]: p for p in query.recentProgress if p["numInputRows"]}
        if idle:
            query.awaitTermination(idle)
        seen |= {p["batchId"]: p for p in query.recentProgress if p["numInputRows"]}
    finally:
        query.stop()
    return [seen[k] for k in sorted(seen)]


def run_until(query: StreamingQuery, done: Callable[[], bool], timeout: float = 120) -> None:
    """Let a query run until ``done``, then stop it. A query that fails raises its error; one too slow raises
    TimeoutError."""
    end = time.monotonic() + timeout
    try:
        while not done():
            if time.monotonic() > end:
                raise TimeoutError(f"not done after {timeout} s")
            if query.awaitTermination(0.1):
                break
    finally:
        query.stop()
