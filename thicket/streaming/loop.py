"""Repeated runs: a plain loop, and jobs driven by a stream of changed files."""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.config import duration

#: Shortest interval.
LEAST = timedelta(minutes=1)


def parse_every(text: str) -> timedelta:
    """30m, 6h, 1h30m, or whole days such as 1d; at least a minute."""
    try:
        found = timedelta(days=int(text[:-1])) if re.fullmatch(r"[+-]?\d+d", text) else duration(text)
    except (ValueError, OverflowError):
        raise ValueError(f"{text!r}: use a duration such as 30m, 6h or 1d") from None
    if found < LEAST:
        raise ValueError(f"{text!r}: must be at least {LEAST}")
    return found


def run_loop(every: timedelta, once: Callable[[], int], stop: threading.Event, say: Callable[[str], None] = print, clock: Callable[[], float] = time.monotonic) -> int:
    """`once` now and then every interval, from the start of each run, until `stop`. Failures end nothing."""
    while True:
        began = clock()
        once()
        if stop.is_set():
            return 0
        wait = max(0.0, every.total_seconds() - (clock() - began))
        say(f"next run at {(datetime.now().astimezone() + timedelta(seconds=wait)).isoformat(timespec='seconds')} (in {timedelta(seconds=round(wait))})")
        if stop.wait(wait):
            return 0


def on_new_files(spark: SparkSession, path: str, checkpoint: str, handle: Callable[[DataFrame, int], None], available_now: bool = False) -> StreamingQuery:
    """Call handle(lines, batch) for new files below `path`, with lines (spec, pos, line): each file once, also over restarts."""
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    bodies = stream.select(F.col("path").alias("spec"), F.col("content").cast("string").alias("body"))

    def each(batch: DataFrame, n: int) -> None:
        from ..functions.text import lines

        handle(lines(batch), n)

    writer = bodies.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
