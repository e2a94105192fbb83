"""Windows, deduplication and rate limits that run on a batch or a stream alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.folds import fold


def tumbling_counts(events: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sliding_counts(events: DataFrame, width: str, step: str, late: str = "1 hour") -> DataFrame:
    w = F.window("ts", width, step)
    return events.withWatermark("ts", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def session_counts(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    w = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def dedupe(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first event of each key, by ts and then the other columns. On a stream it is the first that arrives, a key is forgotten when the watermark has passed it, so a repeat
    must come within ``late`` to be dropped; state stays bounded."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
    others = ["ts", *(c for c in events.columns if c != "ts" and c not in keys)]
    first = events.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_first"))
    return first.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in others)).select(*events.columns)


def rate_limit(events: DataFrame, limit: int, seconds: int) -> DataFrame:
    """(event_id, user_id, n, allowed): a window opens at a user's first event outside the last one and lasts ``seconds``; the first ``limit`` events of it are allowed.

    A fold over one user's events in order.
    """

    def run(times: np.ndarray) -> list:
        out, opened, n = [], None, 0
        for t in times.tolist():
            if opened is None or t >= opened + seconds * 1_000_000:
                opened, n = t, 0
            n += 1
            out.append(n)
        return out

    ordered = F.array_sort(F.collect_list(F.struct(F.unix_micros("ts").alias("t"), "event_id")))
    users = events.groupBy("user_id").agg(ordered.alias("l")).withColumn("n", fold(F.transform("l", lambda e: e["t"]), "array<bigint>", run))
    rows = users.select("user_id", F.explode(F.arrays_zip("l", "n")).alias("z"))
    return rows.select(F.col("z.l.event_id").alias("event_id"), "user_id", F.col("z.n").alias("n"), (F.col("z.n") <= limit).alias("allowed"))


def rate_limit_stream(events: DataFrame, limit: int, seconds: int, late: str = "1 hour") -> DataFrame:
    """The same on a stream of (event_id, user_id, ts): state is each user's window start and count.

    Within a batch events are taken in order. State is dropped once the watermark has passed the end of a
    user's window, as any later event opens a new one. An event that comes after later ones of its user counts
    in the window that is open, unlike in the batch form, and one that is later than the watermark gets no answer;
    the two forms agree on events that arrive in order.
    """

    def update(key, batches: Iterator[pd.DataFrame], state):
        if state.hasTimedOut:
            state.remove()
            return
        start, n = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        counts = []
        for t in rows["ts"].astype("datetime64[us]").astype("int64"):
            if start is None or t >= start + seconds * 1_000_000:
                start, n = int(t), 0
            n += 1
            counts.append(n)
        state.update((start, n))
        state.setTimeoutTimestamp(max(start // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"event_id": rows["event_id"].to_numpy(), "user_id": key[0], "n": counts, "allowed": [c <= limit for c in counts]})

    timed = events.withWatermark("ts", late)
    return timed.groupBy("user_id").applyInPandasWithState(update, "event_id long, user_id long, n long, allowed boolean", "start long, n long", "append", "EventTimeTimeout")


def read_files(spark: SparkSession, path: str, schema, per_batch: int = 100, form: str = "parquet") -> DataFrame:
    """A stream over files that arrive in a folder, ``per_batch`` of them at most in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(form).load(path)


def process_new(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Handles what has arrived since the last run, batch by batch, and stops; a restart goes on where it ended.

    ``handle`` gets each micro-batch and its number; a batch that failed comes again with the same number, so
    it should replace what that number wrote.
    """
    return stream.writeStream.foreachBatch(handle).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()


def gated(allowed: DataFrame) -> DataFrame:
    """Which users end without model answers: their last event is over the limit."""
    last = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("event_id").desc()))
    return allowed.withColumn("_r", last).where("_r = 1").select("user_id", (~F.col("allowed")).alias("no_llm"))
