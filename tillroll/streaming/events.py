"""Streaming forms of three batch steps (extensions; the reference has no
streaming code):

* X1 de-duplication within a watermark (batch parent P4);
* X2 daily tumbling and 7-day sliding totals, rows later than the
  watermark dropped (parents A5, W6);
* X3 surge / drop alerts comparing each closed day with the previous one,
  which is carried across micro-batches as keyed state (parent E3).

Each builder returns a streaming DataFrame; :func:`run_to_table` drives it
with ``trigger(availableNow=True)`` into a parquet table + checkpoint in the
shared checkpoint folder and returns the batch view of the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tillroll.functions.numeric import exact_sum
from tillroll.session import ensure_checkpoint_dir

WATERMARK = "1 day"
SURGE_PCT = 15.0


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """File stream of the events table (schema taken from the batch table)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # watermarks need TIMESTAMP (not NTZ); sessions run in UTC (BASE_CONF)
    # a file stream reads a directory; the table is one file inside it
    src = r.option("pathGlobFilter", "events.parquet").parquet(sf_dir.rstrip("/"))
    return src.withColumn("ts", F.col("ts").cast("timestamp"))


def dedupe_events(events: DataFrame, key: str = "event_id", delay: str = WATERMARK) -> DataFrame:
    """X1 drop repeated ``key`` values seen within the watermark delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def windowed_totals(events: DataFrame, size: str = "1 day", slide: str | None = None,
                    delay: str = WATERMARK) -> DataFrame:
    """X2 per event type and window: events and total value (append mode:
    a window is emitted once the watermark passes its end)."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = events.withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), exact_sum("value").alias("total_value"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "events", "total_value")


def change(total: Column, previous: Column) -> list[Column]:
    """E3 change from the previous window's total, in percent, and its alert."""
    pct = F.when(previous != 0, (total - previous) / previous * 100.0)
    return [pct.alias("change_pct"), F.when(pct > SURGE_PCT, "surge").when(pct < -SURGE_PCT, "drop").alias("alert")]


class LastWindow(StatefulProcessor):
    """Puts the total of the window before beside each window of a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "window_start timestamp, total_value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start, previous = self.last.get() if self.last.exists() else (None, None)
        new = pd.concat(list(rows)).sort_values("window_start")  # the windows of one type that a batch closes
        out = []
        for start, total in zip(map(pd.Timestamp.to_pydatetime, new["window_start"]), new["total_value"], strict=True):
            out.append((key[0], start, total, previous))
            previous = total
        self.last.update((start, previous))
        yield pd.DataFrame(out, columns=["event_type", "window_start", "total_value", "previous_total"])

    def close(self) -> None:
        pass


def surge_alerts(daily: DataFrame) -> DataFrame:
    """X3 each closed window beside the one before it of the same event type.

    The state of a type is one row, the last closed window and its total, however long the
    stream runs; the store keeps it with the checkpoint, so a restart goes on from it and a
    batch reads nothing but its own rows.  Windows of a type close in time order: the
    watermark only rises, and rows of a closed window are dropped before."""

    found = daily.select("event_type", "window_start", "total_value").groupBy("event_type").transformWithStateInPandas(
        LastWindow(), "event_type string, window_start timestamp, total_value double, previous_total double", "append", "none")
    return found.select("event_type", "window_start", "total_value", "previous_total", *change(F.col("total_value"), F.col("previous_total")))


def open_windows(events: DataFrame, size: str = "1 day", slide: str | None = None, delay: str = WATERMARK) -> DataFrame:
    """The windows that are still open at the end of a finite input: a stream in
    append mode never emits them, as no later event moves the watermark past them.
    Their rows cannot be late.  ``events`` is the input read as a batch."""
    # the watermark rounds down to milliseconds
    end = events.agg((F.date_trunc("millisecond", F.max("ts")) - F.expr(f"INTERVAL {delay}")).alias("_mark"))
    totals = windowed_totals(events, size, slide, delay)
    return totals.crossJoin(F.broadcast(end)).where(F.col("window_end") > F.col("_mark")).drop("_mark")  # one row


def events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a batch, with the stream's timestamp type."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def run_surge_alerts(daily: DataFrame, name: str = "surge", still_open: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """X3 to the end of the input: what the stream emits into ``folder`` (a fresh one in the shared
    checkpoint folder; the same one goes on where an earlier run ended), and the windows that
    are ``still_open``, which follow the last closed ones."""
    conf, provider = daily.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(provider)
    conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # keyed state needs it
    try:
        alerts = run_to_table(surge_alerts(daily), name, folder)
    finally:
        conf.set(provider, before)
    if still_open is None:
        return alerts
    kept = ["event_type", "window_start", "total_value"]
    last = alerts.groupBy("event_type").agg(F.max_by(F.struct("window_start", "total_value"), "window_start").alias("w")).select(
        "event_type", "w.window_start", "w.total_value", F.lit(False).alias("_open"))
    rows = still_open.select(*kept, F.lit(True).alias("_open")).unionByName(last)
    w = Window.partitionBy("event_type").orderBy("window_start")  # the open days of one type
    rest = rows.withColumn("previous_total", F.lag("total_value").over(w)).where("_open").select(
        *kept, "previous_total", *change(F.col("total_value"), F.col("previous_total")))
    return alerts.unionByName(rest)


def run_to_table(stream: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Drive a streaming query to completion (``availableNow``) into a parquet
    table with its checkpoint in the shared folder; return the batch view.  A ``folder``
    that an earlier run has used is continued from its checkpoint."""
    spark = stream.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = folder or f"{base}/tillroll-stream-{name}-{uuid.uuid4().hex[:12]}"
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", f"{run}/data").option("checkpointLocation", f"{run}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(f"{run}/data")
