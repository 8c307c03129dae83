"""Structured Streaming counterparts of triggers: windows, sessions, de-duplication, late data, sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..runtime import shared_dir


def file_stream(spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_trigger: int | None = 100, **options: str) -> DataFrame:
    """New files of a folder as a stream (files, feeds, sheets and mail drops alike); without a number, all at once."""
    limit = {"maxFilesPerTrigger": str(files_per_trigger)} if files_per_trigger else {}
    return spark.readStream.format(kind).schema(schema).options(**limit, **options).load(path)


def table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """The files of a Parquet table as a stream, be the table one file or a folder of them; Spark streams no path of a single file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return file_stream(spark, path, schema)
    return file_stream(spark, path.rpartition("/")[0], schema, pathGlobFilter=at.getName())


def broker_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a topic; needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def tumbling_counts(events: DataFrame, time: str, by: list[str], width: str, value: str, late: str | None = None, slide: str | None = None) -> DataFrame:
    """``(by, window_start, n, total)`` per window; works on streams (with ``late``) and on tables."""
    if late:
        events = events.withWatermark(time, late)
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(*by, F.col("w.start").alias("window_start"), "n", "total")


def session_windows(events: DataFrame, time: str, by: list[str], gap: str, late: str | None = None) -> DataFrame:
    """``(by, session_start, session_end, n)``: runs of events with less than ``gap`` between them."""
    if late:
        events = events.withWatermark(time, late)
    out = events.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def stream_dedup(events: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first event of each key within the watermark; state older than it is dropped."""
    if events.isStreaming:
        return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", kind: str = "parquet") -> StreamingQuery:
    """Process what has arrived, then stop: the scheduled form of a stream."""
    query = stream.writeStream.format(kind).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def run_every(stream: DataFrame, path: str, checkpoint: str, interval: str, mode: str = "append", kind: str = "parquet") -> StreamingQuery:
    """A stream on a schedule, such as ``5 minutes``, until it is stopped; after a restart it goes on from its checkpoint."""
    return stream.writeStream.format(kind).outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start(path)


def to_broker(stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None) -> StreamingQuery:
    """Rows as JSON messages to a topic, keyed by a column; needs the Kafka connector on the class path."""
    rows = stream.select(*([F.col(key).cast("string").alias("key")] if key else []), F.to_json(F.struct("*")).alias("value"))
    sink = rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:8]}"


def to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """What the stream gives from all that has arrived, as a table in the shared folder, with its checkpoint beside it.

    In mode ``complete`` every micro-batch writes the whole result anew; the last one counts.
    """
    at = _folder(stream.sparkSession, label)
    if mode == "append":
        run_available(stream, f"{at}/rows", f"{at}/checkpoint")
        return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/rows")
    last = []

    def whole(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/v{number}")  # a batch that is tried again replaces its own
        last[:] = [number]

    query = stream.writeStream.foreachBatch(whole).outputMode(mode).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(*[f"{at}/v{n}" for n in last])


def deliver(deliveries: list[DataFrame], steps: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Deliveries that arrive one after the other, each run through ``steps`` when it is there; the rows given out, as a table.

    State and watermark go on from one to the next by the checkpoint, so rows too late for a window that was
    closed after an earlier delivery are dropped, and windows still open at the end are not given out.
    """
    spark, at = deliveries[0].sparkSession, _folder(deliveries[0].sparkSession, label)
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{at}/arrived")
        out = steps(file_stream(spark, f"{at}/arrived", rows.schema, files_per_trigger=None))
        run_available(out, f"{at}/rows", f"{at}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{at}/rows")


def split_to_tables(stream: DataFrame, is_error, label: str) -> tuple[DataFrame, DataFrame]:
    """``split_errors`` into two tables in the shared folder: the good rows and the others."""
    at, spark = _folder(stream.sparkSession, label), stream.sparkSession

    def write(kind):
        return lambda batch, number: batch.write.mode("overwrite").parquet(f"{at}/{kind}/batch={number}")

    split_errors(stream, is_error, write("good"), write("bad"), f"{at}/checkpoint")
    return tuple(spark.read.schema(stream.schema).parquet(f"{at}/{kind}").select(*stream.columns) for kind in ("good", "bad"))


def split_errors(stream: DataFrame, is_error, good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Rows that fail go to ``bad``, the others to ``good``, batch by batch; each batch is computed once."""

    def both(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            failed = F.coalesce(is_error, F.lit(False))
            good(batch.where(~failed), number)
            bad(batch.where(failed), number)
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], keys: list[str], time: str, checkpoint: str) -> StreamingQuery:
    """The latest row per key of each micro-batch to ``write`` (a database's upsert)."""

    def latest(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct("*"), time).alias("_r"))
        write(newest.select("_r.*"), number)

    query = stream.writeStream.foreachBatch(latest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class _Delay(StatefulProcessor):
    def __init__(self, delay_ms: int):
        self.delay = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "row string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame["row"]:
                self.held.appendValue((row,))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = [r[0] for r in self.held.get()]
        self.held.clear()
        if rows:
            yield pd.DataFrame({"key": [key[0]] * len(rows), "row": rows})

    def close(self) -> None:
        pass


def wait(stream: DataFrame, key: str, delay_ms: int) -> DataFrame:
    """``(key, row)``: rows as JSON, held per key for ``delay_ms`` of processing time.

    The session's state store must be RocksDB, and a query with a processing-time trigger must run on.
    """
    rows = stream.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("row"))
    return rows.groupBy("key").transformWithStateInPandas(_Delay(delay_ms), "key string, row string", "append", "processingTime")
