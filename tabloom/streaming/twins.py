"""Streaming twins: the batch jobs on unbounded input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.wiki import wiki_tables
from tabloom.session import written
from tabloom.sources.dumps import PAGE_START, parse_pages


def stream_pages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """New dump files as a stream of pages."""
    text = spark.readStream.option("lineSep", PAGE_START).options(**options).text(path)
    return parse_pages(text.select("value", F.col("_metadata.file_name").alias("file")))


def stream_wiki(spark: SparkSession, path: str, out: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Route arriving pages into five parquet tables.

    A batch writes below its own number and overwrites it on a retry, so no row is lost or
    repeated.
    """

    def route(batch: DataFrame, number: int) -> None:
        stored = written(batch, "micro-batch")
        for name, table in wiki_tables(stored).items():
            table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    return (stream_pages(spark, path, **options).writeStream.foreachBatch(route)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def with_progress(df: DataFrame, name: str = "progress", file: str | None = "file") -> DataFrame:
    """Attach row counts to a frame; they appear in the query progress, or in an Observation."""
    counts = [F.count(F.lit(1)).alias("pages")]
    if file and file in df.columns:
        counts.append(F.approx_count_distinct(file).alias("files"))
    return df.observe(name, *counts)


def follow(query: StreamingQuery, name: str = "progress", every: int = 1000, say: Callable[[str], None] = print, wait: float = 0.2) -> list[tuple[int, int, int, int]]:
    """Watch a running query until it ends: (batch, pages, files, total) of every batch that ``with_progress`` counted.

    The counts of a batch are read from the query's progress as soon as it is done; ``say`` gets a line for every full multiple of
    ``every`` pages. An error of the query is raised. What the driver holds is one line per batch.
    """
    seen: dict[int, tuple[int, int, int, int]] = {}
    total = 0
    while True:
        running = query.isActive
        for p in query.recentProgress:
            counts = p["observedMetrics"].get(name) if p["observedMetrics"] else None
            if counts is None or p["batchId"] in seen:
                continue
            pages, files = counts["pages"], counts.asDict().get("files", 0)
            for multiple in range(total // every + 1, (total + pages) // every + 1):
                say(f"{multiple * every} pages")
            total += pages
            seen[p["batchId"]] = (p["batchId"], pages, files, total)
        if not running:
            query.awaitTermination()
            return list(seen.values())
        query.awaitTermination(wait)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with time zone; a plain one is read in the session zone."""
    return df if df.schema[ts].dataType.simpleString() == "timestamp" else df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_ohlc(df: DataFrame, ts: str, price: str, seq: str, period: str = "1 hour", delay: str = "1 hour",
                keys: Sequence[str] = ()) -> DataFrame:
    """Price bars; a bar is final once the watermark has passed its end."""
    at = F.struct(ts, seq)
    bars = event_time(df, ts).withWatermark(ts, delay).groupBy(*keys, F.window(ts, period)).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, at).alias("close"))
    return bars.select(*keys, F.col("window.start").alias("period"), "open", "high", "low", "close")


def stream_dedupe(df: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """One record per key; state is kept for the delay only."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
