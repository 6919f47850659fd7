"""Streaming twins: the table arrives as a file stream and runs until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tabloom.catalog.registry import Tables, query
from tabloom.catalog.storage import _ARTICLES, _TEMPLATES, _LINKS, _WIKI, _dump_path, _pages
from tabloom.session import new_path
from tabloom.streaming import twins as ST
from tabloom.streaming.rolling import stream_rolling


SLICES, SLICE_FILES = 4, 2


def _stream(t: Tables, name: str, late: bool = True) -> DataFrame:
    """The table as a stream of several triggers: slices in time order, and one far later row that lets the
    last windows close (its id is -1).

    With ``late``, every third row of the last half hour of a slice arrives with the next slice.
    """
    path = new_path(t.spark, "arrivals")
    rows = getattr(t, name)
    cuts = rows.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).agg(F.percentile_approx("us", [k / SLICES for k in range(1, SLICES)]).alias("c")).first()["c"]
    us, half_hour = F.unix_micros(F.col("ts").cast("timestamp")), 1_800_000_000
    home = sum((us > c).cast("int") for c in cuts)
    if late:
        home = home + sum(((us > c - half_hour) & (us <= c) & (F.col("event_id") % 3 == 0)).cast("int") for c in cuts)
    flush = rows.orderBy(F.desc("ts")).limit(1).withColumns({"ts": F.col("ts") + F.expr("interval 30 days"), "event_id": F.lit(-1).cast(rows.schema["event_id"].dataType)})
    # one pass cuts the table into slices; then each of them arrives, in its order
    staged = new_path(t.spark, "slices")
    rows.withColumn("_slice", home).unionByName(flush.unionByName(flush).withColumn("_slice", F.lit(SLICES))).write.partitionBy("_slice").parquet(staged)
    cut = t.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(staged)
    for k in range(SLICES + 1):
        cut.filter(F.col("_slice") == k).drop("_slice").repartition(SLICE_FILES).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", SLICE_FILES).parquet(path)


def _run(t: Tables, df: DataFrame) -> DataFrame:
    """Run a stream to the end of its input and return what it wrote."""
    out = new_path(t.spark, "stream")
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", new_path(t.spark, "state"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return t.spark.read.schema(df.schema).parquet(out)


@query("st_ohlc", """WITH b AS (SELECT date_trunc('hour', ts) AS period, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1)
SELECT * FROM b""")
def _(t):
    bars = _run(t, ST.stream_ohlc(_stream(t, "events"), "ts", "value", "event_id"))
    return bars.withColumn("period", F.col("period").cast("timestamp_ntz"))


@query("st_rolling", """SELECT event_id, user_id, ts, max(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '2 days 23:59:59.999999' PRECEDING AND CURRENT ROW) AS rolled FROM events""")
def _(t):
    return _run(t, stream_rolling(_stream(t, "events"), ["user_id"], "ts", "3 days", "value", "event_id")).filter("event_id >= 0")


@query("st_dedupe", "SELECT event_id FROM events")
def _(t):
    twice = _stream(t, "events").unionByName(_stream(t, "events", late=False))
    once = _run(t, ST.stream_dedupe(twice.select("event_id", "ts"), "ts", ["event_id"]).select("event_id"))
    return once.filter("event_id >= 0")


@query("st_ingest_route", f"""SELECT 'article' AS name, count(*) AS n FROM {_ARTICLES} UNION ALL SELECT 'articleTemplate', count(*) FROM ({_TEMPLATES})
UNION ALL SELECT 'articleLink', count(*) FROM ({_LINKS}) UNION ALL SELECT 'redirect', count(*) FROM ({_WIKI}) WHERE ns = 0 AND redirect IS NOT NULL
UNION ALL SELECT 'template', count(*) FROM ({_WIKI}) WHERE ns = 10""")
def _(t):
    out = new_path(t.spark, "routed")
    ST.stream_wiki(t.spark, _dump_path(t), out, new_path(t.spark, "state")).awaitTermination()
    counts = None
    for name in ("article", "articleTemplate", "articleLink", "redirect", "template"):
        one = t.spark.read.parquet(f"{out}/{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("st_progress", "SELECT count(*) AS pages, count(*) // 50 AS messages, true AS adds_up, true AS several FROM documents")
def _(t):
    """Pages arrive in several triggers; the table of batches is filled while the query runs, and a message comes at every 50 pages."""
    said: list[str] = []
    pages = ST.with_progress(ST.stream_pages(t.spark, _dump_path(t, parts=5), maxFilesPerTrigger="1"))
    q = (pages.writeStream.format("parquet").option("checkpointLocation", new_path(t.spark, "state")).trigger(availableNow=True)
         .start(new_path(t.spark, "pages")))
    lines = ST.follow(q, every=50, say=said.append)
    table = t.spark.createDataFrame(lines, "batch long, pages long, files long, total long")
    return table.agg(F.sum("pages").alias("pages"), F.lit(len(said)).cast("long").alias("messages"), (F.sum("pages") == F.max("total")).alias("adds_up"),
                     (F.count_if(F.col("pages") > 0) > 1).alias("several"))
