"""Incremental rollups over streams.

Rollups are merged like partial sums: each micro-batch writes its own counts under its batch id, replacing what an
earlier try of the same batch wrote, and readers sum. So a retry changes nothing, and no reader waits for a merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heronlake.operators.dedup import first_wins
from heronlake.operators.rollups import rollup


def maintain_rollup(events: DataFrame, keys: list[str], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep a rollup of a stream of events at path."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rollup(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_rollup(spark, path: str, keys: list[str]) -> DataFrame:
    return spark.read.parquet(path).groupBy(*keys).agg(F.sum("mention_count").alias("mention_count"))


def compact(spark, path: str, to: str, keys: list[str]) -> None:
    """Write the sums of all batches at path as one batch of a new rollup at `to`.

    `to` must be another place: a rollup that held both its batches and their sum would count twice. Readers go over to
    the new rollup once it is written, and the stream that maintains it starts there with a checkpoint of its own.
    """
    if _same_place(path, to):
        raise ValueError("a rollup can't be compacted in its own place")
    read_rollup(spark, path, keys).write.mode("errorifexists").parquet(f"{to}/batch=-1")


def _same_place(a: str, b: str) -> bool:
    a, b = (x.removeprefix("file://").removeprefix("file:").rstrip("/") + "/" for x in (a, b))
    return a.startswith(b) or b.startswith(a)


def buckets(events: DataFrame, time: str = "event_time", hours: int = 4, lateness: str = "1 hour") -> DataFrame:
    """Counts by tumbling windows of a stream (or a table)."""
    rows = events.withColumn("__t", F.col(time).cast("timestamp"))
    rows = rows.withWatermark("__t", lateness) if events.isStreaming else rows
    return rows.groupBy(F.window("__t", f"{hours} hours").alias("w")).agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd'T'HH").alias("bucket"), "n")


def maintain_buckets(events: DataFrame, path: str, checkpoint: str, time: str = "event_time", hours: int = 4, lateness: str = "1 hour", available_now: bool = True) -> StreamingQuery:
    """Append the counts of each window to files at path once no row of it can be in time any more.

    Rows that come after their window has closed are dropped; `late_rows` tells how many. State is bounded by the windows
    that are still open.
    """
    counted = buckets(events, time, hours, lateness)
    writer = counted.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_rows(query: StreamingQuery, counted: DataFrame, still_open: int = 0) -> int:
    """How many rows a query over windows has read and not counted, apart from those of windows that are still open.

    Spark's own number of dropped rows is taken behind the partial counts of a batch, so it isn't one of rows.
    """
    read = sum(p["numInputRows"] for p in query.recentProgress)
    return read - (counted.agg(F.sum("n")).first()[0] or 0) - still_open


def maintain_first_seen(events: DataFrame, key: str, path: str, checkpoint: str, time: str = "event_time", within: str = "7 days", available_now: bool = True) -> StreamingQuery:
    """Append the first row of each key to files at path; see first_seen."""
    writer = first_seen(events, key, time, within).writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def first_seen(events: DataFrame, key: str, time: str = "event_time", within: str = "7 days") -> DataFrame:
    """The first row of each key of a stream, with state bounded by a watermark."""
    rows = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", within)
    return rows.dropDuplicatesWithinWatermark([key]).drop("__t")


#: Folders that the keys of appended rows are dealt to by their hash.
KEY_FOLDERS = 64


def append_new(events: DataFrame, key: str, order: list[str], path: str, checkpoint: str, folders: int = KEY_FOLDERS, available_now: bool = True) -> StreamingQuery:
    """Append the rows of a stream whose key isn't at path yet; of rows of a batch that share a key the first stays.

    Rows go to path/rows by batch, their keys to path/seen by the hash of the key. A batch reads the keys of the folders
    that its own keys fall in, and of these one column; a retry replaces what an earlier try of the batch wrote.
    """
    spark = events.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        folder = F.pmod(F.xxhash64(F.col(key)), F.lit(folders)).cast("int")
        fresh = first_wins(batch, key, order).withColumn("folder", folder)
        kind = batch.schema[key].dataType.simpleString()
        seen = spark.read.schema(f"{key} {kind}, batch bigint, folder int").option("basePath", f"{path}/seen")
        if batch_id:
            # At most `folders` numbers.
            touched = sorted(r["folder"] for r in fresh.select("folder").distinct().collect())
            stored = seen.parquet(f"{path}/seen").filter((F.col("batch") < batch_id) & F.col("folder").isin(touched))
            fresh = fresh.join(stored.select("folder", key), ["folder", key], "left_anti")
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        kept = spark.read.parquet(f"{path}/rows/batch={batch_id}").select(key, folder.alias("folder"))
        kept.write.mode("overwrite").partitionBy("folder").parquet(f"{path}/seen/batch={batch_id}")

    writer = events.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_appended(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("batch")


def circuit_breaker(log: DataFrame, failures: int = 6) -> DataFrame:
    """Over a log (domain, at, ok): whether a request falls in a state of `failures` failures in a row before it.

    One task sorts the requests of a domain, as the state of a domain depends on all before; pass a day's log, say.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("domain").orderBy("at")
    # A run of failures starts after each success.
    rows = log.withColumn("run", F.sum(F.col("ok").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    before = Window.partitionBy("domain", F.coalesce("run", F.lit(0))).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.coalesce(F.sum((~F.col("ok")).cast("int")).over(before), F.lit(0))
    return rows.withColumn("blocked", failed >= failures).drop("run")
