"""The load job: ready articles to the tables that trend queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.operators.rollups import DAILY_ENTITY, DAILY_KEYWORD, HOURLY, entity_arrays, entity_events, keyword_events, rollup
from heronlake.sources.tables import write_monthly

#: The rollups by name: the event table that each is made of, and its keys.
ROLLUPS = {
    "hourly_keyword_stats": ("keyword_events", HOURLY),
    "daily_keyword_stats": ("keyword_events", DAILY_KEYWORD),
    "daily_entity_stats": ("entity_events", DAILY_ENTITY),
}
TABLES = ("articles", "keyword_events", "entity_events", *ROLLUPS)


class RepeatedKey(ValueError):
    """A key that must be unique occurs more than once."""


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of the keys that several rows share; an aggregate with partial counts."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(rows: DataFrame, key: str) -> DataFrame:
    """rows, or RepeatedKey with some of the keys that occur more than once."""
    found = repeated_keys(rows, key).limit(5).collect()
    if found:
        raise RepeatedKey(f"{key} isn't unique: {[r[key] for r in found]}, ...")
    return rows


def load_articles(ready: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ready articles under path as articles, keyword and entity events and three rollups, each by month.

    mode is Spark's: `overwrite` replaces what is there, `append` adds to it. Appended articles must be new ones: an id
    that occurs twice, or is stored already, is refused before anything is written. Readers of rollups sum, so the
    partial rollups of several loads need no merge. The articles are read once; the other tables come from what is written,
    event tables from a few columns of it and rollups from the narrow events.
    """
    if mode not in ("overwrite", "append", "errorifexists"):
        raise ValueError(f"no such mode: {mode}")
    spark = ready.sparkSession
    require_unique(ready, "id")
    batch = 0
    if mode == "append" and _exists(spark, f"{path}/articles"):
        stored = spark.read.parquet(f"{path}/articles")
        if not ready.join(stored.select("id"), "id", "left_semi").isEmpty():
            raise RepeatedKey("some ids are stored already")
        batch = stored.agg(F.max("load")).first()[0] + 1
    # What this load wrote is told from what others did by its number.
    write_monthly(entity_arrays(ready).withColumn("load", F.lit(batch)), f"{path}/articles", sort=["publish_date", "id"], mode=mode)
    articles = spark.read.parquet(f"{path}/articles").filter(F.col("load") == batch)
    for name, events, sort in (("keyword_events", keyword_events, ["publish_date", "keyword"]), ("entity_events", entity_events, ["publish_date", "entity_type", "entity_text"])):
        write_monthly(events(articles).withColumn("load", F.lit(batch)), f"{path}/{name}", sort=sort, mode=mode)
    for name, (events, keys) in ROLLUPS.items():
        written = spark.read.parquet(f"{path}/{events}").filter(F.col("load") == batch)
        write_monthly(rollup(written, keys), f"{path}/{name}", sort=keys, mode=mode)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def loaded_counts(spark: SparkSession, path: str) -> DataFrame:
    """(table, ym, n): the rows of each table and month, from the statistics of the files."""
    counts = None
    for name in TABLES:
        own = spark.read.parquet(f"{path}/{name}").groupBy("ym").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "ym", "n")
        counts = own if counts is None else counts.unionByName(own)
    return counts
