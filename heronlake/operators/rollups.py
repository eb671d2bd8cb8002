"""Long event tables and the rollups over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.functions.text import trimmed

HOURLY = ["publish_date", "publish_hour", "keyword", "category", "source"]
DAILY_KEYWORD = ["publish_date", "keyword", "category"]
#: The category is a key: sums by category stay right.
DAILY_ENTITY = ["publish_date", "entity_text", "entity_type", "category"]


def keyword_events(articles: DataFrame) -> DataFrame:
    """A row for each article and keyword that isn't blank; an unknown hour counts as 0."""
    rows = articles.select(F.col("id").alias("article_id"), F.explode("keywords").alias("keyword"), "event_time", "publish_date", F.coalesce("publish_hour", F.lit(0)).alias("publish_hour"), "source", "category")
    return rows.withColumn("keyword", trimmed(F.col("keyword"))).filter("keyword <> ''")


def entity_events(articles: DataFrame) -> DataFrame:
    """A row for each article and entity with a text and a type."""
    rows = articles.select(F.col("id").alias("article_id"), F.explode("entities").alias("e"), "event_time", "publish_date", "source", "category")
    rows = rows.select("article_id", trimmed(F.col("e.text")).alias("entity_text"), trimmed(F.col("e.type")).alias("entity_type"), "event_time", "publish_date", "source", "category")
    return rows.filter("entity_text <> '' and entity_type <> ''")


def entity_arrays(articles: DataFrame) -> DataFrame:
    """Entities as two parallel arrays."""
    return articles.withColumn("entity_texts", F.transform("entities", lambda e: e["text"])).withColumn("entity_types", F.transform("entities", lambda e: e["type"]))


def rollup(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.groupBy(*keys).agg(F.count("*").alias("mention_count"))


def merge_rollups(*parts: DataFrame, keys: list[str]) -> DataFrame:
    """The sum of partial rollups."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*keys).agg(F.sum("mention_count").alias("mention_count"))
