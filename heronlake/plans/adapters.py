"""The library's relations over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions.text import tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyword_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as mentions: the property k is the keyword, the type the source, the user's id mod 4 the category."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("article_id"), F.get_json_object("props", "$.k").alias("keyword"), F.col("ts").alias("event_time"), F.to_date("ts").alias("publish_date"),
        F.hour("ts").alias("publish_hour"), F.col("event_type").alias("source"), (F.col("user_id") % 4).cast("string").alias("category"),
    )


def entity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as entities: the user is the entity, the event type its type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("article_id"), F.col("user_id").cast("string").alias("entity_text"), F.col("event_type").alias("entity_type"), F.col("ts").alias("event_time"),
        F.to_date("ts").alias("publish_date"), (F.col("user_id") % 4).cast("string").alias("category"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles: the first line is the title, the event of the same number gives the time."""
    docs = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"))
    title = F.substring_index("text", "\n", 1)
    # Capitalised words of the title stand for entities, typed by their length.
    words = F.filter(F.split(title, r"[^\p{L}]+"), lambda w: w.rlike(r"^\p{Lu}"))
    entities = F.transform(words, lambda w: F.struct(w.alias("text"), F.when(F.length(w) % 3 == 0, "PER").when(F.length(w) % 3 == 1, "LOC").otherwise("ORG").alias("type")))
    rows = docs.join(events, docs["doc_id"] == events["event_id"], "left")
    return rows.select(
        F.col("doc_id").alias("id"), title.alias("title"), F.col("text").alias("content"), "source", F.col("lang").alias("category"), "event_time", F.to_date("event_time").alias("publish_date"),
        F.hour("event_time").alias("publish_hour"), F.concat(F.lit("https://example.net/"), F.col("doc_id").cast("string")).alias("url"), F.col("source").alias("author"),
        F.lit("2024-02-01T00:00:00+00:00").alias("crawled_at"), entities.alias("entities"), F.slice(F.array_distinct(tokens(title)), 1, 3).alias("keywords"),
        F.length("text").alias("content_length"), (F.length("text") >= 500).alias("has_full_content"),
    )
