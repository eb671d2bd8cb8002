"""Roles: guests see canonical rows without some columns; administrators see everything.

The row and the column policy hold for search and for details alike. Trend queries count all rows for every role.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIDDEN_FROM_GUESTS = ("author", "crawled_at", "url")


def visible(articles: DataFrame, role: str = "guest") -> DataFrame:
    if role not in ("guest", "admin"):
        raise ValueError(f"no such role: {role}")
    return articles if role == "admin" else articles.filter("is_canonical").drop(*HIDDEN_FROM_GUESTS)


def publish_view(articles: DataFrame, name: str = "news_public") -> None:
    """A view of the canonical rows."""
    articles.filter("is_canonical").createOrReplaceTempView(name)


def admin_stats(articles: DataFrame, keyword_events: DataFrame, entity_events: DataFrame) -> DataFrame:
    """Counts of all, public and hidden articles and of both event tables; one pass over each."""
    counts = articles.agg(F.count("*").alias("articles_full"), F.count_if("is_canonical").alias("articles_public"))
    counts = counts.withColumn("hidden", F.col("articles_full") - F.col("articles_public"))
    # One row each.
    return counts.crossJoin(keyword_events.agg(F.count("*").alias("keyword_events"))).crossJoin(entity_events.agg(F.count("*").alias("entity_events")))
