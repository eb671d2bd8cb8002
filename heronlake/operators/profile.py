"""Profiles of a corpus, and what cleaning changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.functions import vocab as V
from heronlake.functions.entities import normalize_text
from heronlake.operators.ranks import values_at


def shares(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, share in percent)."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    # The total is one row, so values may be many.
    total = counts.agg(F.sum("n").alias("__all"))
    return counts.crossJoin(F.broadcast(total)).select("value", "n", (100 * F.col("n") / F.col("__all")).alias("share"))


def length_profile(rows: DataFrame, length: str = "content_length") -> DataFrame:
    """Mean, and the upper nearest-rank median and 95th percentile (0-based ranks n / 2 and 0.95 n, rounded down).

    Ranks come from counts of lengths in ranges, so no task sorts or holds all distinct lengths.
    """
    rows = rows.select(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("v"))
    made = rows.agg(F.avg("v").alias("mean"), F.min("v").alias("shortest"), F.max("v").alias("longest"), F.count("*").alias("n"))
    ranked = values_at(rows, [], "v", {"p50": F.expr("n div 2"), "p95": F.expr("cast(floor(n * 0.95D) as bigint)")})
    return made.crossJoin(F.broadcast(ranked)).select("mean", "p50", "p95", "shortest", "longest", "n")  # one row each


def presence(articles: DataFrame) -> DataFrame:
    """Counts of groups, canonical rows, authors, keywords and entities."""
    empty = F.coalesce(F.col("author"), F.lit("")) == ""
    return articles.agg(
        F.count_distinct(F.when(F.col("dup_group_id") != "", F.col("dup_group_id"))).alias("dup_groups"), F.count_if("is_canonical").alias("canonical"),
        F.count_if(~empty).alias("with_author"), F.count_if(F.size("keywords") > 0).alias("with_keywords"), F.coalesce(F.sum(F.size("keywords")), F.lit(0)).alias("keywords"),
        F.count_if(F.size("entities") > 0).alias("with_entities"), F.coalesce(F.sum(F.size("entities")), F.lit(0)).alias("entities"),
    )


def top_values(rows: DataFrame, column: str, limit: int = 20) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value").limit(limit)


def top_by_type(entities: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent entities of each type."""
    counts = entities.groupBy("entity_type", "entity_text").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("entity_type").orderBy(F.col("n").desc(), "entity_text"))
    return counts.withColumn("place", place).filter(F.col("place") <= limit)


def clean_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """By entity type: counts before and after cleaning, the difference and the reduction in percent."""
    b = before.groupBy("entity_type").agg(F.count("*").alias("n_before"))
    a = after.groupBy("entity_type").agg(F.count("*").alias("n_after"))
    both = b.join(a, "entity_type", "full").select("entity_type", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    both = both.withColumn("delta", F.col("n_after") - F.col("n_before"))
    return both.withColumn("reduction", F.when(F.col("n_before") > 0, 100 * (F.col("n_before") - F.col("n_after")) / F.col("n_before")).otherwise(0.0))


def most_active_dates(articles: DataFrame, limit: int = 5) -> DataFrame:
    """(publish_date, n) of the days with the most articles."""
    counts = articles.filter(F.col("publish_date").isNotNull()).groupBy("publish_date").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "publish_date").limit(limit)


def cleaning_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: articles, entities and keywords before and after cleaning, the reduction in percent, averages an article."""

    def sizes(rows: DataFrame, suffix: str) -> DataFrame:
        counts = [F.coalesce(F.sum(F.size(F.coalesce(c, F.array()))), F.lit(0)).cast("long").alias(f"{c}_{suffix}") for c in ("entities", "keywords")]
        return rows.agg(F.count("*").alias(f"articles_{suffix}"), *counts)

    # One row each.
    both = sizes(before, "before").crossJoin(sizes(after, "after"))
    for c in ("entities", "keywords"):
        b, a = F.col(f"{c}_before"), F.col(f"{c}_after")
        both = both.withColumn(f"{c}_reduction", F.when(b > 0, 100 * (b - a) / b).otherwise(0.0)).withColumn(f"{c}_per_article", a / F.greatest(F.col("articles_after"), F.lit(1)))
    return both


def rejected_keywords(articles: DataFrame, limit: int = 10) -> DataFrame:
    """(keyword, n) of the keywords that name a category and so go, the most frequent ones."""
    words = articles.select(F.explode("keywords").alias("k")).select(F.lower(normalize_text(F.col("k"))).alias("keyword"))
    counts = words.filter(F.col("keyword").isin(list(V.CATEGORY_KEYWORDS))).groupBy("keyword").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "keyword").limit(limit)
