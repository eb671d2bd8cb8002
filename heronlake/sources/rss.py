"""RSS feeds: stored XML as articles, with or without the pages behind the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.functions import vocab as V
from heronlake.functions.categories import with_category
from heronlake.functions.entities import ENTITIES, union_keywords
from heronlake.functions.text import clean_content, trimmed
from heronlake.functions.times import iso, to_utc
from heronlake.functions.urls import category_of_url, domain, normalize_url, source_of, stable_id
from heronlake.operators.cleaning import reject_reason

ITEM = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "description", "pubDate", "updated", "author")] + [T.StructField("category", T.ArrayType(T.StringType()))])


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items by Spark's own XML reader; `feed_source` reads Atom as well and pushes the start date down."""
    return spark.read.format("xml").schema(ITEM).option("rowTag", "item").load(path)


def articles_from_feed(items: DataFrame, pages: DataFrame | None = None, start_date=None) -> DataFrame:
    """Valid items as articles. pages, as extract_articles gives them, lend content, category, author, keywords and a
    longer title; items of known dates before start_date are left out."""
    text = clean_content(F.regexp_replace(F.coalesce("description", F.lit("")), r"<[^>]*>", " "))
    terms = F.filter(F.transform(F.coalesce("category", F.array().cast("array<string>")), trimmed), lambda k: k != "")
    # The feed source has read the times already.
    at = F.col("at") if "at" in items.columns else F.coalesce(to_utc(F.col("pubDate")), to_utc(F.col("updated")))
    rows = items.select(
        normalize_url(F.col("link")).alias("url"), trimmed(F.coalesce("title", F.lit(""))).alias("title"), at.alias("at"),
        text.alias("summary"), F.array_distinct(terms).alias("terms"),
    )
    rows = rows.filter((F.col("url") != "") & F.col("at").isNotNull())
    if start_date is not None:
        rows = rows.filter(F.to_date(F.from_utc_timestamp("at", "+07:00")) >= F.lit(start_date))
    if pages is None:
        pages = rows.sparkSession.createDataFrame([], "url string, title string, content string, category_raw string, author string, keywords array<string>")
    found = pages.select(normalize_url(F.col("url")).alias("url"), F.col("title").alias("p_title"), F.col("content").alias("p_content"), "category_raw", "author", "keywords")
    rows = rows.join(found, "url", "left")
    body = F.coalesce("p_content", F.lit(""))
    section = F.coalesce("category_raw", F.lit(""))
    rows = rows.select(
        "url", "at", F.when(F.length("p_title") > F.length("title"), F.col("p_title")).otherwise(F.col("title")).alias("title"),
        F.when((F.length(body) < V.MIN_LENGTH_RSS) & (F.col("summary") != ""), F.col("summary")).otherwise(body).alias("content"),
        F.when(section == "", category_of_url(F.col("url"))).otherwise(section).alias("category_raw"), F.coalesce("author", F.lit("")).alias("author"),
        union_keywords(F.col("terms"), F.col("keywords")).alias("keywords"), domain(F.col("url")).alias("source_domain"),
    )
    rows = rows.withColumn("published_at", iso(F.col("at")))
    valid = rows.filter(reject_reason(F.col("title"), F.col("content"), F.col("published_at"), V.MIN_LENGTH_RSS).isNull())
    valid = with_category(valid, "category_raw", "category_normalized")
    return valid.select(
        stable_id(F.col("url")).alias("id"), "url", "title", "content", "published_at", iso(F.current_timestamp()).alias("crawled_at"), source_of(F.col("source_domain")).alias("source"), "source_domain",
        F.lit("rss").alias("source_type"), "category_raw", "category_normalized", "author", F.lit("vi").alias("language"), "keywords",
        F.array().cast(ENTITIES).alias("entities"), F.length("content").alias("content_length"), (F.length("content") >= V.FULL_LENGTH).alias("has_full_content"),
    )
