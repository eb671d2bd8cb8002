"""Legacy CSV exports as articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.functions import vocab as V
from heronlake.functions.categories import with_category
from heronlake.functions.entities import ENTITIES, is_person_name, split_keywords
from heronlake.functions.text import clean_content, trimmed
from heronlake.functions.times import iso, to_utc
from heronlake.functions.urls import category_of_url, domain, normalize_url, source_of, stable_id


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("maxCharsPerColumn", -1).csv(path)


def parse_spec(spec: str) -> tuple[str, str]:
    """path:type, where type is rss or html."""
    path, _, kind = spec.rpartition(":")
    if not path or kind not in ("rss", "html"):
        raise ValueError(f"expected path:rss or path:html, got {spec!r}")
    return path, kind


def articles_from_csv(rows: DataFrame, source_type: str, crawled_at: Column | None = None) -> DataFrame:
    """The valid rows as articles; min length 100 for rss and 300 for html."""

    def column(*names: str) -> Column:
        there = [F.col(f"`{n}`") for n in names if n in rows.columns]
        return F.coalesce(*there, F.lit("")) if there else F.lit("")

    least = V.MIN_LENGTH_RSS if source_type == "rss" else V.MIN_LENGTH_HTML
    name = trimmed(column("source.name"))
    raw = rows.select(
        normalize_url(column("url")).alias("url"), clean_content(column("title")).alias("title"), to_utc(column("published_at")).alias("at"),
        clean_content(column("content.text", "content_text")).alias("content"), F.when(is_person_name(name), name).otherwise("").alias("author"),
        split_keywords(column("keywords")).alias("keywords"), trimmed(column("category.primary")).alias("cat"), F.lower(trimmed(column("language"))).alias("lang"),
    )
    valid = raw.filter((F.col("url") != "") & (F.col("title") != "") & F.col("at").isNotNull() & (F.length("content") >= least))
    of_url = category_of_url(F.col("url"))
    category = F.when(F.col("cat").isin("", "trang-chu") & ~of_url.isin("", "trang-chu"), of_url).otherwise(F.col("cat"))
    valid = valid.withColumn("category_raw", category).withColumn("source_domain", domain(F.col("url")))
    valid = with_category(valid, "category_raw", "category_normalized")
    return valid.select(
        stable_id(F.col("url")).alias("id"), "url", "title", "content", iso(F.col("at")).alias("published_at"), iso(crawled_at if crawled_at is not None else F.current_timestamp()).alias("crawled_at"),
        source_of(F.col("source_domain")).alias("source"), "source_domain", F.lit(source_type).alias("source_type"), "category_raw", "category_normalized",
        "author", F.when(F.col("lang") == "", "vi").otherwise(F.col("lang")).alias("language"), "keywords", F.array().cast(ENTITIES).alias("entities"),
        F.length("content").alias("content_length"), (F.length("content") >= V.FULL_LENGTH).alias("has_full_content"),
    )
