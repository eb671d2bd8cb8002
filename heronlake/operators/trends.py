"""Trend queries: top keywords, spikes, hours, entities, timelines, sources.

`as_of` is the last day of a window (a date); windows hold the `days` days before it too. All windows compare the
date column with literals, so the scan prunes and pushes down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.functions.times import before_that, since


#: Rows of a report and days of a window, at most.
MAX_LIMIT, MAX_DAYS = 100, 365


def last_day(events: DataFrame, column: str = "publish_date"):
    """The latest day of a table: one scalar, from column statistics where the source has them."""
    return events.agg(F.max(column)).first()[0]


def _checked(limit: int = 1, days: int = 1) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be from 1 to {MAX_LIMIT}, not {limit}")
    if not 1 <= days <= MAX_DAYS:
        raise ValueError(f"a window must be from 1 to {MAX_DAYS} days, not {days}")


def _top(rows: DataFrame, by: str, key: str, limit: int) -> DataFrame:
    return rows.orderBy(F.col(by).desc(), F.col(key)).limit(limit)


def top_keywords(daily: DataFrame, as_of, days: int = 7, category: str | None = None, limit: int = 20) -> DataFrame:
    _checked(limit, days)
    rows = daily.filter(since("publish_date", as_of, days))
    rows = rows if category is None else rows.filter(F.col("category") == category)
    return _top(rows.groupBy("keyword").agg(F.sum("mention_count").alias("total")), "total", "keyword", limit)


def as_daily(events: DataFrame) -> DataFrame:
    """Events where a rollup is expected: each counts once, and the report's own aggregation is the only one."""
    return events.withColumn("mention_count", F.lit(1).cast("long"))


def hot_keywords(daily: DataFrame, as_of, window_days: int = 7, min_now: int = 5, limit: int = 20) -> DataFrame:
    """Keywords by growth against the window before: one scan with conditional sums instead of a join of two."""
    _checked(limit, window_days)
    now, before = since("publish_date", as_of, window_days), before_that("publish_date", as_of, window_days)
    rows = daily.filter(since("publish_date", as_of, 2 * window_days))
    counts = rows.groupBy("keyword").agg(
        F.coalesce(F.sum(F.when(now, F.col("mention_count"))), F.lit(0)).alias("count_now"),
        F.coalesce(F.sum(F.when(before, F.col("mention_count"))), F.lit(0)).alias("count_prev"),
    )
    return _spikes(counts, min_now, limit)


def hot_keywords_joined(daily: DataFrame, as_of, window_days: int = 7, min_now: int = 5, limit: int = 20) -> DataFrame:
    """The same as a left join of the two windows."""
    now = daily.filter(since("publish_date", as_of, window_days)).groupBy("keyword").agg(F.sum("mention_count").alias("count_now"))
    before = daily.filter(before_that("publish_date", as_of, window_days)).groupBy("keyword").agg(F.sum("mention_count").alias("p"))
    return _spikes(now.join(before, "keyword", "left").select("keyword", "count_now", F.coalesce("p", F.lit(0)).alias("count_prev")), min_now, limit)


def _spikes(counts: DataFrame, min_now: int, limit: int) -> DataFrame:
    grown = counts.filter(F.col("count_now") >= min_now).withColumn("multiplier", F.col("count_now") / F.greatest("count_prev", F.lit(1)))
    return grown.orderBy(F.col("multiplier").desc(), F.col("count_now").desc(), "keyword").limit(limit)


def hourly(events: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Counts by hour of the day, all 24 of them."""
    _checked(days=days)
    counts = events.filter(since("publish_date", as_of, days)).groupBy(F.col("publish_hour").cast("long").alias("hour")).agg(F.count("*").alias("n"))
    hours = events.sparkSession.range(24).withColumnRenamed("id", "hour")
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("count")).orderBy("hour")


def top_entities(daily: DataFrame, as_of, entity_type: str = "LOC", days: int = 7, limit: int = 20) -> DataFrame:
    _checked(limit, days)
    rows = daily.filter(since("publish_date", as_of, days) & (F.col("entity_type") == entity_type))
    return _top(rows.groupBy("entity_text").agg(F.sum("mention_count").alias("total")), "total", "entity_text", limit)


def timeline(rows: DataFrame, as_of, days: int = 30, category: str | None = None, day: str = "publish_date") -> DataFrame:
    _checked(days=days)
    chosen = rows.filter(since(day, as_of, days))
    chosen = chosen if category is None else chosen.filter(F.col("category") == category)
    return chosen.groupBy(F.col(day).alias("publish_date")).agg(F.count("*").alias("count")).orderBy("publish_date")


def cross_source(events: DataFrame, as_of, days: int = 7, min_sources: int = 3, limit: int = 20) -> DataFrame:
    """Keywords that several sources mention. Distinct sources are counted over sums by (keyword, source), so a hot
    keyword reaches the final task as a row for each source."""
    _checked(limit, days)
    by_source = events.filter(since("publish_date", as_of, days)).groupBy("keyword", "source").agg(F.count("*").alias("n"))
    counts = by_source.groupBy("keyword").agg(F.count("source").alias("source_count"), F.sum("n").alias("total_mentions"))
    return counts.filter(F.col("source_count") >= min_sources).orderBy(F.col("source_count").desc(), F.col("total_mentions").desc(), "keyword").limit(limit)


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), column)
