"""Median seconds of the headline queries, as one line of JSON.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Tables that a service would hold ready (articles with their groups,
their search index, event tables, rollups) are written once before, as the compared engines load theirs before they are timed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from heronlake.operators import dedup, rollups, search, substring, trends
from heronlake.plans import adapters as A
from heronlake.sources.tables import in_months, write_monthly

RUNS, WARM_UP = 5, 2


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="heronlake-bench-")

    def stored(frame, name: str):
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    began = time.perf_counter()
    events = stored(A.keyword_events(spark, sf_dir).sortWithinPartitions("publish_date", "keyword"), "keyword_events")
    entities = stored(A.entity_events(spark, sf_dir), "entity_events")
    daily = stored(rollups.rollup(events, rollups.DAILY_KEYWORD), "daily_keyword")
    daily_entity = stored(rollups.rollup(entities, rollups.DAILY_ENTITY), "daily_entity")
    articles = stored(dedup.near_dup_groups(A.articles(spark, sf_dir), ["id"]), "articles")
    before = time.perf_counter()
    index = search.SearchIndex.write(articles, f"{folder}/index")
    indexing = time.perf_counter() - before
    grams = substring.TrigramIndex.write(articles, f"{folder}/grams")
    write_monthly(events, f"{folder}/monthly", sort=["publish_date", "keyword"])
    monthly = spark.read.parquet(f"{folder}/monthly")
    load = time.perf_counter() - began
    day = trends.last_day(events)
    raw_daily = trends.as_daily(events)

    queries = {
        "top_keywords_7d_rollup": lambda: trends.top_keywords(daily, day, 7),
        "top_keywords_7d_raw": lambda: trends.top_keywords(raw_daily, day, 7),
        "top_keywords_30d_rollup": lambda: trends.top_keywords(daily, day, 30),
        "top_keywords_30d_raw": lambda: trends.top_keywords(raw_daily, day, 30),
        "hot_spike_7d_rollup": lambda: trends.hot_keywords(daily, day, 7),
        "hot_spike_7d_raw": lambda: trends.hot_keywords(raw_daily, day, 7),
        "cross_source_30d": lambda: trends.cross_source(events, day, 30),
        "hourly_30d": lambda: trends.hourly(events, day, 30),
        "timeline_30d": lambda: trends.timeline(events, day, 30),
        "top_entities_7d": lambda: trends.top_entities(daily_entity, day, "click", 7),
        "top_keywords_7d_monthly": lambda: trends.top_keywords(trends.as_daily(in_months(monthly, day, 7)), day, 7),
        "all_tokens_count": lambda: index.all_tokens("the idiot").groupBy().count(),
        "all_tokens_count_scan": lambda: articles.filter(search.has_all_tokens("the idiot", ["title", "content"])).groupBy().count(),
        "like_count": lambda: articles.filter(search.like("the and", ["title", "content"])).groupBy().count(),
        "ilike_count": lambda: articles.filter(search.like("the and", ["title", "content"], ignore_case=True)).groupBy().count(),
        "like_rare_scan": lambda: articles.filter(search.like("worthless idiot", ["title", "content"])).groupBy().count(),
        "ilike_rare_scan": lambda: articles.filter(search.like("Worthless Idiot", ["title", "content"], ignore_case=True)).groupBy().count(),
        "like_rare_indexed": lambda: grams.like("worthless idiot").groupBy().count(),
        "ilike_rare_indexed": lambda: grams.like("Worthless Idiot", ignore_case=True).groupBy().count(),
        "entity_count": lambda: articles.filter(search.has_entity("The", "PER")).groupBy().count(),
        "bm25_top": lambda: search.search(articles, "idiot clown", index=index),
        "bm25_top_scan": lambda: search.search(articles, "idiot clown"),
        "hourly_rollup": lambda: rollups.rollup(events, rollups.HOURLY).groupBy().count(),
        "near_dup_groups": lambda: dedup.group_stats(dedup.near_dup_groups(A.articles(spark, sf_dir), ["id"])),
    }
    seconds = {}
    for name, build in queries.items():
        times = []
        for _ in range(WARM_UP + RUNS):
            t = time.perf_counter()
            build().collect()
            times.append(time.perf_counter() - t)
        seconds[name] = round(statistics.median(times[WARM_UP:]), 4)
    spark.stop()
    # The two searches by scans instead of the index, as in round 1.
    by_scans = round(sum(v for k, v in seconds.items() if not k.endswith(("_monthly", "_indexed")) and k not in ("all_tokens_count", "bm25_top") and "rare" not in k), 3)
    print(json.dumps({"metric": "sum of median seconds of the headline queries", "value": round(sum(v for k, v in seconds.items() if not k.endswith(("_scan", "_monthly", "_indexed"))), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1], "load_seconds": round(load, 2), "index_seconds": round(indexing, 2), "value_by_scans": by_scans}))


if __name__ == "__main__":
    main()
