import datetime
import json

import pytest
from pyspark.sql import functions as F

from heronlake.operators import access, cleaning, dedup, profile, reports, rollups, search, trends
from heronlake.sources import html_article, legacy_csv, rss, tables

DAY = datetime.date(2024, 1, 30)


def near(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, content_length int, has_full_content boolean")


def test_near_dup_prefers_full_then_long_then_first(spark):
    rows = near(spark, [(1, "A b!", 900, True), (2, "a B", 900, True), (3, "Á b", 2000, False), (4, "c", 10, False)])
    for grouped in (dedup.near_dup_groups(rows, ["id"]), dedup.near_dup_groups_windowed(rows, ["id"])):
        found = {r["id"]: (r["is_canonical"], r["dup_count"], r["dup_group_id"] != "") for r in grouped.collect()}
        assert found == {1: (True, 3, True), 2: (False, 3, True), 3: (False, 3, True), 4: (True, 1, False)}
    assert tuple(dedup.group_stats(grouped).first()) == (1, 2)


def test_short_rows_count_in_their_group(spark):
    rows = spark.createDataFrame(
        [("1", "T", "x" * 150, 150, False), ("2", "t", "y" * 300, 300, False)], "id string, title string, content string, content_length int, has_full_content boolean"
    ).withColumns({"category_raw": F.lit("the-thao"), "author": F.lit("ZNews"), "source": F.lit("s"), "published_at": F.lit("2024-01-01T00:00:00+00:00")})
    (kept,) = cleaning.cleanup(rows, ["id"]).collect()
    assert (kept["id"], kept["dup_count"], kept["category_normalized"], kept["author"], kept["publish_hour"]) == ("2", 2, "sports", "", 7)


@pytest.mark.parametrize("first, second, winner, keywords", [("aaaaa", "bbbbb", "aaaaa", ["a", "b", "c"]), ("aaaaa", "bbbbbbbbb", "bbbbbbbbb", ["b", "c", "a"])])
def test_merge_fold(spark, first, second, winner, keywords):
    rows = spark.createDataFrame([("k", 0, first, ["a", "b"]), ("k", 1, second, ["b", "c"])], "id string, o int, content string, keywords array<string>")
    (row,) = dedup.merge_fold(rows, "id", ["o"]).collect()
    assert (row["content"], row["keywords"], row["content_length"], row["has_full_content"]) == (winner, keywords, len(winner), False)


def test_first_wins_drops_rows_without_key_and_append_is_idempotent(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("", 0), (None, 0), ("b", 5)], "id string, o int")
    once = dedup.first_wins(rows, "id", ["o"])
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 5)]
    assert dedup.append_if_absent(once, rows, "id", ["o"]).count() == 0


def test_reasons(spark):
    rows = spark.createDataFrame([("", "x", "d"), ("t", "x", ""), ("t", "x", "d"), ("t", "x" * 100, "d")], "t string, c string, p string")
    reasons = [r[0] for r in rows.select(cleaning.reject_reason(F.col("t"), F.col("c"), F.col("p"))).collect()]
    assert reasons == ["empty_title", "no_published_at", "content_too_short(1)", None]


def test_percentiles_take_upper_ranks(spark):
    rows = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "content_length int")
    row = profile.length_profile(rows).first()
    assert (row["p50"], row["p95"], row["mean"]) == (3, 4, 2.5)


def test_latency_summary_interpolates(spark):
    rows = spark.createDataFrame([("s", i, float(i - 2)) for i in range(20)], "scenario string, run int, ms double")
    assert reports.latency_summary(rows, ["scenario"]).first()["p95_ms"] == pytest.approx(16.2)


def test_hours_are_filled(spark):
    rows = spark.createDataFrame([(DAY, 3), (DAY, 20), (DAY, 20)], "publish_date date, publish_hour int")
    found = {r["hour"]: r["count"] for r in trends.hourly(rows, DAY).collect()}
    assert len(found) == 24 and found[3] == 1 and found[20] == 2 and sum(found.values()) == 3


def test_windows_hold_one_day_more_than_the_one_before(spark):
    days = [(DAY - datetime.timedelta(n), "k", "c", 1) for n in range(16)]
    daily = spark.createDataFrame(days, "publish_date date, keyword string, category string, mention_count long")
    for hot in (trends.hot_keywords(daily, DAY), trends.hot_keywords_joined(daily, DAY)):
        assert tuple(hot.first()) == ("k", 8, 7, pytest.approx(8 / 7))


def articles(spark):
    entity = [{"text": "Iran", "type": "LOC"}]
    rows = [
        ("1", "Giá vàng tăng", "giá vàng hôm nay", "a", "news", DAY, True, entity), ("2", "Bóng đá", "giá trị bóng đá", "a", "sports", DAY, True, []),
        ("3", "Giá vàng tăng!", "giá vàng", "b", "news", DAY, False, entity),
    ]
    frame = spark.createDataFrame(rows, "id string, title string, content string, source string, category string, publish_date date, is_canonical boolean, entities array<struct<text:string,type:string>>")
    return frame.withColumns({"author": F.lit("x"), "crawled_at": F.lit(""), "url": F.lit("u")})


def test_roles_and_search(spark):
    rows = articles(spark)
    assert not {"author", "crawled_at", "url"} & set(access.visible(rows).columns)
    assert access.visible(rows).count() == 2 and access.visible(rows, "admin").count() == 3
    assert [r["id"] for r in search.search(rows, "giá vàng").collect()] == ["1", "2"]
    assert search.search(rows, "giá vàng", category="sports").first()["id"] == "2"
    assert "<mark>giá</mark> <mark>vàng</mark>" in search.search(rows, "giá vàng").first()["highlight"]
    assert rows.filter(search.has_all_tokens("gia vang", ["title", "content"], folded=True)).count() == 2
    assert rows.filter(search.has_all_tokens("gia vang", ["title", "content"])).count() == 0
    assert search.search_by_entity(rows, "Iran", "LOC").count() == 1 and search.search_by_entity(rows, "Iran", "PER").count() == 0
    assert search.article(rows, "3").count() == 0 and search.article(rows, "3", "admin").count() == 1
    access.publish_view(rows)
    assert spark.table("news_public").count() == 2
    assert search.search(rows, "...").count() == 0
    with pytest.raises(ValueError):
        access.visible(rows, "root")


def test_events_skip_blanks(spark):
    rows = spark.createDataFrame([("1", [" a ", "", " "], [("x", "LOC"), ("", "PER")], None)], "id string, keywords array<string>, entities array<struct<text:string,type:string>>, publish_hour int")
    rows = rows.withColumns({c: F.lit("v") for c in ("event_time", "publish_date", "source", "category")})
    assert [(r["keyword"], r["publish_hour"]) for r in rollups.keyword_events(rows).collect()] == [("a", 0)]
    assert [r["entity_text"] for r in rollups.entity_events(rows).collect()] == ["x"]


def test_recognition_is_incremental_and_survives_a_failing_tagger(spark):
    rows = spark.createDataFrame([("1", "Hà Nội mưa", "ở Hà Nội."), ("2", "t", "c")], "id string, title string, content string")
    tagger = cleaning.gazetteer_tagger({"Hà Nội": "LOC"})
    done = spark.createDataFrame([("2",)], "id string")
    (row,) = cleaning.recognise_entities(rows, tagger, done).collect()
    assert [tuple(e) for e in row["entities"]] == [("Hà Nội", "LOC")]
    assert all(r["entities"] == [] for r in cleaning.recognise_entities(rows, lambda t: 1 / 0).collect())


def test_jsonl_skips_broken_lines_and_keeps_order(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join([json.dumps({"id": "1", "title": "t", "more": 1}), "{broken", "", json.dumps({"id": "2"})]))
    rows = tables.read_jsonl(spark, str(path))
    assert [r["id"] for r in tables.with_sequence(rows).orderBy("_seq").collect()] == ["1", "2"]
    assert tables.count_broken(spark, str(path)) == 1
    tables.write_jsonl(rows, str(tmp_path / "out"), gzip=True)
    assert tables.read_jsonl(spark, str(tmp_path / "out")).count() == 2


def test_months_are_pruned(spark, tmp_path):
    rows = spark.createDataFrame([(DAY, "a"), (datetime.date(2023, 5, 1), "b"), (None, "c")], "publish_date date, k string")
    tables.write_monthly(rows, str(tmp_path / "m"), sort=["k"])
    chosen = tables.in_months(spark.read.parquet(str(tmp_path / "m")), DAY, 7)
    assert [r["k"] for r in chosen.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(ym" in chosen._jdf.queryExecution().toString()


def test_csv_rows_become_articles(spark, tmp_path):
    path = tmp_path / "a.csv"
    body = "câu " * 100
    path.write_text(
        "url,title,published_at,content.text,source.name,keywords,category.primary,language\n"
        f'https://vnexpress.net/the-gioi/x.html#k,"T ""q""",2024-01-01 07:00:00,"{body}",Nguyễn Văn An,a|b,trang-chu,\n'
        "https://vnexpress.net/y,short,2024-01-01,few,24h,,,\n,none,2024-01-01,x,,,,\n"
    )
    name, kind = legacy_csv.parse_spec(f"{path}:html")
    (row,) = legacy_csv.articles_from_csv(legacy_csv.read_csv(spark, name), kind).collect()
    assert (row["url"], row["title"], row["published_at"]) == ("https://vnexpress.net/the-gioi/x.html", 'T "q"', "2024-01-01T00:00:00+00:00")
    assert (row["author"], row["keywords"], row["category_normalized"], row["language"], row["source"]) == ("Nguyễn Văn An", ["a", "b"], "world", "vi", "vnexpress")
    with pytest.raises(ValueError):
        legacy_csv.parse_spec("x:pdf")


def test_feed_items_become_articles(spark, tmp_path):
    path = tmp_path / "f.xml"
    text = "word " * 40
    path.write_text(
        f"<rss><channel><item><title>One</title><link>https://znews.vn/the-thao/a</link><description>&lt;p&gt;{text}&lt;/p&gt;</description>"
        "<pubDate>Mon, 01 Jan 2024 07:00:00 +0700</pubDate><category>k1</category><category>k1</category></item>"
        "<item><title>No date</title><link>https://znews.vn/b</link></item></channel></rss>"
    )
    (row,) = rss.articles_from_feed(rss.read_feed(spark, str(path))).collect()
    assert (row["source"], row["published_at"], row["keywords"], row["category_normalized"]) == ("znews", "2024-01-01T00:00:00+00:00", ["k1"], "sports")
    assert rss.articles_from_feed(rss.read_feed(spark, str(path)), start_date=datetime.date(2025, 1, 1)).count() == 0


def test_jsonld_goes_before_meta():
    html = """<html><head><title>t</title><meta content="M" property="og:title"><meta name="keywords" content="a, b">
    <script type="application/ld+json">[{"@type": "Organization", "headline": "no"}, {"@type": ["NewsArticle"], "headline": "H", "author": [{"name": "An"}], "articleBody": "Body",},
    {"@type": "Article", "headline": "later", "articleSection": ["S"]}]</script></head><body></body></html>"""
    found = html_article.extract(html, "https://x.vn/a")
    assert (found["title"], found["author"], found["category_raw"], found["content"], found["keywords"]) == ("H", "An", "S", "Body", ["a", "b"])


def test_body_selectors_skip_noise():
    html = '<div class="detail-content"><p>First long paragraph<p>short<div class="ads"><p>advertisement text</p></div><p><b>Second</b> long paragraph</p></div>'
    assert html_article.extract(html, "https://tuoitre.vn/a")["content"] == "First long paragraph Second long paragraph"
    assert html_article.extract(None, None) == {}


def test_reports_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.5)], "engine string, ms double")
    for kind in ("json", "csv", "md"):
        reports.write_report(rows, str(tmp_path / f"r.{kind}"))
        assert "engine" in (tmp_path / f"r.{kind}").read_text()
    assert reports.human_bytes(1536) == "1.50 KB"
    summary = spark.createDataFrame([("fts", "s", 10), ("fts", "s", 20), ("aggregation", "t", 1), ("aggregation", "t", 9)], "category string, scenario string, result_count int")
    assert [r["scenario"] for r in reports.count_mismatches(summary).collect()] == ["s"]
    spark.range(5).write.parquet(str(tmp_path / "p"))
    assert reports.table_sizes(spark, {"p": str(tmp_path / "p")}).first()["disk_size"] > 0


def test_time_order_is_the_order_of_the_rows(spark):
    from heronlake.plans.queries import QUERIES
    from tests.compare import SMALL

    rows = [(r["published_at"] or "", r["id"]) for r in QUERIES["win2_time_order"](spark, SMALL).collect()]
    assert rows == sorted(rows) and len(rows) > 100
