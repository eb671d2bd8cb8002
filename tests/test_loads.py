"""Loads, indexes and streams: what is written, refused and merged over several batches."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from heronlake.operators import cleaning, dedup, load, profile, reports, rollups, search, trends
from heronlake.plans import adapters as A
from heronlake.sources import html_article, tables
from heronlake.streaming import rollups as stream
from tests.compare import SMALL

DAY = datetime.date(2024, 1, 10)


def test_appended_loads_add_up_and_repeated_ids_are_refused(spark, tmp_path):
    rows, path = A.articles(spark, SMALL), f"{tmp_path}/load"
    load.load_articles(rows.filter("id % 2 = 0"), path, "append")
    load.load_articles(rows.filter("id % 2 = 1"), path, "append")
    before = {(r["table"], r["ym"]): r["n"] for r in load.loaded_counts(spark, path).collect()}
    daily = rollups.merge_rollups(spark.read.parquet(f"{path}/daily_keyword_stats"), keys=rollups.DAILY_KEYWORD)
    assert daily.agg(F.sum("mention_count")).first()[0] == spark.read.parquet(f"{path}/keyword_events").count()
    with pytest.raises(load.RepeatedKey):
        load.load_articles(rows.limit(3), path, "append")
    with pytest.raises(load.RepeatedKey):
        load.load_articles(rows.union(rows.limit(1)), path, "append")
    assert before == {(r["table"], r["ym"]): r["n"] for r in load.loaded_counts(spark, path).collect()}
    load.load_articles(rows.filter("id < 10"), path, "overwrite")
    assert spark.read.parquet(f"{path}/articles").count() == 10
    with pytest.raises(ValueError):
        load.load_articles(rows, path, "ignore")


def test_months_are_pruned(spark, tmp_path):
    load.load_articles(A.articles(spark, SMALL), f"{tmp_path}/load")
    rows = tables.in_months(spark.read.parquet(f"{tmp_path}/load/keyword_events"), datetime.date(2024, 1, 30), 7)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ym" in plan.split("PartitionFilters: [")[1].split("]")[0] and "publish_date" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_an_index_gives_the_scores_of_a_scan(spark, tmp_path):
    rows = dedup.near_dup_groups(A.articles(spark, SMALL), ["id"])
    for folded in (False, True):
        index = search.SearchIndex.write(rows, f"{tmp_path}/index{folded}", folded)
        for query in ("the idiot", "Thé", "nothingofthekind", "..."):
            scan = {r["id"]: round(r["score"], 9) for r in search.bm25(rows, query, folded).collect()}
            assert {r["id"]: round(r["score"], 9) for r in index.bm25(query).collect()} == scan
            held = {r["id"] for r in rows.filter(search.has_all_tokens(query, ["title", "content"], folded)).collect()}
            assert {r["id"] for r in index.all_tokens(query).collect()} == held
    plan = index.look_up("idiot")[1]._jdf.queryExecution().executedPlan().toString()
    assert "folder" in plan.split("PartitionFilters: [")[1].split("]")[0] and "token" in plan.split("PushedFilters: [")[1].split("]")[0]
    again = search.SearchIndex(spark, f"{tmp_path}/indexTrue")
    found = search.search(rows, "the idiot", "admin", 5, index=again).collect()
    scan = search.search(rows, "the idiot", "admin", 5, folded=True).collect()
    assert [(r["id"], round(r["score"], 9), r["highlight"]) for r in scan] == [(r["id"], round(r["score"], 9), r["highlight"]) for r in found]
    guest = [search.search(rows, "the idiot", size=7, folded=True, index=i, category="en").collect() for i in (None, again)]
    assert {r["id"] for r in guest[1]} <= {r["id"] for r in rows.filter("is_canonical and category = 'en'").collect()} and len(guest[0]) == len(guest[1])
    assert search.search(rows, "nothingofthekind", index=again).count() == 0
    assert len(found) == 5 and [r["score"] for r in found] == sorted((r["score"] for r in found), reverse=True) and "<mark>" in found[0]["highlight"]


def test_rare_tokens_first_gives_the_same(spark, tmp_path):
    rows = dedup.near_dup_groups(A.articles(spark, SMALL), ["id"])
    search.SearchIndex.write(rows, f"{tmp_path}/index", folders=2)
    indexes = [search.SearchIndex(spark, f"{tmp_path}/index", rare=rare) for rare in (1, 12, 60)]
    assert any(i._frequencies(["the", "idiot"], ["title", "content"]) for i in indexes)
    for query in ("the idiot clown", "the nothingofthekind worthless"):
        scores = {r["id"]: round(r["score"], 9) for r in indexes[0].bm25(query).collect()}
        held = {r["id"] for r in rows.filter(search.has_all_tokens(query, ["title", "content"])).collect()}
        for index in indexes:
            assert {r["id"] for r in index.all_tokens(query).collect()} == held
            for size in (2, 100):
                found = [(r["id"], round(r["score"], 9)) for r in index.top(query, size)[1]]
                assert [s for _, s in found] == sorted(scores.values(), reverse=True)[:size] and all(scores[i] == s for i, s in found)


def test_query_tokens_and_folders_are_those_of_the_analyzer(spark):
    index = object.__new__(search.SearchIndex)
    index.folders = 1000
    queries = ["The  IDIOT_1 the, don't", "Đường ĐƯỜNG 北京 \U0001f600a", "...", "a" * 100 + " \t\nB\x00c\x7f"]
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "i int, q string")
    for fold in (False, True, "words"):
        made = rows.select("i", F.array_distinct(search.tokens(F.col("q"), fold)).alias("t")).select("i", "t", F.array_sort(F.array_distinct(F.transform("t", lambda t: search._folder(t, 1000)))).alias("f"))
        for r in made.collect():
            assert search.query_tokens(spark, queries[r["i"]], fold) == r["t"] and index._folders(r["t"]) == r["f"]


def test_fetches_and_filters_stay_within_the_index(spark, tmp_path):
    rows = dedup.near_dup_groups(A.articles(spark, SMALL), ["id"])
    index = search.SearchIndex.write(rows, f"{tmp_path}/index", folders=4)
    for filters in ({}, {"category": "en"}, {"date_from": datetime.date(2024, 1, 1), "date_to": datetime.date(2024, 1, 2)}, {"source": rows.first()["source"]}):
        found = search.search(rows, "the idiot", size=100, index=index, **filters)
        scores = {r["id"]: r["score"] for r in index.bm25("the idiot").join(search.restrict(rows.filter("is_canonical"), **filters).select("id"), "id").collect()}
        best = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:100]
        made = {r["id"]: r for r in found.collect()}
        assert set(made) == set(best) and all(abs(made[i]["score"] - scores[i]) < 1e-9 for i in best)
        texts = {r["id"]: (r["title"], r["content"]) for r in rows.collect()}
        assert all((r["title"], r["content"]) == texts[i] for i, r in made.items()) and not {"url", "author", "__folder"} & set(found.columns)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__folder" in plan.split("PartitionFilters: [")[1].split("]")[0] and "id" in plan.split("PushedFilters: [")[1].split("]")[0] and "Join" not in plan
    # Without the carried columns, roles and filters come from the articles.
    bare = search.SearchIndex.write(rows.drop("is_canonical", "category"), f"{tmp_path}/bare", folders=2)
    assert bare.carried == ["source", "publish_date"]
    again = search.search(rows, "the idiot", size=100, index=bare, category="en")
    assert {r["id"] for r in again.collect()} == {r["id"] for r in search.search(rows, "the idiot", size=100, index=index, category="en").collect()}
    none = search.search(rows, "nothingofthekind", index=index)
    assert none.count() == 0 and none.columns == found.columns
    empty = search.SearchIndex.write(rows.limit(0), f"{tmp_path}/empty", folders=2)
    assert search.search(rows, "the", index=empty).count() == 0 and empty.all_tokens("the").count() == 0


def test_parameters_are_checked(spark):
    rows = A.articles(spark, SMALL)
    for wrong in (lambda: search.search(rows, " "), lambda: search.search(rows, "x", size=0), lambda: search.search(rows, "x", size=101), lambda: trends.top_keywords(rows, DAY, 0), lambda: trends.hot_keywords(rows, DAY, limit=0), lambda: trends.hourly(rows, DAY, 400)):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(ValueError):
        reports.write_report(spark.range(20), "/nowhere.json", most=10)


def test_streams_merge_over_batches(spark, tmp_path):
    events = A.keyword_events(spark, SMALL)
    for part in range(3):
        events.filter(F.col("article_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events")
    stream.maintain_rollup(source, rollups.DAILY_KEYWORD, f"{tmp_path}/rollup", f"{tmp_path}/state").awaitTermination()
    assert len(list((tmp_path / "rollup").glob("batch=*"))) == 3
    whole = sorted(map(tuple, rollups.rollup(events, rollups.DAILY_KEYWORD).collect()))
    for _ in range(2):
        assert sorted(map(tuple, stream.read_rollup(spark, f"{tmp_path}/rollup", rollups.DAILY_KEYWORD).collect())) == whole
    for place in (f"{tmp_path}/rollup", f"file://{tmp_path}/rollup/", f"{tmp_path}/rollup/more", f"{tmp_path}"):
        with pytest.raises(ValueError):
            stream.compact(spark, f"{tmp_path}/rollup", place, rollups.DAILY_KEYWORD)
    stream.compact(spark, f"{tmp_path}/rollup", f"{tmp_path}/compact", rollups.DAILY_KEYWORD)
    assert sorted(map(tuple, stream.read_rollup(spark, f"{tmp_path}/compact", rollups.DAILY_KEYWORD).collect())) == whole


def test_appending_keeps_the_first_row_of_a_key_over_batches(spark, tmp_path):
    schema = "key string, at int, data string"
    for part, rows in enumerate(([("a", 2, "x"), ("a", 1, "y"), (None, 0, "n")], [("a", 0, "z"), ("b", 5, "u")], [("b", 1, "v"), ("c", 9, "w")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_path}/in/{part}")
    (tmp_path / "flat").mkdir()
    for part in range(3):
        (file,) = (tmp_path / "in" / str(part)).glob("*.json")
        (tmp_path / "flat" / f"{part}.json").write_bytes(file.read_bytes())
        os.utime(tmp_path / "flat" / f"{part}.json", (1_700_000_000 + part, 1_700_000_000 + part))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(f"{tmp_path}/flat")
    stream.append_new(source, "key", ["at"], f"{tmp_path}/store", f"{tmp_path}/state", folders=4).awaitTermination()
    assert sorted((r["key"], r["data"]) for r in stream.read_appended(spark, f"{tmp_path}/store").collect()) == [("a", "y"), ("b", "u"), ("c", "w")]


def test_a_page_gets_the_first_time_that_can_be_read(spark):
    meta = '<meta property="article:published_time" content="{}"><meta name="pubdate" content="2024-01-02T10:00:00+07:00">'
    pages = [
        (1, "https://vnexpress.net/a", '<script type="application/ld+json">' + json.dumps({"@type": "NewsArticle", "datePublished": "2024-01-01T07:00:00+07:00"}) + "</script>"),
        (2, "https://vnexpress.net/b", meta.format("yesterday")), (3, "https://vnexpress.net/c", meta.format("2024-01-03T00:00:00Z")), (4, "https://vnexpress.net/d", "<p>x</p>"), (5, None, None),
    ]
    made = html_article.extract_articles(spark.createDataFrame(pages, "page_id long, url string, html string"))
    times = {r["page_id"]: r["published_at"] for r in made.collect()}
    assert times == {1: "2024-01-01T00:00:00+00:00", 2: "2024-01-02T03:00:00+00:00", 3: "2024-01-03T00:00:00+00:00", 4: None, 5: None}


def test_inputs_are_expanded_in_order_and_once(spark, tmp_path):
    for name in ("a.jsonl", "a_2024-02.jsonl", "a_2024-01.jsonl", "b.jsonl"):
        (tmp_path / name).write_text(json.dumps({"id": name}) + "\n")
    found = tables.expand_inputs(spark, [f"{tmp_path}/a*.jsonl", f"{tmp_path}/*.jsonl", f"{tmp_path}/none*"])
    assert [p.rpartition("/")[2] for p in found] == ["a.jsonl", "a_2024-01.jsonl", "a_2024-02.jsonl", "b.jsonl"]
    ordered = spark.createDataFrame([(p,) for p in found[:3][::-1]], "p string").orderBy(tables.partition_order(F.col("p")))
    assert [r["p"] for r in ordered.collect()] == [*found[1:3], found[0]]
    assert tables.read_jsonl(spark, found).count() == 4


def test_time_order_and_profiles(spark):
    rows = spark.createDataFrame([(1, "2024-02"), (2, None), (3, "2024-01"), (4, "2024-01")], "id int, published_at string")
    assert [r["id"] for r in cleaning.in_time_order(rows, ["id"]).collect()] == [2, 3, 4, 1]
    days = spark.createDataFrame([(DAY,), (DAY,), (None,), (DAY + datetime.timedelta(1),)], "publish_date date")
    assert [r["n"] for r in profile.most_active_dates(days).collect()] == [2, 1]
    values = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    assert [tuple(r) for r in profile.top_values(values, "v", 1).collect()] == [("b", 2)]


def test_near_duplicates_agree_with_the_windowed_variant(spark):
    rows = [(i, t, n, (n or 0) > 5) for i, (t, n) in enumerate([("A b", 3), ("a  B!", 9), ("á b", 9), ("", 1), (None, 1), ("c", None)])]
    frame = spark.createDataFrame(rows, "id int, title string, content_length int, has_full_content boolean")
    one, two = (sorted(map(tuple, f(frame, ["id"]).collect()), key=repr) for f in (dedup.near_dup_groups, dedup.near_dup_groups_windowed))
    assert one == two and sum(r[5] for r in one) == 3


def test_sizes_come_from_footers(spark, tmp_path):
    load.load_articles(A.articles(spark, SMALL), f"{tmp_path}/load")
    paths = {name: f"{tmp_path}/load/{name}" for name in ("articles", "keyword_events")}
    found = {(r["table"], r["column"]): r for r in reports.column_sizes(spark, paths).collect()}
    assert {c for t, c in found if t == "articles"} == set(spark.read.parquet(paths["articles"]).columns) - {"ym"}
    assert found["articles", "entities"]["n_rows"] == 200 and found["articles", "content"]["plain_size"] > 400_000
    totals = {r["table"]: r for r in reports.table_sizes(spark, paths).collect()}
    for name in paths:
        assert sum(r["packed_size"] for (t, _), r in found.items() if t == name) < totals[name]["disk_size"]
