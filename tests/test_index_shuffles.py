"""Postings are counted in their article's row; ordered files are ranges."""

import glob
from collections import Counter

from heronlake.operators import search
from heronlake.plans import queries


def test_postings_are_counted_without_a_shuffle(spark):
    texts = [(1, "A b a", "x"), (2, "", None), (3, "b B, b c_1", "a")]
    found = search.postings(spark.createDataFrame(texts, "id long, title string, content string"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = {(r["field"], r["token"], r["id"], r["tf"], r["len"]) for r in found.collect()}
    own = {("title", 1): ["a", "b", "a"], ("title", 3): ["b", "b", "b", "c_1"], ("content", 1): ["x"], ("content", 3): ["a"]}
    assert rows == {(f, t, i, n, len(ts)) for (f, i), ts in own.items() for t, n in Counter(ts).items()} and found.count() == len(rows)


def test_ordered_files_are_several(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_shared", lambda s, name: f"file://{tmp_path}/{name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = {r["title"]: r["id"] for r in queries.src4_file_order(spark, "/root/testdata/sf0.001").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(len(glob.glob(f"{tmp_path}/order/{rank}/part-*")) > 1 for rank in (0, 1))
    wanted: dict = {}
    for r in queries.A.articles(spark, "/root/testdata/sf0.001").filter("title <> ''").select("title", "id").collect():
        wanted[r["title"]] = max(wanted.get(r["title"], (-1, -1)), (r["id"] % 2, r["id"]))
    assert rows == {t: i for t, (_, i) in wanted.items()}
