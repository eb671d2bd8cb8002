"""The trigram index beside a scan."""

import random

import pytest

from heronlake.operators import substring
from heronlake.operators.search import like

ROWS = [
    (1, "Straße ODOS", "ΟΔΟΣ ΟΔΟΣΑ οδος"), (2, "STRASSE", "İstanbul ıstanbul istanbul"), (3, None, "abcabc"), (4, "ab", None), (5, "", "100% sure_thing a\\b"), (6, None, None), (7, "ẞtrasse K", "kelvin K"),
    (8, "abc", "xabc"), (8, "abc", "xabc"), (9, "a\0b\0c", "line\nabc"), (10, "ﬁne", "the and of THE AND OF"),
]
QUERIES = ["abc", "ABC", "ΟΔΟΣ", "οδος", "οδοσ", "istan", "İstan", "strasse", "straße", "ß", "ab", "", "%", "_", "a%c", "abc%abc", "a_cabc", "0\\% s", "sure\\_th", "a\\\\b", "kelvin k", "zzz", "the%OF", "\nabc", "ẞtr", "ﬁne"]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ROWS, "id long, title string, content string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, articles, tmp_path_factory):
    return substring.TrigramIndex.write(articles, f"file://{tmp_path_factory.mktemp('grams')}/index", folders=5)


@pytest.mark.parametrize("ignore_case", [False, True])
def test_searches_equal_a_scan(articles, index, ignore_case):
    for q in QUERIES:
        expected = sorted(r["id"] for r in articles.filter(like(q, ["title", "content"], ignore_case)).collect())
        assert sorted(r["id"] for r in index.like(q, ignore_case).collect()) == expected, q


@pytest.mark.parametrize(("numbers", "blocks"), [(0, 256), (1, 256), (0, 1), (0, 0)])
def test_every_way_to_fetch_gives_the_same(articles, index, monkeypatch, numbers, blocks):
    monkeypatch.setattr(substring, "MAX_NUMBERS", numbers)
    monkeypatch.setattr(substring, "MAX_BLOCKS", blocks)
    test_searches_equal_a_scan(articles, index, True)


def test_articles_of_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK", 8)
    r = random.Random(3)
    rows = [(k, "".join(r.choice("abc ") for _ in range(6)), "".join(r.choice("abcd") for _ in range(r.choice([0, 3, 40])))) for k in range(200)]
    articles = spark.createDataFrame(rows, "id long, title string, content string")
    # Files that are cut give a block's trigrams several bitmaps.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    index = substring.TrigramIndex.write(articles.coalesce(1), f"file://{tmp_path}/index")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for q in ("abc", "dddd", "a%bcd", "cab_a"):
        assert sorted(x["id"] for x in index.like(q).collect()) == sorted(x["id"] for x in articles.filter(like(q, ["title", "content"])).collect())


def test_a_search_reads_its_folders_and_numbers_only(index):
    found = index.candidates(index.grams_in("kelvin"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in found.replace("isnotnull(folder", "[folder") and "In(gram" in found
    fetched = index.like("kelvin")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in fetched and "n," in fetched.split("PushedFilters: [")[1].split("]")[0] + ","


def test_an_empty_index(spark, tmp_path):
    index = substring.TrigramIndex.write(spark.createDataFrame([], "id long, title string, content string"), f"file://{tmp_path}/index")
    assert index.like("abc").collect() == [] and index.like("a").collect() == []


def test_literals():
    assert substring.literals(r"a%b_cd\%e\\f%") == ["a", "b", r"cd%e\f"]


def test_a_frequent_trigram_takes_no_more_than_a_bitmap():
    places = substring.Places()
    for k in range(0, substring.BLOCK, 2):
        places.few["abc"].append(k)
        if k % 1000 == 0:
            places.few["rar"].append(k)
        if k % 1024 == 0:
            places.fold()
            assert all(len(x) <= substring.BLOCK // 16 for x in places.few.values())
    assert set(places.grams()) == {"abc", "rar"} and len(places.grams()) == 2 and "abc" in places.many and "rar" not in places.many
    assert places.taken("abc") == b"\x55" * (substring.BLOCK // 8)
    assert sum(b.bit_count() for b in places.taken("rar")) == len(range(0, substring.BLOCK, 1000)) and places.grams() == []
