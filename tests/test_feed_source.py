"""The feed source: both forms, times, broken files, partitions, the start date in the readers."""

import datetime
import gzip
import hashlib

from heronlake.plans.queries import QUERIES
from heronlake.sources import feed_source as S
from heronlake.sources.html_article import extract_articles
from tests.compare import SMALL

RSS = """<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>no item</title>
<item><title><![CDATA[A <b>]]> &amp; c</title><link> https://a.vn/1 </link><pubDate>Mon, 01 Jan 2024 20:00:00 +0700</pubDate><description>d</description><category>x</category><category>y</category><dc:creator>Le A</dc:creator></item>
<item><title>late</title><link>https://a.vn/2</link><pubDate>Mon, 01 Jan 2024 18:00:00 GMT</pubDate></item>
<item><title>unread</title><link>https://a.vn/3</link><pubDate>hôm qua 12</pubDate><updated>03.01.2024 08:30</updated></item>
<item><title>none</title><link>https://a.vn/4</link><pubDate>gestern 7</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>e</title><link rel="self" href="https://no"/><link href="https://a.vn/5"/><updated>2024-01-05T00:00:00Z</updated>
<summary>s</summary><author><name>B</name></author><category term="t"/></entry><entry><title>cut"""


def stored(tmp_path):
    (tmp_path / "feeds" / "sub").mkdir(parents=True)
    (tmp_path / "feeds" / "a.xml").write_text(RSS)
    with gzip.open(tmp_path / "feeds" / "sub" / "b.xml.gz", "wt") as f:
        f.write(ATOM)
    (tmp_path / "feeds" / "_SUCCESS").write_text("")
    (tmp_path / "feeds" / "empty.xml").write_text("")
    return str(tmp_path / "feeds")


def test_items_of_both_forms(spark, tmp_path):
    rows = {r["title"]: r for r in S.read_feeds(spark, stored(tmp_path)).collect()}
    assert sorted(rows) == ["A <b> & c", "e", "late", "none", "unread"]
    first, entry = rows["A <b> & c"], rows["e"]
    assert (first["link"], first["author"], first["category"], first["at"], first["day"]) == ("https://a.vn/1", "Le A", ["x", "y"], datetime.datetime(2024, 1, 1, 13), datetime.date(2024, 1, 1))
    assert (entry["link"], entry["author"], entry["category"], entry["description"]) == ("https://a.vn/5", "B", ["t"], "s")
    assert rows["late"]["day"] == datetime.date(2024, 1, 2) and rows["none"]["at"] is None
    assert rows["unread"]["at"] == datetime.datetime(2024, 1, 3, 1, 30)


def test_the_start_date_reaches_the_readers(spark, tmp_path):
    path = stored(tmp_path)
    found = S.read_feeds(spark, path, datetime.date(2024, 1, 2))
    assert sorted(r["title"] for r in found.collect()) == ["e", "late", "unread"]
    reader = S.FeedReader({"path": path})
    bound = S.GreaterThanOrEqual(("day",), datetime.date(2024, 1, 4))
    assert list(reader.pushFilters([bound])) == [bound] and reader.since == datetime.date(2024, 1, 4)
    assert [row[1] for part in reader.partitions() for row in reader.read(part)] == ["e"]


def test_partitions_follow_bytes(spark, tmp_path):
    path = stored(tmp_path)
    assert [len(p.paths) for p in S.FeedReader({"path": path}).partitions()] == [3]
    assert [len(p.paths) for p in S.FeedReader({"path": path, "partitionBytes": "1"}).partitions()] == [1, 1, 1]
    assert S.read_feeds(spark, f"{path}/a*.xml").count() == 4
    (tmp_path / "bare").mkdir()
    assert S.read_feeds(spark, str(tmp_path / "bare")).collect() == []


def test_unread_times_are_counted_by_form(spark, tmp_path):
    assert [tuple(r) for r in S.unread_times(S.read_feeds(spark, stored(tmp_path))).collect()] == [("a 0", 1)]


def test_times():
    utc = lambda *x: datetime.datetime(*x, tzinfo=datetime.timezone.utc)
    read = {
        "Wed, 03 Jan 2024 08:00:00 +0700": utc(2024, 1, 3, 1), "03 Jan 24 08:00 EST": utc(2024, 1, 3, 13), "2024-01-03": utc(2024, 1, 2, 17), "2024-01-03T08:00:00Z": utc(2024, 1, 3, 8),
        "03/01/2024 08:00": utc(2024, 1, 3, 1), "January 3, 2024": utc(2024, 1, 2, 17), " 3  Jan\n2024 08:00:00 GMT": utc(2024, 1, 3, 8), "": None, None: None, "31/02/2024": None, "0001-01-01T00:00:00": None,
    }
    assert {k: S.parse_time(k) for k in read} == read


def test_registered_feed_is_filled_from_pages(spark):
    """Every item has the longer title and the text of the page behind its link."""
    pages = {}
    for r in extract_articles(spark.read.parquet(f"{SMALL}/pages.parquet")).collect():
        pages.setdefault(r["url"].split("#")[0], []).append(r)
    rows = QUERIES["fn28_feed_with_pages"](spark, SMALL).collect()
    assert rows
    for r in rows:
        assert any(p["title"] == r["title"] and hashlib.md5(p["content"].encode()).hexdigest() == r["content"] and (p["category_raw"], len(p["content"])) == (r["category_raw"], r["content_length"]) for v in pages.values() for p in v)
