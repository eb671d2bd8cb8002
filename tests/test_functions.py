import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heronlake.functions import categories as C
from heronlake.functions import entities as E
from heronlake.functions import text as X
from heronlake.functions import times as TM
from heronlake.functions import urls as U


def one(spark, build, *values):
    """The result of a column function for literal strings."""
    row = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(build(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "url, expected",
    [("https://a.vn/x/#f", "https://a.vn/x"), ("https://a.vn/x/?q=1", "https://a.vn/x/?q="), ("https://a.vn/", "https://a.vn/"), (" https://a.vn/y ", "https://a.vn/y"), ("", ""), (None, "")],
)
def test_normalize_url(spark, url, expected):
    assert one(spark, U.normalize_url, url) == expected


@pytest.mark.parametrize("name, expected", [("thitruong.nld.com.vn", "nld"), ("www.vnexpress.net", "vnexpress"), ("mynld.com.vn", "nld"), ("other.org", "other.org")])
def test_source_of(spark, name, expected):
    assert one(spark, U.source_of, name) == expected


def test_pages_of_a_category(spark):
    def page(n, template):
        return lambda u: U.page_url(u, F.lit(n), template)

    assert one(spark, page(1, "{base}-p{page}.html"), "https://x.vn/a.html") == "https://x.vn/a.html"
    assert one(spark, page(3, "{base}/trang{page}.html"), "https://x.vn/a.html") == "https://x.vn/a/trang3.html"
    assert one(spark, page(2, "{base}?page={page}"), "https://x.vn/a/") == "https://x.vn/a?page=2"


def test_links_of_a_page(spark):
    html = '<a href="/b-1.ldo?utm=1">x</a> <a class=k href="https://other.vn/c-2.ldo">y</a><a href="b-1.ldo">z</a><a href="">e</a>'
    links = one(spark, lambda h, u: U.article_links(h, u, r"-\d+\.ldo$"), html, "https://laodong.vn/thoi-su/")
    assert sorted(links) == ["https://laodong.vn/b-1.ldo", "https://laodong.vn/thoi-su/b-1.ldo"]


@pytest.mark.parametrize("raw, expected", [("The-Thao", "sports"), ("", "other"), (None, "other"), ("tin bong-da quoc te", "sports"), ("zzz", "other"), ("kinh-te", "business")])
def test_category(spark, raw, expected):
    assert one(spark, C.lookup_expression, raw) == expected


def test_category_of_url(spark):
    assert one(spark, U.category_of_url, "https://x.vn/abc-9/the-gioi-209/z.html") == "the-gioi"
    assert one(spark, U.category_of_url, "https://x.vn/qqq/www/z") == "qqq"
    assert one(spark, U.category_of_url, "https://x.vn") == ""


@pytest.mark.parametrize("raw, expected", [("Giá vàng: TĂNG!", "gia vang tang"), ("Đặng", "dang"), ("  a  b ", "a b"), ("", ""), (None, "")])
def test_title_key(spark, raw, expected):
    assert one(spark, X.title_key, raw) == expected


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="aAđĐáÁềỆữ ơƯ.!?_9-", max_size=30))
def test_title_key_agrees_with_decomposition(spark, title):
    t = "".join(c for c in unicodedata.normalize("NFKD", title.strip().lower()) if not unicodedata.combining(c)).replace("đ", "d")
    expected = " ".join("".join(c if c.isalnum() or c in "_ " else " " for c in t).split())
    assert one(spark, X.title_key, title) == expected


def test_clean_content(spark):
    assert one(spark, X.clean_content, "TTO - A &amp;amp; B &nbsp; c\n\n d") == "A & B c d"
    assert one(spark, X.clean_content, "(Dân trí) - x. Nguồn: [Link nguồn] y\nz") == "x."
    assert one(spark, X.clean_content, None) == ""


def test_folding_finds_at_least_as_much(spark):
    assert one(spark, lambda a, b: X.tokens(a, True) == X.tokens(b, True), "giá", "giả")
    assert not one(spark, lambda a, b: X.tokens(a) == X.tokens(b), "giá", "giả")


def test_local_time(spark):
    row = spark.sql("SELECT timestamp'2026-02-03T18:45:00+00:00' AS t").select(*TM.time_fields(F.col("t")), TM.bucket_label(F.col("t"))).first()
    assert (str(row[0]), row[1], row[2], row[3]) == ("2026-02-04", 1, 2, "2026-02-03T16")
    first = spark.sql("SELECT timestamp'2026-02-03T13:45:00+00:00' AS t").select(*TM.time_fields(F.col("t"))).first()
    assert (str(first[0]), first[1], first[2]) == ("2026-02-03", 20, 1)


@pytest.mark.parametrize(
    "raw, epoch",
    [("2024-01-01T07:00:00", 1704067200), ("2024-01-01T00:00:00Z", 1704067200), ("Mon, 01 Jan 2024 07:00:00 +0700", 1704067200), ("Mon, 01 Jan 2024 00:00:00 GMT", 1704067200), ("junk", None), ("", None), (None, None)],
)
def test_parse_times(spark, raw, epoch):
    assert one(spark, lambda x: F.unix_timestamp(TM.to_utc(x)), raw) == epoch


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("xã Sơn Cẩm", "PER", ("Sơn Cẩm", "LOC")), ("ông Trump", "LOC", ("Trump", "PER")), ("khu vực Bắc Bộ", "ORG", ("vực Bắc Bộ", "LOC")), ("Lâm Đồng", "LOC", None), ("năm 2026", "ORG", None),
        ("113 999", "ORG", None), ("9,2 %", "ORG", None), ("(Hà Nội),", "LOC", ("Hà Nội", "LOC")), ("a", "PER", None), ("", "PER", None), ("bà", "PER", None), ("x" * 51, "PER", None),
    ],
)
def test_clean_entity(spark, text, kind, expected):
    found = one(spark, lambda t, k: E.clean_entity(F.struct(t.alias("text"), k.alias("type"))), text, kind)
    assert (tuple(found) if found else None) == expected


def test_keywords(spark):
    assert one(spark, lambda k: E.clean_keywords(F.split(k, ";")), "Thế giới;Giá vàng;giá vàng; vàng ;2024") == ["Giá vàng", "vàng"]
    assert one(spark, E.split_keywords, "a|b, c| ") == ["a", "b, c"]
    assert one(spark, E.split_keywords, "a, b,,c") == ["a", "b", "c"]
    assert one(spark, lambda a, b: E.union_keywords(F.split(a, ","), F.split(b, ",")), "a,b", "b,c") == ["a", "b", "c"]


@pytest.mark.parametrize("name, expected", [("Nguyễn Văn An", True), ("VnExpress", False), ("An", False), ("nguyễn An", False), ("An 24h", False), ("", False), (None, False)])
def test_person_name(spark, name, expected):
    assert one(spark, E.is_person_name, name) is expected


def test_author(spark):
    assert one(spark, E.fix_author, "VnExpress", "vnexpress") == ""
    assert one(spark, E.fix_author, " An ", "x") == "An"


def test_bio_tags_merge(spark):
    tags = [("Hồ", "B-PER"), ("Minh", "I-PER"), ("đi", "O"), ("Hà", "I-LOC"), ("Nội", "B-LOC"), ("x", "I-ORG"), ("y", "I-ORG")]
    rows = spark.createDataFrame([(tags,), ([],)], "tags array<struct<token:string,tag:string>>")
    found = [[tuple(e) for e in r[0]] for r in rows.select(E.merge_bio(F.col("tags"))).collect()]
    assert found == [[("Hồ Minh", "PER"), ("Hà", "LOC"), ("Nội", "LOC"), ("x y", "ORG")], []]


def test_rows_of_one_category_stay_in_their_tasks(spark):
    """A join by the raw value would deal all of them to one task, and need their source twice."""
    rows = spark.range(0, 400, 1, 4).select("id", F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 == 1, "zzz").otherwise("The-Thao").alias("raw"), F.lit("old").alias("label"))
    made = C.with_category(rows, "raw", "label")
    assert made.columns == ["id", "raw", "label"] and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert {(r["part"], r["label"]): r["n"] for r in made.groupBy(F.spark_partition_id().alias("part"), "label").agg(F.count("*").alias("n")).collect()} == {(k, v): n for k in range(4) for v, n in (("other", 4), ("sports", 96))}
