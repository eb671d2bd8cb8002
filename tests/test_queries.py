import hashlib
import html
import re

import pytest

from heronlake.plans.oracle import SQL
from heronlake.plans.queries import QUERIES
from heronlake.sources.html_article import extract
from tests.compare import SMALL, connect, sides


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    ours, theirs = sides(QUERIES[name](spark, SMALL), con, SQL[name])
    assert ours == theirs


def test_extracted_articles_equal_the_parser_of_one_page(spark):
    found = {r["page_id"]: r for r in QUERIES["fn26_extract_articles"](spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        one, row = extract(page["html"], page["url"]), found[page["page_id"]]
        content = spark_free_clean(one.get("content", ""))
        assert (row["title"], row["author"], row["keywords"], row["content_from"]) == (one.get("title"), one.get("author"), "|".join(one.get("keywords", [])), one.get("content_from"))
        assert (row["content"], row["content_length"]) == (hashlib.md5(content.encode()).hexdigest(), len(content))


def spark_free_clean(text: str) -> str:
    """What cleaning leaves of texts without boilerplate."""
    return " ".join(html.unescape(html.unescape(text)).split())


def test_recognised_entities_equal_a_plain_search(spark):
    """Every listed name that a text holds as words, in the order of title and content, each once."""
    names = {"The": "PER", "der": "LOC", "la": "LOC", "de la": "ORG"}
    done = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    found = {r["id"]: r["entities"] for r in QUERIES["ner_recognise"](spark, SMALL).collect()}
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r["doc_id"] not in done]
    assert len(found) == len(docs)
    for doc in docs:
        expected: dict = {}
        for text in (doc["text"].split("\n")[0], doc["text"]):
            words = [w.strip(".,;:!?()\"'") for w in text.split()]
            skip = -1
            for i, w in enumerate(words):
                if i == skip:
                    continue
                pair = " ".join(words[i : i + 2])
                name = pair if pair in names else w if w in names else None
                if name:
                    skip = i + 1 if name == pair else skip
                    expected.setdefault((name.lower(), names[name]), f"{name}/{names[name]}")
        assert found[doc["doc_id"]] == "|".join(expected.values()), doc["doc_id"]


def test_highlights_mark_the_words_of_the_query(spark):
    rows = QUERIES["sch4_highlight"](spark, SMALL).collect()
    assert rows
    for r in rows:
        marked = re.findall("<mark>(.*?)</mark>", r["highlight"])
        assert marked and {m.lower() for m in marked} <= {"idiot", "clown"} and len(re.sub("</?mark>", "", r["highlight"])) <= 150


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["keyword", "count_now", "count_prev", "multiplier"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_window_filters_reach_the_scan(spark):
    plan = QUERIES["agg12_orders_timeline"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" in plan.split("PushedFilters")[1]
