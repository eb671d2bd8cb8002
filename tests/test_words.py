"""Word segmentation and full folding beside the Unicode word boundaries of the regex library."""

import hashlib
import unicodedata

import pytest
import regex
from pyspark.sql import functions as F

from heronlake.functions import text as X
from heronlake.operators import search
from heronlake.plans.queries import PLANTED_WORDS, QUERIES
from tests.compare import SMALL

BOUNDARY = regex.compile(r"(?V1w)\b")


def words(text):
    return [X.folded_word(w) for w in BOUNDARY.split(text or "") if regex.search(r"[\p{L}\p{N}]", w)]


LINES = [
    None, "", " \n ", "don't U.S.A. 1,000.5 a_b x:y rock·n·roll it’s _a 3a.4 1'2 a,b e\u0301a E\u0301", "我们喜欢北京。大家好 ひらがなカタカナー漢字", "Việt Nam, ở Hà-Nội. ĐƯỜNG",
    "ﬁne ｆｕｌｌ Straße Øre Łódź ΣΊΣΥΦΟΣ", "한국어 אב\"ג שלום العربية", "a..b 1..2 a.1 1.a '' ’ _ __ ' a' 'b", "Ⅳ ½ ① x²",
]


def test_words_are_those_of_unicode(spark):
    rows = spark.createDataFrame(list(enumerate(LINES)), "i int, t string")
    found = {r["i"]: r["w"] for r in rows.select("i", X.word_tokens(F.col("t")).alias("w")).collect()}
    assert {i: LINES[i] for i in found if found[i] != words(LINES[i])} == {}


def test_thai_is_cut_by_a_dictionary(spark):
    rows = spark.createDataFrame([("ผมชอบกินข้าว Đà ok",)], "t string")
    assert rows.select(X.word_tokens(F.col("t")).alias("w")).first()["w"] == ["ผม", "ชอบ", "กิน", *[unicodedata.normalize("NFC", "ข้าว")], "da", "ok"]


def test_both_ways_of_folding_agree(spark):
    letters = X._FROM + X._FROM.upper() + "".join(map(chr, range(32, 127)))
    rows = spark.createDataFrame([(c,) for c in letters], "t string")
    assert [r for r in rows.select("t", X.fold_fully(F.col("t")).alias("f")).collect() if X.folded_word(r["t"]) != r["f"]] == []


def test_registered_words_of_whole_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["tok1_words"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for r in found:
        own = words(PLANTED_WORDS[r["doc_id"] % len(PLANTED_WORDS)] + "\n" + (texts[r["doc_id"]] or ""))
        assert (r["n_words"], r["words"]) == (len(own), hashlib.md5("|".join(own).encode()).hexdigest())


@pytest.mark.parametrize("query, ids", [("fine", [1]), ("北京", [2, 3]), ("don't", [1]), ("กิน", [4]), ("...", [])])
def test_searches_by_words(spark, tmp_path, query, ids):
    rows = spark.createDataFrame([(1, "ﬁne", "Don't", True), (2, "x", "我们喜欢北京。", True), (3, "京", "北方", True), (4, "t", "ผมชอบกินข้าว", True)], "id long, title string, content string, is_canonical boolean")
    if query == "fine":
        index = search.SearchIndex.write(rows, f"{tmp_path}/index", "words", folders=2)
        for q, i in (("Fine", 1), ("DON’T don't", 1), ("กิน", 4)):
            assert [r["id"] for r in search.search(rows, q, index=index).collect()] == [i]
        assert search.search(rows, "北", index=index).filter("id = 2").first()["highlight"] == "我们喜欢<mark>北</mark>京。"
    assert sorted(r["id"] for r in rows.filter(search.has_all_tokens(query, ["title", "content"], "words")).collect()) == ids
