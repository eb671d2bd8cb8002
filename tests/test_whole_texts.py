"""Recognition of whole texts."""

from heronlake.operators import cleaning
from heronlake.plans import queries


def found(spark, text, **options):
    rows = spark.createDataFrame([(1, "t", text)], "id long, title string, content string")
    (row,) = cleaning.recognise_entities(rows, cleaning.gazetteer_tagger({"Ann Lee": "PER"}), **options).collect()
    return [e["text"] for e in row["entities"]]


def test_recognition_takes_a_limit_or_whole_texts(spark):
    text = "x " * 4000 + "Ann Lee"
    assert found(spark, text) == [] and found(spark, text, chars=None) == ["Ann Lee"]


def test_the_query_recognises_whole_texts(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "t", "x " * 4000 + "The")], "id long, title string, content string")
    monkeypatch.setattr(queries.A, "articles", lambda s, d: rows)
    monkeypatch.setattr(queries.A, "table", lambda s, d, name: s.createDataFrame([], "doc_id long"))
    assert queries.ner_recognise(spark, "").first()["entities"] == "The/PER"
