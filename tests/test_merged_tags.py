"""Entities that are merged where they are tagged are those of the column function."""

import random

from pyspark.sql import functions as F

from heronlake.functions import entities as E
from heronlake.operators import cleaning


def test_merged_equal_merge_bio(spark):
    r = random.Random(6)
    made = {f"t{i}": [(r.choice(["An", "an", "Lee", "x", " b ", ""]), r.choice(["O", "B-PER", "I-PER", "I-PER", "B-LOC", "I-LOC", "B-", "I-", "odd"])) for _ in range(r.randrange(30))] for i in range(200)}
    rows = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(0, 200, 2)], "title string, content string")
    tags = spark.createDataFrame([(k, v) for k, v in made.items()], "name string, tags array<struct<token: string, tag: string>>").select("name", E.merge_bio(F.col("tags")).alias("merged"))
    merged = {x["name"]: x["merged"] for x in tags.collect()}
    for row in cleaning.recognise_entities(rows, made.__getitem__).collect():
        first: dict = {}
        for e in [*merged[row["title"]], *merged[row["content"]]]:
            first.setdefault((e["text"].lower(), e["type"]), tuple(e))
        assert [tuple(e) for e in row["entities"]] == list(first.values())
