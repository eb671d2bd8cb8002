"""The merge of copies against a fold in plain Python."""

import random

from pyspark.sql import functions as F

from heronlake.operators import dedup

SCHEMA = "id string, o int, content string, keywords array<string>"


def fold(rows):
    out = {}
    for key, _, content, words in sorted(rows, key=lambda r: r[1]):
        if key not in out:
            out[key] = (content, list(dict.fromkeys(words or [])))
            continue
        base, held = out[key]
        longer = len(content or "") > len(base or "")
        out[key] = (content if longer else base, list(dict.fromkeys([*(words or []), *held] if longer else [*held, *(words or [])])))
    return out


def test_merge_fold_equals_a_plain_fold(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["k", "l", "m", "", None]), o, rng.choice([None, "x" * rng.randint(0, 12)]), rng.choice([None, [], rng.sample("abcdefghijklmno", 3)])) for o in range(400)]
    made = dedup.merge_fold(spark.createDataFrame(rows, SCHEMA), "id", ["o"]).collect()
    assert {r["id"]: (r["content"], r["keywords"]) for r in made} == fold(rows) and len(made) == 5
    assert all(r["content_length"] == len(r["content"] or "") for r in made)


def test_merge_fold_takes_every_copy_and_gathers_none(spark):
    n = 1_000_003
    rows = spark.range(n).select(F.lit("k").alias("id"), F.col("id").alias("o"), F.when(F.col("id") == n - 1, "longest").otherwise("x").alias("content"), F.array(F.when(F.col("id") == n - 1, "last").otherwise("w")).alias("keywords"))
    (row,) = dedup.merge_fold(rows, "id", ["o"]).collect()
    assert (row["content"], row["keywords"]) == ("longest", ["last", "w"])
