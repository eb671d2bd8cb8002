"""Long lists and long sentences take time in proportion to their length."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from heronlake.functions import entities as E
from heronlake.functions import text as X
from heronlake.operators import tagging


def test_firsts_of_long_lists(spark):
    r = random.Random(3)
    words = [None if i % 97 == 0 else r.choice(["", "Ab", "aB", "É", "é"]) + str(r.randrange(9000)) for i in range(20000)]
    kinds = [r.choice(["PER", "LOC", None]) for _ in words]
    began = time.time()
    row = spark.createDataFrame([(words, list(zip(words, kinds, strict=True)))], f"w array<string>, e {E.ENTITIES}").select(E.distinct_keywords(F.col("w")).alias("w"), E.distinct_entities(F.col("e")).alias("e")).first()
    assert time.time() - began < 20
    low, pairs = {}, {}
    for w, k in zip(words, kinds, strict=True):
        if w is not None:
            low.setdefault(w.lower(), w)
        pairs.setdefault((w and w.lower(), k), (w, k))
    assert row["w"] == list(low.values())
    assert [tuple(x) for x in row["e"]] == list(pairs.values())
    none = spark.createDataFrame([(None,), ([],)], "w array<string>").select(E.distinct_keywords(F.col("w")).alias("w"))
    assert [x["w"] for x in none.collect()] == [None, []]


def test_one_long_sentence_among_many():
    r = np.random.default_rng(1)
    steps = r.random((4, 3))
    scores = [r.random((n, 3)) for n in (20000, *([3] * 4000), 0, 1)]
    began = time.time()
    found = tagging.best_paths(scores, steps)
    assert time.time() - began < 4
    assert [len(x) for x in found] == [len(x) for x in scores]
    assert all((a == tagging.best_paths([s], steps)[0]).all() for a, s in zip(found[:40], scores[:40], strict=True))


def test_folding_line_by_line():
    r = random.Random(2)
    letters = ["a", "B", " ", "\n", "é", "e\u0301", "\u0301", "İ", "ſ", "ß", "ﬁ", "Ⅳ", "đ", "ς", "Σ", "\u1100", "\u1161", "\u0323", "Z9"]
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(12))) for _ in range(5000)]
    assert [X.folded_text(t) for t in texts] == [X.folded_word(t) for t in texts]
