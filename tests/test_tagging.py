"""The learned tagger: decoding beside all paths, held-out quality, the registered query beside plain merging."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronlake.operators import cleaning, tagging
from heronlake.plans import adapters as A
from heronlake.plans.queries import QUERIES, _learns
from tests.compare import SMALL


def test_best_paths_equal_all_paths():
    r = np.random.default_rng(1)
    steps = r.integers(-3, 4, (4, 3)).astype(float)
    scores = [r.integers(-3, 4, (n, 3)).astype(float) for n in (3, 0, 5, 1, 5, 2)]
    for own, path in zip(scores, tagging.best_paths(scores, steps), strict=True):
        value = lambda p: sum(own[i, t] + steps[p[i - 1] if i else 3, t] for i, t in enumerate(p))  # noqa: E731, B023
        every = list(product(range(3), repeat=len(own)))
        best = max(map(value, every))
        assert value(path.tolist()) == best and path.tolist() == list(min((p for p in every if value(p) == best), key=lambda p: p[::-1]))
    assert tagging.best_paths([], steps) == []


def test_labels_are_longest_first():
    tokens = tagging.TOKEN.findall("Le Van A met Le Van in Hue")
    assert tagging.label(tokens, [("Le Van", "PER"), ("Le Van A", "PER"), ("Hue", "LOC"), ("", "ORG")]) == ["B-PER", "I-PER", "I-PER", "O", "B-PER", "I-PER", "O", "B-LOC"]


def test_a_rule_is_learned():
    """Names of two words behind a title are persons, capitals behind "in" are places."""
    r = np.random.default_rng(2)
    words = ["ba", "co", "di", "fu", "ga"]
    name = lambda: "".join(r.choice(words, 2)).capitalize()
    examples = []
    for _ in range(300):
        a, b, c = name(), name(), name()
        examples.append((["Mr", a, b, "lives", "in", c, "."], ["O", "B-PER", "I-PER", "O", "O", "B-LOC", "O"]))
    tagger = tagging.fit(examples[:200])
    held = examples[200:]
    assert tagging.quality(tagger.tag_sentences([t for t, _ in held]), [t for _, t in held]) == (1.0, 1.0)
    assert tagger("") == [] and tagger(" \n ") == [] and [t for _, t in tagger("Mr Bacod Fuga lives in Coba.")] == ["O", "B-PER", "I-PER", "O", "O", "B-LOC", "O"]
    assert tagging.fit([]).tag_all(["A b"]) == [[("A", "O"), ("b", "O")]]


@pytest.fixture(scope="module")
def tagger(spark):
    return tagging.train(A.articles(spark, SMALL).filter(_learns()))


def test_held_out_quality(spark, tagger):
    held = tagging.training_rows(A.articles(spark, SMALL).filter(~_learns()))
    precision, recall = tagging.quality(tagger.tag_sentences([t for t, _ in held]), [t for _, t in held])
    assert precision > 0.8 and recall > 0.8, (precision, recall)


def test_registered_query_equals_plain_merging(spark, tagger):
    rows = A.articles(spark, SMALL).filter(~_learns()).select("id", "title", "content").collect()
    found = {r["id"]: (r["entities"], r["failed"]) for r in QUERIES["ner_learned"](spark, SMALL).collect()}
    expected = {}
    for row in rows:
        kept: dict = {}
        for text in (row["title"], row["content"]):
            tagged, i = tagger(text), 0
            while i < len(tagged):
                j = i + 1
                if tagged[i][1] != "O":
                    while j < len(tagged) and tagged[j][1] == f"I-{tagged[i][1][2:]}":
                        j += 1
                    words = " ".join(t for t, _ in tagged[i:j])
                    if 2 <= len(words) <= 60:
                        kept.setdefault((words.lower(), tagged[i][1][2:]), f"{words}/{tagged[i][1][2:]}")
                i = j
        expected[row["id"]] = ("|".join(kept.values()), 0)
    assert found == expected


def test_failures_are_counted(spark):
    rows = spark.createDataFrame([(1, "good", "bad"), (2, "bad", "bad"), (3, None, "good"), (4, "good", "")], "id long, title string, content string")

    def tagger(text):
        if text == "bad":
            raise ValueError(text)
        return [(text, "B-PER")]

    found = cleaning.recognise_entities(rows, tagger, errors="failed").select("id", F.size("entities").alias("n"), "failed").collect()
    assert {tuple(r) for r in found} == {(1, 1, 1), (2, 0, 2), (3, 1, 0), (4, 1, 0)}
    assert cleaning.recognise_entities(rows, tagger).columns == ["id", "title", "content", "entities"]
