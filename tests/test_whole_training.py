"""The tagger learns from all labelled articles, whatever their number and length, and as one sentence after the other would teach it."""

import random

import numpy as np
from pyspark.sql import functions as F

from heronlake.operators import tagging

KIND = "id long, title string, entities array<struct<text: string, type: string>>"


def _titles(n: int, seed: int) -> list[tuple[int, str, list[tuple[str, str]]]]:
    r = random.Random(seed)
    name = lambda: "".join(r.choices(["ba", "co", "di", "fu", "ga"], k=2)).capitalize()
    rows = []
    for i in range(n):
        a, b, c = name(), name(), name()
        rows.append((i, f"Mr {a} {b} lives in {c}. So it is!", [(f"{a} {b}", "PER"), (c, "LOC")]))
    return rows


def test_every_labelled_article_is_a_row(spark):
    rows = [(i, "At Hue", [("Hue", "LOC")]) for i in range(4_200)] + [(5_000, "so " * 1_000 + "Ba", [("Ba", "PER")]), (5_001, "", []), (5_002, None, []), (5_003, "It", None)]
    found = tagging.training_rows(spark.createDataFrame(rows, KIND))
    assert len(found) == 4_201 and sum("B-PER" in tags for _, tags in found) == 1


def test_texts_of_over_2000_characters_teach(spark):
    rows = spark.createDataFrame([(i, "so " * 700 + t, e) for i, t, e in _titles(3, 1)], KIND)
    assert tagging.train(rows).tags == ["O", "B-LOC", "B-PER", "I-PER"]


def test_many_names_of_one_first_word():
    tokens = ["A", "b"] * 20_000
    assert tagging.label(tokens, [("A b", "PER"), ("A", "ORG"), ("A b", "LOC")] * 20_000) == ["B-PER", "I-PER"] * 20_000
    assert tagging.label(["A", "b", "A"], [("A b", "PER"), ("A", "LOC"), ("A b c", "ORG")]) == ["B-PER", "I-PER", "B-LOC"]


def test_blocks_learn_as_one_sentence_after_the_other():
    examples = [(r["title"], r["tags"]) for r in ({"title": tagging.TOKEN.findall(t), "tags": tagging.label(tagging.TOKEN.findall(t), e)} for _, t, e in _titles(150, 2))]
    fitted = tagging.fit(examples, passes=2)
    tags = ["O", "B-LOC", "B-PER", "I-PER"]
    now, total = np.zeros((tagging.SLOTS + 5, 4)), np.zeros((tagging.SLOTS + 5, 4))
    for k in range(2):
        turn = list(range(len(examples)))
        tagging._order(7, k).shuffle(turn)
        for tokens, own in (examples[i] for i in turn):
            around = tagging._slots(["", *tokens, ""]).astype(int)
            rows = [[*around[i, :11], *around[i - 1, 11:13], *around[i + 1, 13:]] for i in range(1, len(tokens) + 1)]
            path = tagging.best_paths([np.array([now[x].sum(axis=0) for x in rows])], now[tagging.SLOTS :])[0]
            for sign, said in ((1, [tags.index(t) for t in own]), (-1, path.tolist())):
                for x, t, before in zip(rows, said, [4, *said[:-1]], strict=True):
                    for slot in (*x, tagging.SLOTS + before):
                        now[slot, t] += sign
            total += now
    assert fitted.tags == tags and np.allclose(np.vstack([fitted.weights, fitted.steps]), total / (2 * len(examples)), rtol=1e-12)


def test_shards_do_not_depend_on_partitions(spark):
    rows, held = _titles(400, 3), _titles(100, 4)
    made = [tagging.train(spark.createDataFrame(r, KIND).repartition(n), shard_chars=4_000) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert (made[0].weights == made[1].weights).all() and (made[0].steps == made[1].steps).all()
    truth = [tagging.label(tagging.TOKEN.findall(t), e) for _, t, e in held]
    assert tagging.quality(made[0].tag_sentences([tagging.TOKEN.findall(t) for _, t, _ in held]), truth) == (1.0, 1.0)


def test_one_shard_is_fit(spark):
    rows = spark.createDataFrame(_titles(60, 5), KIND)
    lone = tagging._labelled(rows, "title", "id").orderBy(F.xxhash64("id", "k")).collect()
    fitted, trained = tagging.fit([(r["words"].split(" "), r["tags"]) for r in lone]), tagging.train(rows)
    assert fitted.tags == trained.tags and (fitted.weights == trained.weights).all() and (fitted.steps == trained.steps).all()
    nobody = tagging.train(rows.filter("id < 0"))
    assert nobody.tags == ["O"] and nobody("Mr Ba") == [("Mr", "O"), ("Ba", "O")]
