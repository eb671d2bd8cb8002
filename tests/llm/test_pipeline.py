"""The pipeline against brute force, stage by stage and as a whole."""

import collections

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from heronlake.llm import mixing, toxicity
from heronlake.llm.support import drop_scratch, table
from tests.compare import SMALL
from tests.llm.test_dedup import find_groups
from tests.llm.test_near_dedup import brute_similar

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="module")
def documents(spark):
    """The table, with rows that no table has: nulls in every column, empty and long texts, repeated rows and ids."""
    docs = table(spark, SMALL, "documents").limit(150)
    text = docs.first()["text"]
    odd = [(None, text, "en", "web", 1), (9001, None, None, None, None), (9002, "", "en", "web", 0), (9003, text, None, "web", 3), (9003, text + " more", "en", "web", 4), (9004, "x y z " * 30_000, "en", "forum", 5), (9005, "q r s t u v", "en", None, 6), (9005, "q r s t u v", "en", None, 6)]
    return docs.select(*(c.split()[0] for c in COLUMNS.split(", "))).union(spark.createDataFrame(odd, COLUMNS))


def brute_toxic(spark, rows):
    scorer = toxicity.train(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    return [r for r in rows if scorer.score(r["text"]) < 0.7]


def brute_copies(rows):
    kept = {}
    for r in rows:
        key = r["text"] or ""
        if key not in kept or (r["doc_id"] is not None and (kept[key]["doc_id"] is None or r["doc_id"] > kept[key]["doc_id"])):
            kept[key] = r
    return list(kept.values())


def brute_near(rows):
    known = [(k, r["text"]) for k, r in enumerate(rows) if r["doc_id"] is not None]
    groups = find_groups([k for k, _ in known], brute_similar(known))
    best = {}
    for k, _ in known:
        g = groups[k]
        best[g] = k if g not in best or rows[k]["doc_id"] < rows[best[g]]["doc_id"] else best[g]
    return [rows[k] for k in best.values()] + [r for r in rows if r["doc_id"] is None]


def test_each_stage_equals_brute_force(spark, documents):
    rows = documents.collect()
    names = documents.columns
    # Rows that agree in text and id may differ in other columns: any of them may stay, so these are left out here.
    keyed = lambda found: collections.Counter((r["doc_id"], r["text"]) for r in found)
    not_toxic = STAGES["toxicity"](spark, documents, SMALL)
    scorer_rows = brute_toxic(spark, rows)
    assert not_toxic.columns == names and len(scorer_rows) > 100
    # The stage learns from the rows that it is given, which hold nearly all of those of the table.
    assert sum(((keyed(scorer_rows) - keyed(not_toxic.collect())) + (keyed(not_toxic.collect()) - keyed(scorer_rows))).values()) <= 0.05 * len(rows)
    copies = STAGES["exact dedup"](spark, documents, SMALL)
    assert copies.columns == names and keyed(copies.collect()) == keyed(brute_copies(rows))
    near = STAGES["SimHash near-dedup"](spark, copies, SMALL)
    # Of two near copies with one id either may stay.
    assert near.columns == names and collections.Counter(r["doc_id"] for r in near.collect()) == collections.Counter(r["doc_id"] for r in brute_near(copies.collect()))
    mixed = STAGES["source mixing"](spark, near, SMALL)
    taken = collections.Counter()
    for r in mixing.mix_sources(near).collect():
        taken[r["doc_id"], r["text"]] += r["copies"]
    assert mixed.columns == names and keyed(mixed.collect()) == +taken and max(taken.values()) <= 3
    coded = STAGES["BPE encoding"](spark, mixed, SMALL)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect() if r["doc_id"] not in (9003, None)}
    assert coded.count() == mixed.count()
    for r in coded.collect():
        if r["doc_id"] in texts:
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids and r["n_tokens"] * 4 == len(r["ids"])


def test_the_whole_equals_its_stages(spark):
    rows = table(spark, SMALL, "documents").collect()
    kept = {r["doc_id"]: r for r in brute_near(brute_copies(brute_toxic(spark, rows)))}
    frame = spark.createDataFrame(list(kept.values()), table(spark, SMALL, "documents").schema)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(frame).collect()}
    made = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect())
    assert made == +collections.Counter(taken)
    assert drop_scratch(spark) > 0 and drop_scratch(spark) == 0


def test_no_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
