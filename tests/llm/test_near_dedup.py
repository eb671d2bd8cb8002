"""Near copies at a similarity of shingles against brute force."""

import random

import numpy as np
import pytest

from heronlake.llm import near_dedup, simhash
from tests.llm.test_dedup import DOC, WORDS, corpus, find_groups, prose

SMALL = "/root/testdata/sf0.001"


def near_corpus() -> list[tuple]:
    rng = random.Random(23)
    rows = corpus()
    for g in range(12):
        base = prose(rng.randint(60, 400)).split()
        for k in range(8):
            words = list(base)
            for _ in range(k * len(words) // 150):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((1000 + 20 * g + k, " ".join(words)))
    return rows


def brute_similar(rows, width=5):
    sets = {}
    for i, t in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    return [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))]


@pytest.mark.parametrize("bucket", [near_dedup.BUCKET, 3])
def test_near_groups_at_a_similarity(spark, bucket):
    rows = near_corpus()
    linked = brute_similar(rows)
    prints = {i: simhash.fingerprint_all([t])[0] for i, t in rows}
    assert any(int(np.bitwise_count(prints[a] ^ prints[b])) > 3 for a, b in linked)  # three bits of op1 miss these
    groups = find_groups([i for i, _ in rows], linked)
    made = near_dedup.near_groups(spark.createDataFrame(rows, DOC), bucket=bucket).collect()
    assert {r["id"]: r["component_id"] for r in made} == groups


def test_the_pipeline_drops_texts_at_a_similarity(spark):
    import corpus_pipeline

    rows = near_corpus()
    groups = find_groups([i for i, _ in rows], brute_similar(rows))
    frame = spark.createDataFrame([(*r, "k") for r in rows] + [(None, "a b c d", "k")] * 2, DOC + ", fp string")
    kept = corpus_pipeline.drop_near_copies(spark, frame, SMALL)
    assert kept.columns == frame.columns and sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted([-1, -1, *set(groups.values())])
    assert corpus_pipeline.drop_near_copies(spark, frame.limit(0), SMALL).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    a, z, q = prose(30), prose(30), prose(30)
    rows = [(1, a, "k"), (5, a, "k"), (5, z, "k"), (7, q, "k"), (7, q, "k"), (8, q, "k"), (9, "", "k"), (10, None, "k"), (None, a, "k")]
    kept = near_dedup.drop_near_copies(spark.createDataFrame(rows, DOC + ", component string").repartition(3))
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect()) == sorted([(1, a), (5, z), (7, q), (9, ""), (0, a)])
    assert kept.columns == ["doc_id", "text", "component"]


def test_a_crowd_of_near_copies_yields_a_few_pairs_a_text():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    by = rng.integers(0, 1 << 62, near_dedup.BITS // 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = [np.unique(np.concatenate([base[rng.random(300) > 0.05], rng.integers(0, 1 << 62, 15, dtype=np.uint64)])) for _ in range(200)]
    prints = np.stack([near_dedup.fingerprint(s, by) for s in sets])
    pairs = near_dedup.tree_pairs(prints, np.array([len(s) for s in sets]), 0.8, near_dedup.most_bits(near_dedup.SIMILARITY))
    assert len(pairs) <= 200 * (near_dedup.NEAREST + 1) and len(set(find_groups(range(200), list(pairs)).values())) == 1
    other = np.stack([near_dedup.fingerprint(rng.integers(0, 1 << 62, 300, dtype=np.uint64), by) for _ in range(50)])
    assert not near_dedup.tree_pairs(other, np.full(50, 300), 0.8, near_dedup.most_bits(near_dedup.SIMILARITY))
