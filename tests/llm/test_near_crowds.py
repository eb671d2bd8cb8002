"""Crowds of near copies lose no link, and what is moved for them grows with their texts, not their pairs."""

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from heronlake.llm import near_dedup
from tests.llm.test_dedup import DOC, find_groups
from tests.llm.test_near_dedup import brute_similar


def crowd(texts: int, words: int = 150) -> list[tuple[int, str]]:
    """Texts at 0.6 to 0.8 of each other, with few links: each has the base's words but for one to four."""
    rng = random.Random(31)
    base = [f"w{k}" for k in range(words)]
    rows = []
    for i in range(texts):
        own = list(base)
        for k in rng.sample(range(5, words - 5), rng.randint(1, 4)):
            own[k] = f"x{i}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("options", [{}, {"cluster": 16}, {"elements": 3000, "bucket": 20}])
def test_a_crowd_is_grouped_as_by_brute_force(spark, options):
    rows = crowd(100) + [(500 + k, f"{k} b c d e f g") for k in range(20)]
    groups = find_groups([i for i, _ in rows], brute_similar(rows))
    assert len(set(groups.values())) > 22
    made = near_dedup.near_groups(spark.createDataFrame(rows, DOC), **options).collect()
    assert {r["id"]: r["component_id"] for r in made} == groups


def test_a_crowded_bucket_yields_less_than_a_pair_a_text():
    rows = crowd(150)
    ring = near_dedup.Ring(1000)
    by = ring.factors()
    sets = [near_dedup.shingle_set(t) for _, t in rows]
    prints = np.stack([near_dedup.fingerprint(s, by)[: near_dedup.BITS // 64] for s in sets])
    pairs = near_dedup.met_pairs(ring, np.zeros(150, dtype=np.uint64), prints, np.array([len(s) for s in sets]), 0.8, near_dedup.most_bits(near_dedup.SIMILARITY))
    assert len(pairs) == 149 and len(set(find_groups(range(150), list(pairs)).values())) == 1


def test_links_of_a_block_and_between_two_connect_as_all_pairs_do():
    rng = np.random.default_rng(3)
    sets = [np.unique(np.concatenate([np.arange(60)[rng.random(60) > 0.09], rng.integers(100, 1000, 2)])) for _ in range(60)]
    linked = [(i, j) for i in range(60) for j in range(i + 1, 60) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    for sides in (np.zeros(60, dtype=int), np.repeat([0, 1], [25, 35])):
        wanted = [(i, j) for i, j in linked if sides[i] != sides[j] or not sides.any()]
        pairs = near_dedup.joined(sets, sides, Fraction(4, 5))
        assert 0 < len(pairs) < 60 <= len(wanted) and set(pairs) <= set(wanted)
        assert find_groups(range(60), pairs) == find_groups(range(60), wanted)
    assert near_dedup.joined([np.arange(4), np.arange(5)], np.array([1, 1]), Fraction(4, 5)) == [(0, 1)]


def test_a_task_counts_a_key_once_however_many_batches_it_reads():
    rng = np.random.default_rng(1)
    ring = near_dedup.Ring(1000)
    rings = [rng.bytes(8 * ring.words) for _ in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rings[at : at + 100], pa.binary())], names=["ring"]) for at in range(0, 3000, 100)]
    rows = [r for out in near_dedup.counted(ring)(iter(batches)) for r in out.to_pylist()]
    keys = np.concatenate([k for k, _ in ring.starts(rings, chains=False)])
    assert {r["key"]: r["m"] for r in rows} == dict(zip(*(x.tolist() for x in np.unique(keys, return_counts=True)), strict=True))
    assert len(rows) <= ring.segments << ring.width
