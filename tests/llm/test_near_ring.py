"""Near copies meet by the segments and chains of a SimHash ring, whatever the sizes of their sets."""

import numpy as np

from heronlake.llm import near_dedup


def test_pairs_at_the_similarity_meet_from_as_many_starts_as_reckoned():
    rng = np.random.default_rng(11)
    ring = near_dedup.Ring(200_000)
    by = ring.factors()
    assert (1 - ring.found) ** ring.segments <= near_dedup.MISS and ring.segments * ring.width <= 64 * ring.words
    for common, a, b in ((4, 0, 1), (8, 1, 1), (160, 20, 20), (400, 0, 100)):
        met = []
        for _ in range(150):
            hashes = rng.integers(0, 1 << 64, common + a + b, dtype=np.uint64)
            sets = [hashes[: common + a], np.concatenate([hashes[:common], hashes[common + a :]])]
            prints = [near_dedup.fingerprint(s, by) for s in sets]
            found = 0
            for keys, chains in ring.starts([p.tobytes() for p in prints]):
                together = keys[0] == keys[1] and ring.keeps(chains[:1] ^ chains[1:])[0]
                pairs = near_dedup.met_pairs(ring, chains, np.stack([p[: near_dedup.BITS // 64] for p in prints]), np.array([len(s) for s in sets]), 0.8, near_dedup.most_bits(near_dedup.SIMILARITY))
                assert not together or pairs == {(0, 1)}
                found += together
            met.append(found)
        assert min(met) > 0 and np.mean(met) >= 0.9 * ring.found * ring.segments, (common, a, b)


def test_a_chain_over_its_budget_ends_a_pair():
    ring = near_dedup.Ring(1000)
    over = [(1 << (budget + 1)) - 1 << 64 - bits for bits, budget in zip(near_dedup.CHAIN, ring.budgets, strict=True)]
    kept = [(1 << budget) - 1 << 64 - bits for bits, budget in zip(near_dedup.CHAIN, ring.budgets, strict=True)]
    assert not ring.keeps(np.array(over, dtype=np.uint64)).any()
    assert [near_dedup.Ring(n).width for n in (0, 255, 1 << 18)] == [4, 4, 9]
    assert ring.keeps(np.array(kept[:1] + [0], dtype=np.uint64)).all()
