"""Pairs at the threshold within a label whose vectors all lie close together."""

import numpy as np

from heronlake.llm import embed_dedup


def test_pairs_in_a_tight_label_are_found(spark):
    rng = np.random.default_rng(17)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    centre = unit(rng.standard_normal(64))
    x = unit(3 * centre + unit(rng.standard_normal((4000, 64))))
    y = unit(x[:150] + 0.19 * unit(rng.standard_normal((150, 64))))
    planted = [i for i in range(150) if x[i] @ y[i] >= 0.98]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, y]))]
    made = {r["id"]: r["component_id"] for r in embed_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(planted) > 100 and all(made[i] == made[4000 + i] for i in planted)
