"""Best passages beside all passages; highlights of searches with and without an index."""

import math
import random

import pytest

from heronlake.functions import highlight as H
from heronlake.operators import dedup, search
from heronlake.plans import adapters as A
from heronlake.plans.queries import QUERIES
from tests.compare import SMALL


def best_of_all(text, terms, size):
    """Every start: (weight of the distinct terms that are whole inside, the first such start)."""
    found, best, at = H.hits(text, terms), 0.0, None
    for start in range(max(1, len(text))):
        held = {w for s, e, w in found if start <= s and e <= start + size}
        weight = sum(sorted(terms[w] for w in held))
        if held and weight > best + 1e-9:
            best, at = weight, start
    return at


@pytest.mark.parametrize("seed", range(40))
def test_best_passage_equals_all_passages(seed):
    r = random.Random(seed)
    words = ["aa", "b", "ccc", "x", "yy", "zzzz", "é"]
    text = "".join(r.choice(words) + r.choice([" ", ", ", "\n", "."]) for _ in range(r.choice([1, 5, 60])))
    terms = {"aa": 1.5, "b": 0.7, "ccc": r.choice([0.1, 2.0]), "é": 0.7}
    size = r.choice([4, 9, 25, 1000])
    found = H.hits(text, terms)
    assert H.best_passage(found, terms, size) == (best_of_all(text, terms, size) if found else None)


def test_fragments():
    terms = {"duong": 1.0, "a": 0.0}
    assert H.fragment("T Đường", "không", terms, fold=True) == "T <mark>Đường</mark>"
    assert H.fragment("a", "x ĐƯỜNG, a", terms, fold=True) == "x <mark>ĐƯỜNG</mark>, <mark>a</mark>"
    assert H.fragment(None, None, terms) is None and H.fragment("", "duongx a_", terms) is None
    assert H.fragment("", "z " * 100 + "a", {"a": 0.0}, size=5) == "z z <mark>a</mark>"
    assert H.best_passage(H.hits("b " + "a" * 20, {"a" * 20: 1.0}), {"a" * 20: 1.0}, 5) == 2


def test_searches_show_the_best_passages(spark, tmp_path):
    rows = dedup.near_dup_groups(A.articles(spark, SMALL), ["id"])
    rows.write.parquet(f"{tmp_path}/articles")
    rows = spark.read.parquet(f"{tmp_path}/articles")
    index = search.SearchIndex.write(rows.filter("is_canonical"), f"file://{tmp_path}/index")
    both = [search.search(rows, "the Idiot clown", index=i).select("id", "score", "highlight", "content").collect() for i in (None, index)]
    key = lambda found: [(r["id"], round(r["score"], 9), r["highlight"]) for r in found]
    assert key(both[0]) == key(both[1]) and both[0]
    counts = {t: sum(bool(H.hits(r["content"], {t: 1.0})) for r in rows.filter("is_canonical").collect()) for t in ("the", "idiot", "clown")}
    assert counts["the"] > counts["idiot"]
    for r in both[0]:
        plain = r["highlight"].replace("<mark>", "").replace("</mark>", "")
        held = {w for _, _, w in H.hits(plain, dict.fromkeys(counts, 1.0))}
        # The rarest of the tokens that the content holds is always shown.
        there = {t for t in counts if H.hits(r["content"], {t: 1.0})}
        assert min(there, key=counts.get) in held and len(plain) <= 150


def test_registered_highlights_equal_all_passages(spark):
    rows = {r["id"]: r for r in dedup.near_dup_groups(A.articles(spark, SMALL), ["id"]).filter("is_canonical").collect()}
    n = {t: sum(bool(H.hits(r["content"], {t: 1.0})) for r in rows.values()) for t in ("idiot", "clown")}
    total = sum(bool(H.WORD.search(r["content"])) for r in rows.values())
    weights = {t: math.log1p((total - k + 0.5) / (k + 0.5)) for t, k in n.items()}
    found = QUERIES["sch4_highlight"](spark, SMALL).collect()
    assert found
    for r in found:
        text = rows[r["id"]]["content"]
        at = best_of_all(text, weights, 150)
        if at is not None:
            assert r["highlight"] == H.marked(text, H.hits(text, weights), at, at + 150)
