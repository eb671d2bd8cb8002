"""Exact dedup, SimHash, components, embeddings and long matches against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from heronlake.llm import embed_dedup, exact_dedup, long_matches, run_index, simhash
from heronlake.llm.components import connected_components

DOC = "doc_id long, text string"
random.seed(11)
WORDS = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 7))) for _ in range(300)]


def prose(n: int) -> str:
    return " ".join(random.choice(WORDS) for _ in range(n))


def corpus() -> list[tuple]:
    rows = [(i, prose(random.randint(0, 120))) for i in range(60)]
    base = [prose(60) for _ in range(4)]
    rows += [(100 + i, random.choice(base)) for i in range(30)]
    for i in range(40):
        words = random.choice(base).split()
        words[random.randrange(len(words))] = random.choice(WORDS)
        rows.append((200 + i, prose(random.randint(0, 9)) + " " + " ".join(words)))
    return rows + [(300, ""), (301, None), (302, " \n"), (303, "x"), (304, "X y"), (305, prose(20000)), (306, "ab" * 40), (307, "ab" * 30), (308, "€" * 30), (309, "€" * 40)]


def find_groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_exact_dedup(spark):
    rows = corpus()
    made = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOC).withColumns({"kept": F.lit("own"), "more": F.lit(1)}))
    keep = {}
    for i, t in rows:
        keep[t or ""] = max(keep.get(t or "", -1), i)
    for r in made.collect():
        assert r["keep_id"] == keep[r["text"] or ""] and r["kept"] == (r["doc_id"] == r["keep_id"]) and r["more"] == 1
        assert r["text_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert r["group_size"] == sum((t or "") == (r["text"] or "") for _, t in rows)
    assert made.count() == len(rows)


def test_exact_dedup_stays_exact_when_the_filter_is_full(spark):
    rows = spark.createDataFrame(corpus(), DOC)
    tight = exact_dedup.drop_repeats(rows, bits_per_row=1, max_bits=64)
    assert sorted(r["doc_id"] for r in tight.collect()) == sorted(r["doc_id"] for r in exact_dedup.drop_repeats(rows).collect())


def test_exact_dedup_of_ties_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(1, "a", "p"), (1, "a", "q"), (None, "b", "p"), (None, "b", "q"), (None, "a", "r")], DOC + ", keep_id string")
    kept = exact_dedup.drop_repeats(rows)
    assert kept.columns == rows.columns and sorted(r["text"] for r in kept.collect()) == ["a", "b"]
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOC)).count() == 0


@pytest.mark.parametrize("rounds", [1, 8])
def test_exact_dedup_in_rounds(spark, tmp_path, rounds):
    """Ties, nulls and repeated rows through one and eight rounds; the text is read for prints, and once each way for the rows."""
    rows = corpus() + [(i, t) for i, t in corpus()[::3]] + [(None, "n"), (None, "n"), (None, None), (10**6, ""), (10**6, "")]
    spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], DOC + ", more long").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    bits = -(-16 * len(rows) // rounds)
    made = exact_dedup.exact_dedup(docs, max_bits=bits)
    best: dict = {}
    for i, t in rows:
        best.setdefault(t or "", []).append(i)
    found = made.collect()
    for r in found:
        ids = best[r["text"] or ""]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = [r["text"] or "" for r in found if r["kept"]]
    assert sorted(kept) == sorted(best) and len(found) == len(rows)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    plan = exact_dedup.drop_repeats(docs.filter("more < 100"), max_bits=bits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [doc_id") <= 3 and plan.count("BroadcastExchange") <= 7


def brute_print(text: str | None) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
def test_simhash_groups(spark, bucket):
    rows = corpus()
    prints = {i: brute_print(t) for i, t in rows}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = find_groups(prints, linked)
    made = simhash.simhash_groups(spark.createDataFrame(rows, DOC), bucket=bucket).collect()
    assert {r["id"]: r["component_id"] for r in made} == groups
    assert {r["id"]: r["fingerprint"] for r in made} == {i: f"{p:016x}" for i, p in prints.items()}


def test_every_near_pair_shares_a_key():
    ring = simhash.Ring()
    for _ in range(3000):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, 3)):
            b ^= 1 << bit
        met = [s for s, m in ring.keys if a & m == b & m]
        assert any(len(ring.near(s, np.uint64(a), np.array([b], dtype=np.uint64))) for s in met)


def test_simhash_of_pieces_equals_the_whole(monkeypatch):
    text = prose(500) + "\n\t" + "x" * 200 + " end"
    whole = simhash.fingerprint_all([text])
    hashes = np.concatenate(list(simhash.shingle_hashes(text, 3)))
    monkeypatch.setattr(simhash.pieces, "__defaults__", (64,))
    assert (np.concatenate(list(simhash.shingle_hashes(text, 3))) == hashes).all()
    assert simhash.fingerprint_all([text]) == whole


def test_simhash_of_repeated_ids_and_clashing_columns(spark):
    text = prose(50)
    rows = [(5, "a b c d", 1, "k"), (5, text, 2, "k"), (2, "A b c  d", 3, "k"), (None, text, 4, "k"), (None, "z z z z z", 5, "k")]
    frame = spark.createDataFrame(rows, DOC + ", fp long, component_id string")
    made = sorted((r["id"] or 0, r["component_id"] or 0) for r in simhash.simhash_groups(frame).collect())
    assert made == [(0, 0), (0, 5), (2, 2), (5, 2), (5, 5)]
    assert simhash.simhash_groups(spark.createDataFrame([], DOC)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    made = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert made == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_embedding_groups(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rng.standard_normal(16) * 0.05 * (i % 5)).tolist(), i % 2) for i in range(300)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 0), (502, None, 0), (503, [0.0] * 16, 0), (504, [float("nan")] * 16, 1), (505, [None] + [1.0] * 15, 1), (506, rows[0][1], None), (507, [1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    ok = {i: np.array(v, dtype=np.float32).astype(float) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, _, lab in rows}
    linked = []
    for a in ok:
        for b in ok:
            if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= 0.98:
                linked.append((a, b))
    groups = find_groups([r[0] for r in rows], linked)
    for part, space_bytes in ((2048, 1 << 20), (7, 1 << 20), (2048, 0), (7, 0)):
        made = embed_dedup.embedding_groups(frame, block=128, window=16, part=part, space_bytes=space_bytes).collect()
        assert {r["id"]: r["component_id"] for r in made} == groups
        assert {r["id"]: r["n_links"] for r in made} == {i: sum(i in p for p in linked) for i in groups}
        assert all(r["kept"] == (r["id"] == r["component_id"]) for r in made)
    assert embed_dedup.embedding_groups(frame.limit(0)).count() == 0


def test_embeddings_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 2.0], 0), (3, [1.0], 0), (None, [1.0], 0), (4, [1e200, 1e200], 1), (5, [1e-200, 1e-200], 1)]
    for space_bytes in (0, 1 << 20):
        made = embed_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), space_bytes=space_bytes).collect()
        # The second vector of id 1 links with that of id 2; each set of vectors is a component of its own.
        assert sorted((r["id"] or 0, r["n_links"], r["component_id"]) for r in made) == [(0, 1, 3), (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 4), (5, 1, 4)]


def brute_matches(rows, length=50):
    seen: dict[bytes, int] = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            seen.setdefault(data[p : p + length], i)
    out = {}
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] < i:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out[i] = ([tuple(x) for x in edges.reshape(-1, 2).tolist()], bytes(np.frombuffer(data, dtype=np.uint8)[~gone]))
    return out


def as_rows(strings, width):
    rows = np.full((len(strings), width), run_index.END, dtype=np.uint8)
    for row, s in zip(rows, strings, strict=True):
        row[: len(s)] = np.frombuffer(s, dtype=np.uint8)
    return rows, np.array([len(s) for s in strings], dtype=np.int64)


def test_run_index_gives_longest_matches_and_smallest_documents():
    for _ in range(150):
        letters, width, length = random.choice([2, 3, 5]), random.choice([9, 12, 30]), random.choice([8, 9, 12])
        base = [bytes(97 + random.randrange(letters) for _ in range(width)) for _ in range(2)]
        strings = []
        for _ in range(random.randint(1, 8)):
            s = bytearray(random.choice(base))
            s[random.randrange(width)] = 97 + random.randrange(letters)
            strings.append(bytes(s[random.randrange(3) : random.randint(4, width)]))
        docs = np.array([random.randrange(5) for _ in strings])
        patterns = sorted([*strings, *base], key=len, reverse=True)
        index = run_index.RunIndex(*as_rows(strings, width), docs, length)
        for i, k, lengths, places, runs in index.matching_statistics(*as_rows(patterns, width)):
            assert k == sum(len(p) > i for p in patterns)
            for p, got, place, run in zip(patterns[:k], lengths, places, runs, strict=True):
                n = 0
                while i + n < len(p) and any(p[i : i + n + 1] in s for s in strings):
                    n += 1
                assert n == got
                if n >= length:
                    assert index.least_document(place[None], run[None])[0] == min(d for s, d in zip(strings, docs, strict=True) if p[i : i + length] in s)


def test_repetitive_strings_make_few_runs():
    one = np.array([[random.randrange(97, 117) for _ in range(70)]] * 50, dtype=np.uint8)
    index = run_index.RunIndex(one, np.full(50, 70), np.arange(50), 50)
    assert len(index.symbol) < 3 * 70 + 51 and len(index.text) == 50 * 71


#: As in production; anchors that are cut in two, with buckets, blocks and pieces of a few; hot anchors in one bucket.
SMALL = {"piece": 5, "hot": 1, "block_bytes": 2000, "bucket_bytes": 5000, "bucket_contexts": 50}
MATCH_OPTIONS = [{}, SMALL, {"hot": 2, "block_bytes": 1500}, {"gram": 16, "block_bytes": 1500, "piece": 40}]


@pytest.mark.parametrize("options", MATCH_OPTIONS)
def test_long_matches(spark, options):
    rows = corpus()
    made = long_matches.long_matches(spark.createDataFrame(rows, DOC).repartition(5), **options).collect()
    expected = brute_matches(rows)
    assert len(made) == len(rows)
    for r in made:
        assert ([tuple(s) for s in r["spans"]], bytes(r["kept"])) == expected[r["id"]], r["id"]


@pytest.mark.parametrize("options", [SMALL, {"hot": 4, "block_bytes": 1000}])
def test_long_matches_of_a_hot_passage(spark, options):
    """One passage stands in every document, whole or cut, between words of their own; some documents are copies."""
    passage = prose(60)
    rows = [(i, prose(12) + " " + passage[i % 7 * 5 : 150 + i % 11 * 9] + " " + prose(8)) for i in range(120)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(30)] + [(300, passage * 40)]
    random.shuffle(rows)
    frame = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, block long, data string")
    expected = brute_matches(rows)
    for r in long_matches.long_matches(frame.repartition(4), **options).collect():
        assert ([tuple(s) for s in r["spans"]], bytes(r["kept"])) == expected[r["id"]], r["id"]


def test_long_matches_of_null_ids_and_nothing(spark):
    text = prose(40)
    rows = spark.createDataFrame([(None, text), (4, text), (4, text)], DOC)
    assert sorted((r["id"] or 0, len(r["spans"])) for r in long_matches.long_matches(rows).collect()) == [(0, 1), (4, 0), (4, 0)]
    assert long_matches.long_matches(spark.createDataFrame([], DOC)).count() == 0
