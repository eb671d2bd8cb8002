"""Filter audit, benchmark decontamination and token alignment beside brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from heronlake.llm import decontamination as D
from heronlake.llm import token_alignment as A
from heronlake.llm.filter_audit import filter_audit, mark_copies
from heronlake.llm.queries import QUERIES
from tests.compare import SMALL

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTE)
LIBRARY.encode_special_tokens = True
SP = SentencePieceProcessor(model_file=PIECE)

# Filter audit


def audited(docs, labels):
    """Brute force: every document through every order."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in docs]
    fails = []
    for (i, t, _), w in zip(docs, words, strict=True):
        t = t or ""
        same = [j for j, u, _ in docs if (u or "") == t]
        earlier = any(j is not None and (i is None or j < i) for j in same)
        fails.append((len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), earlier))
    good, toxic = ({i for i, q, x in labels if (q, x)[k] == 1 and i is not None} for k in (0, 1))
    out, shapley = {}, Counter()
    for order in permutations(range(5)):
        name = "".join("ABCDE"[k] for k in order)
        for part in {p or "" for _, _, p in docs}:
            alive = [n for n, d in enumerate(docs) if (d[2] or "") == part]
            every = list(alive)
            for step, k in enumerate(order, 1):
                gone = [n for n in alive if fails[n][k]]
                redundant = [n for n in every if fails[n][k] and n not in alive]
                alive = [n for n in alive if not fails[n][k]]
                unique = [n for n in every if fails[n][k] and sum(fails[n]) == 1]
                out[part, name, step] = (len(alive), len(gone), len(redundant), len(unique), sum(docs[n][0] in good for n in gone), sum(docs[n][0] in toxic for n in gone))
                shapley[part, k] += len(gone)
    return {key: (*v, shapley[key[0], "ABCDE".index(key[1][key[2] - 1])]) for key, v in out.items()}


CASES = [
    (1, None, "a"), (2, "", None), (3, "", ""), (None, "same", "a"), (None, "same", "b"), (7, "same", "a"), (7, "same", "a"), (9, "same", "b"), (10, "x " * 300, "a"), (11, " ".join(map(str, range(300))), "a"),
    (12, " ".join(map(str, range(300))), "b"), (13, "AB c", "a"), (14, "a€é" * 2000, "c"), (15, "a€é" * 1999 + "a€e", "c"), (16, "a€é" * 2000, "c"), (17, "A" * 5000 + "b#", "c"), (None, None, None),
]
LABELS = [(7, 1, 0), (7, 0, 1), (10, None, None), (11, 1, 1), (99, 1, 1), (None, 1, 1), (12, 0, 0)]


@pytest.mark.parametrize("options", [{}, {"keys": 1}, {"keys": 3, "blocks": (2,)}, {"max_bits": 1}])
def test_audit_equals_brute_force(spark, options):
    docs = spark.createDataFrame([(i, t, s, 0, 0, "x") for i, t, s in CASES], "doc_id long, text string, source string, id int, mask int, __text string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = filter_audit(docs, labels, **options).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in rows}
    assert len(rows) == len(found) and found == audited(CASES, LABELS)


def test_audit_of_an_empty_table(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).collect() == []
    some = spark.createDataFrame(CASES, docs.schema)
    assert {r["good_lost"] for r in filter_audit(some, labels).collect()} == {0}


def test_classes_of_one_text_move_no_text(spark):
    """Only texts whose class survived every split are compared."""
    docs = spark.createDataFrame([(k, f"text {k % 50:04d} " * 30) for k in range(60)], "doc_id long, text string")
    marked = {r["id"]: r["copy"] for r in mark_copies(docs).collect()}
    assert marked == {k: k >= 50 for k in range(60)}


# Decontamination


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        m = min(10, len(w))
        for p in range(len(w) - m + 1 if m else 0):
            if i is not None:
                windows[tuple(w[p : p + m])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, named = words_of(t), set(), set()
        for m in {len(x) for x in windows}:
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    named |= windows[tuple(w[p : p + m])]
        spans = [k for k in sorted(hit) if k - 1 not in hit], [k + 1 for k in sorted(hit) if k + 1 not in hit]
        out.append((i, len(w), tuple(zip(*spans, strict=True)), tuple(sorted(named))))
    return sorted(out, key=repr)


def checked(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, 0, "x", 1) for i, t in docs], "doc_id long, text string, row int, window string, size int").repartition(3)
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, item int")
    rows = D.contaminated_spans(frame, benchmark, **options).collect()
    return sorted(((r["id"], r["n_words"], tuple((s["start"], s["end"]) for s in r["spans"]), tuple(r["items"])) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_hits_equal_brute_force(spark, seed):
    r = random.Random(seed)
    vocabulary = ["a", "B", "é", "cc", "d3", "ﬁ", "x" * 60, "x" * 60 + "y"][: 2 + 3 * seed]
    text = lambda n: r.choice([" ", "-", "\n . "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(k % 17, text(r.choice([0, 1, 3, 7, 9, 10, 11, 30]) if k % 9 or not seed else 12)) for k in range(20)] + [(40, None), (None, text(12)), (5, "zz zz zz zz zz zz zz zz zz zz zz")]
    items = [i for i in items if len(words_of(i[1])) > (0 if seed == 2 else 5) or not words_of(i[1])]
    docs = [(k % 25, text(r.choice([0, 2, 9, 10, 40, 200]))) for k in range(30)] + [(50, None), (51, ""), (None, items[0][1]), (52, "zz " * 500), (52, "zz " * 500), (53, " ".join((t or "").upper() for _, t in items))]
    expected = contaminated(docs, items)
    assert checked(spark, docs, items) == expected
    assert checked(spark, docs, items, max_bits=1) == expected


def test_hits_with_an_empty_side(spark):
    assert checked(spark, [], [(1, "a b")]) == []
    assert checked(spark, [(1, "a b"), (None, None)], []) == [(1, 2, (), ()), (None, 0, (), ())]
    assert checked(spark, [(1, "a b")], [(3, "..."), (4, None)]) == [(1, 2, (), ())]


def test_long_texts_are_read_by_pieces():
    r = random.Random(5)
    text = " ".join(r.choice(["ab", "c", "É", "x" * 70]) for _ in range(3000)).encode()
    every = D.Benchmark(32768, np.full(4096, 255, dtype=np.uint8), [2, 10])
    whole = D.find_in([text], every)
    assert D.find_in([text], every, piece=97) == whole and D.find_in([b"ab c", text, b""], every, piece=500)[1] == whole[0]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 10))
def test_equal_windows_choose_equal_grams(seed, size):
    r = random.Random(seed)
    shared = [r.choice("ab") for _ in range(size)]
    sides = [D.Words([" ".join([r.choice("ab") for _ in range(n)] + shared + [r.choice("ab") for _ in range(3)]).encode()]) for n in (0, 5)]
    chosen = []
    for words, n in zip(sides, (0, 5), strict=True):
        windows, at, hashes = words.fingerprints(size)
        i = list(windows).index(n)
        chosen.append((int(at[i]) - n, int(hashes[i])))
    assert chosen[0] == chosen[1]


# Alignment


def aligned(docs):
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    of_char = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
    rows, holders = [], Counter()
    for i, t in docs:
        a = LIBRARY.encode(" " + t, add_special_tokens=False) if t else None
        a_bytes = [bytes(of_char[c] for c in x) for x in a.tokens] if t else []
        b = SP.encode(t) if t else []
        b_bytes = [bytes([int(p[3:5], 16)]) if SP.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, map(SP.id_to_piece, b), strict=True)]
        data = (" " + t).encode() if t else b""
        if not t or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            rows.append((i, 0, 0, [], Counter()))
            continue
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        groups, start = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(([x for x, e in zip(a.ids, a_ends, strict=True) if start < e <= cut], [x for x, e in zip(b, b_ends, strict=True) if start < e <= cut]))
            start = cut
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        holders.update(links.keys())
        rows.append((i, len(a.ids), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for i, n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, n_a, n_b, len(groups), sum(links.values()), text, sum(n for p, n in links.items() if holders[p] == most[p[0]]), sum(n * holders[p] for p, n in links.items())))
    return sorted(out, key=repr), {(x, y): (n, n == most[x]) for (x, y), n in holders.items()}


ALIGNED = [
    (1, "The cat's  café\n\nnaïve \t x"), (1, "The cat's  café\n\nnaïve \t x"), (2, None), (3, ""), (None, " "), (4, "  lead and trail  "), (5, "<|endoftext|> <s> <0x41> <unk>"), (6, "a▁b ▁"), (7, "สวัสดี 的中文 \U0001f600‍"),
    (8, "é é ﬁ x²　y z"), (9, "a\x00b\x1fc\r\n\x85"), (10, "\n" * 40 + " " * 33 + "x"), (11, "Z" * 500), (12, "x'll 'S it's !!! 12345678"), (13, "ĠĠ Ċ Ġthe"),
]


@pytest.mark.parametrize("hot", [1, 50, A.HOT])
def test_alignment_equals_brute_force(spark, hot):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in ALIGNED], "doc_id long, text string, row int, pairs string").repartition(3)
    made, pairs = A.align_tokenizers(docs, BYTE, PIECE, hot=hot)
    expected, holders = aligned(ALIGNED)
    assert sorted(map(tuple, made.collect()), key=repr) == expected
    assert {(r["a"], r["b"]): (r["docs"], r["best"]) for r in pairs.collect()} == holders


def test_registered_alignment_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest() if r[1] else "", *r[6:]) for r in aligned(docs)[0]]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(tuple, QUERIES["op13_token_alignment"](spark, SMALL).select(names).collect()), key=repr) == expected


def test_alignment_of_an_empty_table(spark):
    made, pairs = A.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE)
    assert made.collect() == [] and pairs.collect() == []


ALPHABETS = ["abc déf ", "the cat's \n.", " \t\n　x", "的中文 字是Ωσς▁", "aaaab 01", "<s>unk|edoftx 0x4A"]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(ALPHABETS), st.integers(1, 200), st.integers(0, 10**9))
def test_chunked_encodings_equal_the_libraries(alphabet, n, seed):
    r = random.Random(seed)
    text = "".join(r.choice(alphabet) for _ in range(n))
    for t in (text, text.strip().replace("  ", " ") or "x"):
        expected = LIBRARY.encode(" " + t, add_special_tokens=False).ids, SP.encode(t)
        spelled = OWN[1].spelled(np.array(expected[1], dtype="<u4")) == (" " + t).encode()
        for found in A.Aligner(*OWN).tokens([t, "x " + t, t])[::2]:
            assert (found is not None) == spelled and (found is None or tuple(x.tolist() for x in found) == expected)


OWN = A.ByteLevel(BYTE, memo=300), A.Pieces(PIECE, memo=200)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=60), st.integers(0, 10**9))
def test_ranks_of_shared_cuts(sizes, seed):
    r, total = random.Random(seed), sum(sizes)
    ends = sorted({*r.sample(range(1, total + 1), min(total, 20)), total})
    others = np.diff([0, *ends])
    a, b = A.groups_of(np.array(sizes), others)
    cuts = sorted(set(np.cumsum(sizes).tolist()) & set(ends))
    assert a.tolist() == [sum(e <= c for e in np.cumsum(sizes)) for c in cuts] and b.tolist() == [sum(e <= c for e in ends) for c in cuts]


def test_a_group_of_very_many_links_is_expanded_in_strips(monkeypatch):
    aligner = A.Aligner(*OWN)
    whole = aligner.align(["ab " * 9 + "Z" * 500, "x y"], False)
    monkeypatch.setattr(A, "LINKS", 7)
    assert aligner.align(["ab " * 9 + "Z" * 500, "x y"], False) == whole


def test_pairs_survive_packing():
    pairs, times = np.array([0, 1, 5, 1 << 43]), np.array([1, 1 << 40, 2, 3])
    assert [x.tolist() for x in A.unpack(A.pack(pairs, times))] == [pairs.tolist(), times.tolist()]
