"""Token files, BPE, mixing, URL rules, toxicity, WARC and the pipeline."""

import hashlib
import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heronlake.llm import bpe, mixing, token_store, toxicity, url_filter, warc
from heronlake.llm.support import words_in
from tests.compare import SMALL

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string"
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
CHUNKS = {WORD: bpe.ChunkEncoder(WORD), BYTE: bpe.ChunkEncoder(BYTE, lead=True)}
ALPHABETS = ["abcdefghijklmnop'", "aaaab", "a'st .,!\n", "ab\u0301eé각ᄀ\u1161<|>endoftx", "0123 a\x85\x1c b\u3000", "的中文字是Ωσς İß"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(ALPHABETS), st.integers(0, 300), st.integers(0, 10**9), st.booleans(), st.sampled_from([1, 2, 5]))
def test_encodings_equal_the_library(alphabet, n, seed, special, window):
    r = random.Random(seed)
    text = "".join(r.choice(alphabet) for _ in range(n))
    text = text[: n // 2] + "<|endoftext|>" + text[n // 2 :] if special else text
    expected = LIBRARY[WORD].encode(text, add_special_tokens=False).ids
    tree = bpe.TreeEncoder(CHUNKS[WORD], leaf=40, long_chunk=24, window=window)
    assert np.frombuffer(tree.encode(text), "<u4").tolist() == expected
    of = CHUNKS[BYTE]
    assert np.frombuffer(b"".join(of.parts(of.chunks(text))), "<u4").tolist() == LIBRARY[BYTE].encode(text, add_special_tokens=False).ids


def test_long_unsplit_text_is_joined():
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(20_000))
    tree = bpe.TreeEncoder(CHUNKS[WORD])
    assert np.frombuffer(tree.encode(text), "<u4").tolist() == LIBRARY[WORD].encode(text, add_special_tokens=False).ids
    assert tree.joins > 30


def test_long_texts_are_joined_from_halves():
    """All texts of the table over a leaf: every one goes through the tree, with the library's ids."""
    texts = [t for t in pq.read_table(f"{SMALL}/documents.parquet", columns=["text"]).column(0).to_pylist() if t and len(t) > bpe.LEAF]
    of = bpe.ChunkEncoder(WORD)
    for leaf in (bpe.LEAF, 300):
        tree = bpe.TreeEncoder(of, leaf=leaf)
        for t in texts:
            before = tree.joins
            assert np.frombuffer(tree.encode(t), "<u4").tolist() == LIBRARY[WORD].encode(t, add_special_tokens=False).ids
            assert tree.joins - before >= len(t) / leaf - 1
    assert len(texts) > 10


def test_encode_texts(spark):
    texts = ["Hello wörld <|endoftext|>x", "", None, "x" * 3000, "a b\n" * 4000]
    rows = spark.createDataFrame(list(enumerate(texts)), DOC).withColumn("ids", F.lit("own"))
    for r in bpe.encode_texts(rows, WORD).collect():
        expected = LIBRARY[WORD].encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected
        assert r["decoded"] == LIBRARY[WORD].decode(expected, skip_special_tokens=False)
    assert bpe.encode_texts(rows.limit(0), WORD).count() == 0


def test_token_files_round_trip(spark):
    texts = [(5, "b"), (2, None), (None, "n"), (9, "long " * 3000), (2, "a"), (7, "")]
    rows = spark.createDataFrame(texts, DOC)
    got = token_store.token_round_trip(rows, BYTE, shards=3, frame_bytes=64).collect()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, t) in zip(sorted(got, key=lambda r: r["start"]), order, strict=True):
        ids = [*LIBRARY[BYTE].encode(t or "", add_special_tokens=False).ids, 0]
        assert (r["id"], r["start"], r["n_tokens"]) == (i, start, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)
    assert token_store.token_round_trip(rows.limit(0), BYTE).count() == 0


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def test_shards_are_plain_zstandard_and_checked():
    out = io.BytesIO()
    writer = token_store.ShardWriter(out, 2, frame_bytes=100)
    documents = [np.arange(n) % 60000 for n in (1, 500, 0, 40, 3)]
    for k, d in enumerate(documents):
        writer.add(k, d.astype("<u2").tobytes())
    writer.close()
    data = out.getvalue()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(d.astype("<u2").tobytes() for d in documents)
    reader = token_store.ShardReader(Source(data))
    assert all((reader.document(k) == d).all() for k, d in enumerate(documents))
    opened = []
    reader.frame = lambda k, f=reader.frame: (opened.append(k), f(k))[1]
    reader.document(3)
    assert len(set(opened)) == 1
    broken = bytearray(data)
    broken[int(reader.packed[0]) - 1] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_store.ShardReader(Source(bytes(broken))).document(0)


def test_only_wanted_documents_are_read(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)], DOC)
    manifest = token_store.write_tokens(rows, uri := token_store.scratch_path(spark, "t"), BYTE, shards=4)
    assert sorted(r["id"] for r in token_store.read_tokens(spark, manifest, uri, wanted=[3, 40, 99]).collect()) == [3, 40]


def brute_targets(sizes: dict, weights: dict) -> dict:
    total, targets, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        left = total - sum(targets.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return targets | share
        targets |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return targets


def test_mixing(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["hot"] * 6 + ["b", "c", "a", None]), " ".join("w" for _ in range(r.randint(0, 40)))) for i in range(3000)]
    rows += [(9000, "tiny", "one"), (9001, "tiny", ""), (9002, "void", None), (9003, "b", "x y"), (9003, "b", "x y"), (None, "a", "z z z")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("own"))
    made = mixing.mix_sources(frame.drop("size"), chunk=16).collect()
    assert len(made) == len(rows)
    names = sorted({s for _, s, _ in rows if s is not None}) + [None]
    sizes = {s: sum(len((t or "").split()) for _, x, t in rows if x == s) for s in names}
    targets = brute_targets(sizes, {s: 1.0 + k % 3 for k, s in enumerate(names)})
    for s in names:
        own = [m for m in made if m["source"] == s]
        assert all(m["target"] == pytest.approx(targets[s]) and m["source_size"] == sizes[s] for m in own)
        assert abs(sum(m["taken"] for m in own) - targets[s]) <= 41
    assert all(m["taken"] == m["copies"] * m["size"] <= 3 * m["size"] for m in made)
    again = mixing.mix_sources(frame.drop("size").repartition(7), chunk=16).collect()
    assert sorted(map(repr, made)) == sorted(map(repr, again))
    mix = mixing.take_mix(frame)
    assert mix.columns == frame.columns and mix.count() == sum(m["copies"] for m in mixing.mix_sources(frame.drop("size")).collect())
    assert mixing.mix_sources(frame.drop("size").limit(0)).count() == 0


def test_copies_are_unbiased(spark):
    rows = spark.createDataFrame([(i, "s", "w " * (1 + i % 9)) for i in range(400)] + [(1000 + i, "t", "w") for i in range(900)], "doc_id long, source string, text string")
    total = 0
    for seed in range(4):
        total += sum(m["copies"] for m in mixing.mix_sources(rows, seed=seed).filter("source = 's' and size = 1").collect())
    rate = mixing.mix_sources(rows).filter("source = 's'").selectExpr("target / source_size AS r").first()["r"]
    n = 4 * sum(1 for i in range(400) if i % 9 == 0)
    assert abs(total / n - rate) < 0.25


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://Shop.EXAMPLE.com/en/7x?q", "http://example.com/en/8", "http://xcom/en/", "https://a.net/de/8", "https://b.example.net/de/8/x#t", "https://b.example.net/de/",
        "https://c.org/es/", "https://c.org/ES/", "http://spam-farm.example.org/fr/1", "http://notspam.example.org/fr/1", "http://cheap-pills.io", "x://com/en/", "http://u@h.com:80/en/1", "a://" + "x" * 100_000,
        "http://a.xyz/foo.com\n/en/1", "http://a\nb.com/en/1", "http://a.com\n/en/1", "http://c.com/\n/en/1", "http://a.net/de/\n8", "http://x\ny.spam-a\nb.io/", "http://io/z.spam-a.b", "\n://x.org/es/\n",
    ]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("own"))
    made = {r["page_id"]: r for r in url_filter.filter_urls(rows).collect()}
    for k, u in enumerate(urls):
        host, path = url_filter.split_url(u)
        fits = [x for x in url_filter.SITE_RULES if ("." + host).endswith("." + x.host) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert (made[k]["host"], made[k]["path"], made[k]["rule"]) == (host, path, best and best.name)
        if best:
            assert made[k]["verdict"] == best.action
    assert [made[k]["verdict"] for k in (0, 2, 11, 12, 13)] == ["allow", "allow", "block", "allow", "block"]
    assert [made[k]["rule"] for k in range(17, 25)] == [None, "com/en/", None, None, "net/de/", None, None, "org/es/"]
    assert [made[k]["verdict"] for k in (17, 22, 23)] == ["allow", "block", "allow"]
    assert url_filter.filter_urls(rows.limit(0)).count() == 0
    index = url_filter.RuleIndex(url_filter.SITE_RULES + url_filter.SPAM_PATTERNS, {"com": 100, "en": 50, "example": 10})
    assert sorted(index.by_token) == ["casino", "com", "en", "es", "example", "free", "cheap", "net", "spam"] or all(len(v) for v in index.by_token.values())


def brute_distance_one(word: str, term: str) -> bool:
    if abs(len(word) - len(term)) > 1:
        return False
    if len(word) == len(term):
        return sum(a != b for a, b in zip(word, term, strict=True)) <= 1
    short, long_ = sorted((word, term), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", min_size=1, max_size=8))
def test_misspellings_by_automaton(word):
    terms = {"abcda": (False, 5.0), "bbacd": (False, 4.0), "dcbabc": (False, 6.0), "aaab": (False, 5.0)}
    found = toxicity.Lexicon(terms).look_up(word)
    if word in terms:
        assert found == (0, terms[word][1])
    else:
        near = [w for t, (_, w) in terms.items() if len(t) >= 5 and len(word) >= 4 and brute_distance_one(word, t)]
        assert found == ((1, max(near)) if near else None)


def test_context():
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": (False, 6.0), "vequ": (True, 5.0)}), [-3.0, 4.0, 4.0, 0.2, 1.0, 1.0])
    plain, quoted = scorer.score("you idiot"), scorer.score('he wrote "you idiot" there')
    assert plain > 0.7 > quoted > scorer.score("a kind word") == scorer.score(None) == scorer.score("")
    assert scorer.score("you idiott") > 0.5 and scorer.score("vequment ici") > 0.7


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels), keep=["doc_id"]).withColumn("held_out", toxicity.held_out())
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    hits = sum(r["score"] >= 0.7 and r["toxic"] == 1 for r in rows)
    flagged, toxic = sum(r["score"] >= 0.7 for r in rows), sum(r["toxic"] == 1 for r in rows)
    assert hits / flagged >= 0.85 and hits / toxic >= 0.7
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) == r["held_out"] for r in scored.limit(50).collect())


def test_toxicity_without_labels_scores_zero(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (None, None)], DOC)
    scorer = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in toxicity.score_texts(docs, scorer).collect()] == [0.0, 0.0]
    assert toxicity.drop_toxic(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).columns == docs.columns


def test_warc_round_trip(spark):
    big, small = "é" * 80, "tiny"
    pages = [(7, "http://a.com/1", big), (3, "http://a.com/2", big), (9, None, big), (1, "u", small), (2, "u", small), (4, "v", None), (5, "x\r\ny", "z" * 5000), (3, "http://a.com/2", big), (None, "n", big)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("own"))
    made = warc.archive_round_trip(rows, file_bytes=2000).collect()
    assert len(made) == len(pages)
    for r in made:
        assert r["request"]["record_id"] and r["metadata"]["record_id"] and r["response"]["digest_ok"] is not False
    group = sorted(((r["page_id"] or 0), r["response"]["type"], r["refers_to"]) for r in made if r["response"]["payload_digest"] == hashlib.sha256(big.encode()).hexdigest())
    assert group == [(0, "revisit", 3), (3, "response", None), (3, "revisit", 3), (7, "revisit", 3), (9, "revisit", 3)]
    assert all(r["response"]["payload_bytes"] == 160 for r in made if r["page_id"] in (3, 7, 9))
    assert all(r["response"]["type"] == "response" for r in made if r["page_id"] in (1, 2, 4))
    assert warc.archive_round_trip(rows.limit(0)).count() == 0


def test_records_keep_their_blocks(spark):
    rows = spark.createDataFrame([(1, "http://a.com/x", "payload " * 50)], "page_id long, url string, html string")
    manifest = warc.write_warc(rows, uri := warc.scratch_path(spark, "w"))
    captures = warc.assemble(warc.read_warc(spark, manifest, uri)).first()
    assert captures["response"]["block"].endswith(b"payload " * 50) and captures["request"]["block"].startswith(b"GET http://a.com/x")
    assert captures["response"]["fields"]["warc-target-uri"] == "http://a.com/x"
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(zlib.compress(b"junk\r\n\r\n", wbits=31))))


def test_words_are_counted(spark):
    texts = ["", None, " ", "a", " a", "a ", "\n\ta  b\x0bc\r", "\u00a0", "a\u00a0b c", " \t"]
    made = spark.createDataFrame([(t,) for t in texts], "t string").select(words_in("t")).collect()
    assert [r[0] for r in made] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_mixing_of_given_sizes_ties_and_long_texts(spark):
    rows = [(1, "a", "w " * 50_000), (2, "a", None), (3, None, "x y"), (3, None, "x z"), (3, None, "x z"), (None, "b", "q " * 10)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("taken", F.lit("own"))
    made = mixing.mix_sources(frame).collect()
    given = mixing.mix_sources(frame.select("doc_id", "source", words_in("text").alias("size")), text=None).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in made) == sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in given)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in made) and len(made) == 6


def test_scores_with_clashing_columns_and_odd_rows(spark):
    scorer = toxicity.Scorer(toxicity.Lexicon({"idiot": (False, 5.0)}), [-3.0, 2.0, 2.0, 1.0, 0.0, 0.0])
    texts = ["you idiot", "you idiot", "", None, "fine " * 100_000 + "idiot"]
    frame = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    made = {r["doc_id"]: r["score"] for r in toxicity.score_texts(frame, scorer).collect()}
    assert made == {i: pytest.approx(scorer.score(t)) for i, t in enumerate(texts)} and made[0] == made[1] > made[2] == made[3]
    assert toxicity.score_texts(frame.limit(0), scorer).count() == 0
    docs = spark.createDataFrame([(i, "bad worms" if i % 2 else "good", "x") for i in range(40)] * 3, "doc_id long, text string, y string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, toxic int")
    assert toxicity.train(docs, labels).weights is not None


def test_tokens_with_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a b", "own", 5), (1, "a b", "own", 5), (2, "c", "own", 5)], "doc_id long, text string, ids string, shard int")
    made = token_store.token_round_trip(rows, BYTE).collect()
    assert sorted((r["id"], r["start"]) for r in made) == [(1, 0), (1, 3), (2, 6)]


def test_records_planned_in_rounds(spark):
    """Equal payloads, ties and nulls give the same records through one and eight rounds."""
    texts = [None, "", "s" * 50, "a" * 100, "b" * 200, "c" * 300]
    rows = [(k if k % 7 else None, texts[k % 6]) for k in range(40)] + [(3, "a" * 100), (3, "a" * 100), (500, "only " * 40)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    one, eight = (sorted(map(tuple, warc.plan_records(pages, "page_id", "html", 100, **o).collect()), key=repr) for o in ({}, {"max_bits": 16 * 30 // 8}))
    assert one == eight and len(one) == len(rows)
    responses = [r for r in one if r[4] == "response" and r[3] >= 100]
    assert len({r[2] for r in responses}) == len(responses) == 4
