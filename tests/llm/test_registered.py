"""The registered queries without SQL beside the libraries, column by column."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from heronlake.llm.queries import QUERIES
from tests.compare import SMALL
from tests.llm.test_dedup import brute_print, find_groups


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()


def rows_of(spark, name):
    return QUERIES[name](spark, SMALL).collect()


def test_op1(spark, docs):
    prints = {r["doc_id"]: brute_print(r["text"]) for r in docs}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = find_groups(prints, linked)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows_of(spark, "op1_simhash")} == {(i, f"{p:016x}", groups[i]) for i, p in prints.items()}


def test_op3(spark, docs):
    library, start, expected = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, set()
    for r in docs:
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        expected.add((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(spark, "op3_token_store")} == expected


def test_op4(spark, docs):
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs}
    of = {r["doc_id"]: r["source"] for r in docs}
    sources = sorted({*of.values()}, key=lambda s: (s is None, s))
    total = {s: sum(n for i, n in size.items() if of[i] == s) for s in sources}
    weight, target, rest, free = {s: k % 3 + 1 for k, s in enumerate(sources)}, {}, float(sum(total.values())), set(sources)
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * total[s]}
        target |= {s: 3.0 * total[s] for s in full} if full else share
        rest -= sum(target[s] for s in full)
        free = free - full if full else set()
    taken = dict.fromkeys(sources, 0)
    rows = rows_of(spark, "op4_source_mix")
    for r in rows:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[of[r["doc_id"]]]) and r["target"] == pytest.approx(target[of[r["doc_id"]]])
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[of[r["doc_id"]]] += r["taken"]
    assert len(rows) == len(docs)
    for s in sources:
        assert abs(taken[s] - target[s]) <= max(n for i, n in size.items() if of[i] == s) + 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, rows_of(spark, "op4_source_mix")))


def test_op7(spark):
    """On the next larger tables: the smallest hold a handful of toxic rows to learn from."""
    larger = SMALL.replace("0.001", "0.01")
    rows = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, larger).collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    assert rows.keys() == {r["doc_id"] for r in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id").collect()}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(toxic[i], r["predicted"]) for i, r in rows.items() if r["held_out"] and i in toxic]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_op8(spark, docs):
    library, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), set()
    library.no_truncation(), library.no_padding()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        expected.add((r["doc_id"], len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(spark, "op8_bpe")} == expected
