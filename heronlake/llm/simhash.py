"""SimHash near-deduplication with a pigeonring filter.

Fingerprint: a text's words are lower-cased (A-Z) runs of characters that aren't ASCII white space; its shingles are
hashed by XXH64; a bit of the 64 is set if it is set in over half of the hashes. Fingerprints link when they differ
in `max_bits` bits or fewer.

Candidates: the 64 bits form a ring of `segments` segments. If two fingerprints differ in t bits or fewer, then from
some segment on every chain of l consecutive segments holds at most l * t / segments of the differences (the
pigeonring principle, which is stricter than the pigeonhole principle's single segment). With the defaults (3 bits, 5
segments) the budgets of the chains are 0, 1, 1, 2, 3: the first segment is equal, and the next two differ in one
bit at most, so of the four parts that these two are cut into three are equal. Each start and each choice of parts
gives a key of about 32 bits, 20 in all, and equal keys meet. Within a key's bucket a pair must keep the budgets of
all chains from that start before its full Hamming distance is taken.

Equal fingerprints are one node from the start, however many texts have them. A bucket yields a spanning forest of
its links, found by breadth-first search over the fingerprints that aren't reached yet, never all pairs. A bucket of
over BUCKET fingerprints is dealt as pairs of blocks to several tasks, all of them, so nothing is capped.

Defined cases: a text without words, empty or null has fingerprint zero, which links like any other; fewer words than
a shingle make one shingle; texts are read whole, in pieces of bounded size; rows may repeat; a null id is in the
component of its fingerprint but doesn't name one (null if no row of the component has an id); rows that share an id are
separate documents; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.components import connected_components
from heronlake.llm.support import written

BITS, SEED = 64, 42
#: Fingerprints of a bucket that one task compares; a larger bucket is dealt as pairs of blocks of about so many.
BUCKET = 1 << 13
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 20
SPACE = b" \t\n\v\f\r"


def pieces(data: bytes, size: int = PIECE):
    """data in pieces of about size bytes that end at white space."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[at:end]
        at = end


def shingle_hashes(text: str | None, width: int):
    """Arrays of the 64-bit hashes of all shingles of a text, repeats included."""
    digest, tail, seen = xxhash.xxh64_intdigest, [], 0
    for piece in pieces((text or "").encode("utf-8", "surrogatepass")):
        words = tail + piece.lower().split()
        seen += len(words) - len(tail)
        if len(words) >= width:
            yield np.array([digest(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)], dtype=np.uint64)
            tail = words[len(words) - width + 1 :]
        else:
            tail = words
    if 0 < seen < width:
        yield np.array([digest(b" ".join(tail), SEED)], dtype=np.uint64)


def fingerprint_all(texts: list[str | None], width: int = 3) -> np.ndarray:
    """Unsigned 64-bit fingerprints."""
    ones, total = np.zeros((len(texts), BITS), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def add() -> None:
        sizes = np.array([len(x) for x in held])
        bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=np.int32)
        np.add.at(ones, owners, sums)
        np.add.at(total, owners, sizes)
        held.clear(), owners.clear()

    waiting = 0
    for k, text in enumerate(texts):
        for hashes in shingle_hashes(text, width):
            held.append(hashes), owners.append(k)
            waiting += len(hashes)
            if waiting > 100_000:
                add()
                waiting = 0
    if held:
        add()
    return np.packbits((2 * ones > total[:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): one row per document; fp is the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(texts), 1000):
                part = texts.slice(at, 1000)
                fps = fingerprint_all(part.to_pylist(), width).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1000), pa.array(fps, pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(run, "id bigint, fp bigint")


class Ring:
    """Segments, the chains' budgets and the keys that follow from them."""

    def __init__(self, max_bits: int = 3, segments: int = 5):
        if not 0 <= max_bits < segments:
            raise ValueError("the first segment of a chain must be free of differences: max_bits < segments")
        self.max_bits = max_bits
        ends = [BITS * k // segments for k in range(segments + 1)]
        self.masks = [sum(1 << b for b in range(ends[k], ends[k + 1])) for k in range(segments)]
        self.budgets = [(k + 1) * max_bits // segments for k in range(segments)]
        # The longest chain that may hold one difference gives the most selective keys.
        reach = max(k for k in range(segments) if self.budgets[k] <= 1)
        self.keys: list[tuple[int, int]] = []
        for start in range(segments):
            rest = [b for k in range(1, reach + 1) for b in range(BITS) if self.masks[(start + k) % segments] >> b & 1]
            parts = 4 if self.budgets[reach] else 1
            for free in range(parts):
                kept = [b for i, b in enumerate(rest) if not self.budgets[reach] or i * parts // len(rest) != free]
                self.keys.append((start, self.masks[start] | sum(1 << b for b in kept)))

    def chain(self, start: int):
        """(mask, budget) of the chains from a start, shortest first."""
        mask = 0
        for k in range(len(self.masks)):
            mask |= self.masks[(start + k) % len(self.masks)]
            yield mask, self.budgets[k]

    def near(self, start: int, one: np.uint64, others: np.ndarray) -> np.ndarray:
        """Indices of the others that keep every chain's budget from start, and then the full distance."""
        differ = others ^ one
        left = np.arange(len(others))
        for mask, budget in self.chain(start):
            fits = np.bitwise_count(differ & np.uint64(mask)) <= budget
            left, differ = left[fits], differ[fits]
        return left[np.bitwise_count(differ) <= self.max_bits]


def forest(ring: Ring, start: int, fps: np.ndarray) -> list[tuple[int, int]]:
    """Links (i, j) between the fingerprints of a bucket that connect whatever its links connect."""
    left, links = np.arange(len(fps)), []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            i = frontier.pop()
            hit = ring.near(start, fps[i], fps[left])
            if len(hit):
                links += [(i, j) for j in left[hit]]
                frontier += list(left[hit])
                left = np.delete(left, hit)
    return links


OUT = "a bigint, b bigint"


def _solve(ring: Ring):
    """Links between fingerprints, over rows (k, masked, block, fp) sorted by bucket."""

    def run(batches):
        held_key, fps = None, []
        out: list[tuple] = []

        def close():
            if sum(map(len, fps)) > 1:
                f = np.concatenate(fps)
                out.extend((int(f[i]), int(f[j])) for i, j in forest(ring, ring.keys[held_key[0]][0], f.view(np.uint64)))
            fps.clear()

        def flush():
            a, b = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            k, masked, block, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(k):
                continue
            cuts = np.flatnonzero((k[1:] != k[:-1]) | (masked[1:] != masked[:-1]) | (block[1:] != block[:-1])) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(k)]])
            # A bucket of one row that neither goes on from the last batch nor reaches the next has nothing to compare.
            alone = ends - starts == 1
            alone[0] = alone[-1] = False
            for s, e in zip(starts[~alone].tolist(), ends[~alone].tolist(), strict=True):
                key = (int(k[s]), int(masked[s]), int(block[s]))
                if key != held_key:
                    close()
                    held_key = key
                fps.append(fp[s:e])
            if len(out) >= 5000:
                yield flush()
        close()
        if out:
            yield flush()

    return run


def links(nodes: DataFrame, max_bits: int = 3, segments: int = 5, bucket: int = BUCKET) -> DataFrame:
    """(a, b) between the distinct fingerprints of nodes (fp): enough links to connect whatever is linked."""
    ring = Ring(max_bits, segments)
    signed = [m - (1 << 64) if m >> 63 else m for _, m in ring.keys]
    keys = F.array(*(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("masked")) for i, m in enumerate(signed)))
    rows = nodes.select("fp", F.explode(keys).alias("key")).select("key.k", "key.masked", "fp")
    # A bucket over the limit is dealt as blocks from the start: no task ever takes all of it.
    large = written(rows.groupBy("k", "masked").agg(F.count("*").alias("m")).filter(F.col("m") > bucket), "simhash-large")
    none = large.isEmpty()
    small = rows if none else rows.join(large, ["k", "masked"], "left_anti")
    sorted_rows = small.select("k", "masked", F.lit(0).alias("block"), "fp").repartition("k", "masked").sortWithinPartitions("k", "masked")
    found = written(sorted_rows.mapInArrow(_solve(ring), OUT), "simhash-links")
    if none:
        return found
    # Every block meets every other (and itself) in a task of its own.
    blocks = F.ceil(F.col("m") / bucket).cast("int")
    members = rows.join(large, ["k", "masked"]).withColumn("n_blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int"))
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    low, high = F.least("block", "other").cast("long"), F.greatest("block", "other").cast("long")
    dealt = paired.select("k", "masked", (high * (high + 1) / 2 + low).cast("long").alias("block"), "fp")
    again = dealt.repartition("k", "masked", "block").sortWithinPartitions("k", "masked", "block")
    return found.union(written(again.mapInArrow(_solve(ring), OUT), "simhash-links"))


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3, max_bits: int = 3, segments: int = 5, bucket: int = BUCKET) -> DataFrame:
    """(id, fp, fingerprint, component_id), a row for each document."""
    prints = written(fingerprints(docs, id_column, text, width), "simhash-fps")
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    parts = connected_components(links(nodes.select("fp"), max_bits, segments, bucket))
    named = nodes.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "first", "component")
    # Most fingerprints link with none: only components are gathered.
    least = named.filter("component is not null").groupBy("component").agg(F.min("first").alias("least")).select((F.col("component") + 0).alias("__c"), "least")
    named = named.join(least, F.col("component") == F.col("__c"), "left").select(F.col("fp").alias("__fp"), F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    named = written(named, "simhash-named")
    joined = prints.join(named, F.col("fp") == F.col("__fp"))
    return joined.select("id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
