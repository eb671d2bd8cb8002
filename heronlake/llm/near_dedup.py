"""Near-deduplication by the exact similarity of five-word shingles.

Texts link when the Jaccard similarity of their sets of shingles is `similarity` or more. Words and shingles are
simhash's: lower-cased (A-Z) runs of characters that aren't ASCII white space, hashed by XXH64. Groups are the connected
components of the links.

Candidates: a long SimHash of the set is a ring of segments, as in simhash, and texts meet that are equal in a segment. From
there the pigeonring's chains decide: each longer chain of bits from that start has a budget of differences, and a
pair that exceeds one is left out at that start. At 0.8 a bit differs with a chance of 0.15 (0.1875 for the worst sizes of
sets, four shingles of five), so no budgets that hold for certain leave a segment free of differences, and these are drawn from
the chance instead: Ring takes as many segments as miss a pair at 0.8 with a chance of MISS, by the worst sizes; pairs over
it are missed more rarely. A segment has half the bits of the number of texts, so that about the square root of that
number, or twice it, meet by chance.

Of the pairs that keep their chains, those go on whose first BITS of the ring differ in no more bits than a pair at the threshold
exceeds with a chance of 1e-5. A bucket whose texts have up to NEAREST such partners each yields all its pairs. A denser
one is spanned by a tree of the smallest Hamming distances, so it yields less than a pair a text. A bucket of over BUCKET
texts is dealt as pairs of blocks to several tasks; trees of all pairs of blocks hold a tree of the whole.

These pairs only say which texts may link: their connected components are clusters. All texts of a cluster meet once, with
their whole sets, and there every two of them are compared (by lists of each shingle's holders), unless links already connect
them. So a crowd loses no link however dense it is, and moves a row a text, not a row a pair. A cluster of over CLUSTER texts
or ELEMENTS shingles is dealt as pairs of blocks, each to be compared by a task of its own.

Defined cases: texts with equal sets are one node from the start; texts without words, empty or null have equal (empty)
sets; fewer words than a shingle make one shingle; rows may repeat; rows without an id stay.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.components import connected_components
from heronlake.llm.simhash import shingle_hashes
from heronlake.llm.support import let_go, row_hash, written

WIDTH, SEED = 5, 9
SIMILARITY = Fraction(4, 5)
#: Bits of the fingerprints that rank the texts of a bucket, the partners of a text up to which a bucket yields all pairs, and
#: the texts that a task compares.
BITS, NEAREST, BUCKET = 256, 6, 1 << 13
#: Texts and shingles in a block of a cluster.
CLUSTER, ELEMENTS = 1 << 10, 1 << 20
#: The chance of missing a pair at the similarity, and the bits after a start's segment at which its chains are judged.
MISS, CHAIN = 1e-6, (16, 32, 48, 64)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    parts = list(shingle_hashes(text, width))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


def digest(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def binomial(n: int, p: float) -> list[float]:
    return [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]


@cache
def differ(similarity: Fraction, sizes: int = 32) -> float:
    """The highest chance that a bit of two fingerprints differs at this similarity, over all pairs of sizes up to `sizes`, and
    for large sets that of the angle between them."""
    worst = math.acos(2 * float(similarity) / (1 + float(similarity))) / math.pi
    for a in range(1, sizes + 1):
        for b in range(a, sizes + 1):
            c = math.ceil(similarity * (a + b) / (1 + similarity))
            if c > a:
                break
            more = [(n, binomial(n - c, 0.5)) for n in (a, b)]
            total = 0.0
            for x, chance in enumerate(binomial(c, 0.5)):
                p, q = (sum(w for k, w in enumerate(own) if 2 * (x + k) > n) for n, own in more)
                total += chance * (p * (1 - q) + q * (1 - p))
            worst = max(worst, total)
    return worst


def most_bits(similarity: Fraction, bits: int = BITS, deviations: float = 4.3) -> int:
    """The Hamming distance that a pair at this similarity exceeds with a chance of 1e-5, by default."""
    p = differ(similarity)
    return math.ceil(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


class Ring:
    """Segments of a fingerprint of `words` 64-bit words for about `texts` texts, and the budgets of the chains from each.

    A start finds a pair if its segment is equal and every chain keeps its budget; `found` is the chance of that at the
    similarity, and `segments` the number of starts that all fail with a chance of MISS.
    """

    def __init__(self, texts: int, similarity: Fraction = SIMILARITY):
        p = differ(similarity)
        self.width = max(4, (texts.bit_length() - 1) // 2)
        self.budgets = [most_bits(similarity, bits, 2.5) for bits in CHAIN]
        alive, before = {0: (1 - p) ** self.width}, 0
        for bits, budget in zip(CHAIN, self.budgets, strict=True):
            now: dict[int, float] = {}
            for had, chance in alive.items():
                for more, weight in enumerate(binomial(bits - before, p)):
                    if had + more <= budget:
                        now[had + more] = now.get(had + more, 0.0) + chance * weight
            alive, before = now, bits
        self.found = sum(alive.values())
        self.segments = math.ceil(math.log(MISS) / math.log1p(-self.found))
        self.words = max(BITS, self.segments * self.width + 63) // 64

    def factors(self) -> np.ndarray:
        return np.random.default_rng(SEED + 1).integers(0, 1 << 63, self.words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def starts(self, rings: list[bytes], chains: bool = True):
        """(keys, chains) from each start, an array of all rings each; equal keys meet."""
        bits = np.unpackbits(np.frombuffer(b"".join(rings), dtype=np.uint8).reshape(len(rings), -1), axis=1)
        places = np.arange(self.width + CHAIN[-1])
        for start in range(self.segments):
            own = bits.take((start * self.width + places) % bits.shape[1], axis=1)
            keys = own[:, : self.width] @ (1 << np.arange(self.width)) | start << 40
            yield keys, np.packbits(np.ascontiguousarray(own[:, self.width :]), axis=1).view(">u8").ravel().astype(np.uint64) if chains else None

    def keeps(self, differences: np.ndarray) -> np.ndarray:
        """Which chains (64 bits after a start's segment, the first one highest) keep all budgets."""
        kept = np.ones(len(differences), dtype=bool)
        for bits, budget in zip(CHAIN, self.budgets, strict=True):
            kept &= np.bitwise_count(differences >> np.uint64(64 - bits)) <= budget
        return kept


def fingerprint(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """A SimHash of as many 64-bit words as `by`: a bit is set if it is set in over half of the shingles' hashes."""
    ones = np.zeros(64 * len(by), dtype=np.int64)
    for at in range(0, len(hashes), 255):
        words = hashes[at : at + 255, None] * by
        words ^= words >> np.uint64(32)
        words *= np.uint64(0x9E3779B97F4A7C15)
        words ^= words >> np.uint64(29)
        # No more than 255 ones to a bit.
        ones += np.unpackbits(words.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes)).view(np.uint64)


def sketches(docs: DataFrame, ring: Ring, width: int = WIDTH) -> DataFrame:
    """(id, row, digest, n, ring) of (id, row, text)."""
    by = ring.factors()

    def run(batches):
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                sets = [shingle_set(t, width) for t in part.column(2).to_pylist()]
                rings = pa.array([fingerprint(s, by).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([digest(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), rings], names=["id", "row", "digest", "n", "ring"])

    return docs.mapInArrow(run, "id bigint, row bigint, digest bigint, n bigint, ring binary")


def tree_pairs(prints: np.ndarray, sizes: np.ndarray, similarity: float, most: int) -> set[tuple[int, int]]:
    """Pairs (i, j), i < j: a spanning forest of the smallest distances up to `most`."""
    k = len(prints)
    far = 64 * prints.shape[1] + 1
    best, parent, open_ = np.full(k, far), np.zeros(k, dtype=np.int64), np.ones(k, dtype=bool)
    pairs, at = set(), 0
    for _ in range(k):
        open_[at] = False
        distance = np.bitwise_count(prints ^ prints[at]).sum(axis=1, dtype=np.int64)
        distance[np.minimum(sizes, sizes[at]) < similarity * np.maximum(sizes, sizes[at]) - 1e-9] = far
        distance[at] = far
        closer = open_ & (distance < best)
        best[closer], parent[closer] = distance[closer], at
        left = np.flatnonzero(open_)
        if not len(left):
            break
        following = int(left[np.argmin(best[left])])
        if best[following] <= most:
            pairs.add((min(int(parent[following]), following), max(int(parent[following]), following)))
        at = following
    return pairs


def met_pairs(ring: Ring, chains: np.ndarray, prints: np.ndarray, sizes: np.ndarray, similarity: float, most: int, nearest: int = NEAREST) -> set[tuple[int, int]]:
    """Pairs (i, j), i < j, of a bucket that keep the budgets of all chains, fit by size and differ in up to `most` bits of their
    prints; of a bucket where a text has over `nearest` partners a forest that connects the same texts, if not more."""
    k = len(chains)
    partners, held, n_held = np.zeros(k, dtype=np.int64), [], 0
    step = max(1, (1 << 16) // k)
    for at in range(0, k, step):
        i, j = np.nonzero(np.bitwise_count(chains[at : at + step, None] ^ chains[at:]) <= ring.budgets[-1])
        later = i < j
        i, j = i[later] + at, j[later] + at
        kept = ring.keeps(chains[i] ^ chains[j])
        kept &= np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j]) - 1e-9
        i, j = i[kept], j[kept]
        kept = np.bitwise_count(prints[i] ^ prints[j]).sum(axis=1, dtype=np.int64) <= most
        i, j = i[kept], j[kept]
        partners += np.bincount(i, minlength=k) + np.bincount(j, minlength=k)
        n_held += len(i)
        if n_held <= nearest * k:
            held.append((i, j))
    if partners.max() <= nearest:
        return {pair for i, j in held for pair in zip(i.tolist(), j.tolist(), strict=True)}
    crowd = np.flatnonzero(partners)
    pairs = tree_pairs(prints[crowd], sizes[crowd], similarity, most)
    return {(int(crowd[i]), int(crowd[j])) for i, j in pairs}


RANKS = [f"rank{k}" for k in range(BITS // 64)]


def on_ring(nodes: DataFrame, ring: Ring) -> DataFrame:
    """(key, node, n, chain, and the RANKS) of nodes (node, n, ring), a row for each start."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                rings = part.column(2).to_pylist()
                keys, chains = (np.concatenate(x) for x in zip(*ring.starts(rings), strict=True))
                ranks = np.frombuffer(b"".join(r[: BITS // 8] for r in rings), dtype=np.int64).reshape(len(rings), -1)
                again = [np.tile(c, ring.segments) for c in (part.column(0).to_numpy(), part.column(1).to_numpy())]
                columns = [keys, *again, chains.view(np.int64), *(np.tile(ranks[:, k], ring.segments) for k in range(len(RANKS)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "node", "n", "chain", *RANKS])

    return nodes.select("node", "n", "ring").mapInArrow(run, ", ".join(f"{c} bigint" for c in ("key", "node", "n", "chain", *RANKS)))


def counted(ring: Ring):
    """(key, m) over batches whose first column is a ring: a row for each key, however many batches there are."""

    def run(batches):
        counts = np.zeros((ring.segments, 1 << ring.width), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                for start, (keys, _) in enumerate(ring.starts(batch.column(0).slice(at, 2000).to_pylist(), chains=False)):
                    counts[start] += np.bincount(keys & (1 << ring.width) - 1, minlength=1 << ring.width)
        starts, own = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own | starts << 40), pa.array(counts[starts, own])], names=["key", "m"])

    return run


def key_counts(nodes: DataFrame, ring: Ring) -> DataFrame:
    """(key, m): texts of a bucket, summed within tasks before they are summed by key."""
    return nodes.select("ring").mapInArrow(counted(ring), "key bigint, m bigint").groupBy("key").agg(F.sum("m").alias("m"))


def spanned(ring: Ring, similarity: Fraction, nearest: int):
    """(a, b) over rows (key, block, node, n, chain, ranks) sorted by key and block."""
    most = most_bits(similarity)

    def run(batches):
        held_key, held = None, []
        out: list[np.ndarray] = []

        def close():
            rows = np.concatenate(held) if held else np.zeros((0, 0), dtype=np.int64)
            held.clear()
            if len(rows) > 1:
                chains, prints = np.ascontiguousarray(rows[:, 2]).view(np.uint64), np.ascontiguousarray(rows[:, 3:]).view(np.uint64)
                pairs = met_pairs(ring, chains, prints, rows[:, 1], float(similarity), most, nearest)
                if pairs:
                    out.append(np.sort(rows[:, 0][np.array(sorted(pairs))], axis=1))

        def flush():
            made = np.concatenate(out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, block = (batch.column(i).to_numpy() for i in range(2))
            rows = np.stack([batch.column(i).to_numpy() for i in range(2, batch.num_columns)], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
                if (key[s], block[s]) != held_key:
                    close()
                    held_key = (key[s], block[s])
                held.append(rows[s:e])
            if sum(map(len, out)) > 10_000:
                yield flush()
        close()
        if out:
            yield flush()

    return run


def sets_of(docs: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, cluster, mine, blocks, set) for each node of wanted (the same, and first): rows of docs (id, text) whose id is first hold it."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingle_set(t, width) for t in part.column(4).to_pylist()]
                right = [i for i, (s, d) in enumerate(zip(sets, part.column(0).to_pylist(), strict=True)) if digest(s) == d]
                values = pa.array([pa.array(sets[i].view(np.int64)) for i in right], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part.column(k).take(pa.array(right, pa.int64())) for k in range(4)), values], names=["node", "cluster", "mine", "blocks", "set"])

    texts = docs.join(wanted, docs["id"] == wanted["first"]).select("node", "cluster", "mine", "blocks", "text")
    return texts.mapInArrow(run, "node bigint, cluster bigint, mine bigint, blocks bigint, set array<bigint>")


def joined(sets: list[np.ndarray], sides: np.ndarray, similarity: Fraction) -> list[tuple[int, int]]:
    """Links (i, j) that connect whatever is linked among the sets; if both sides, 0 and then 1, are there, between them alone."""
    k, sizes, both = len(sets), np.array([len(s) for s in sets]), sides[0] != sides[-1]
    _, places, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = np.repeat(np.arange(k), sizes)[np.argsort(places, kind="stable")]
    first, ends = np.cumsum(holders) - holders, np.cumsum(sizes)
    label, pairs = np.arange(k), []
    step = max(1, (1 << 20) // k)
    for i in range(int((sides == 0).sum()) if both else k):
        others = slice(int((sides == 0).sum()) if both else i + 1, k)
        if (label[others] == label[i]).all():
            continue
        own = places[ends[i] - sizes[i] : ends[i]]
        own = own[holders[own] > 1]
        common = np.zeros(k, dtype=np.int64)
        for at in range(0, len(own), step):
            m, start = holders[own[at : at + step]], first[own[at : at + step]]
            common += np.bincount(held[np.repeat(start - np.cumsum(m) + m, m) + np.arange(m.sum())], minlength=k)
        like = common * similarity.denominator >= (sizes + sizes[i] - common) * similarity.numerator
        for j in (np.flatnonzero(like[others]) + others.start).tolist():
            if label[j] != label[i]:
                pairs.append((i, j))
                label[label == label[j]] = label[i]
    return pairs


def linked(similarity: Fraction):
    """(a, b) over rows (cluster, block, side, node, set) sorted by cluster, block and side."""

    def run(batches):
        held_key, held = None, {}
        out: list[tuple[int, int]] = []

        def close():
            if len(held) > 1:
                nodes, rows = list(held), list(held.values())
                out.extend((nodes[i], nodes[j]) for i, j in joined([s for _, s in rows], np.array([side for side, _ in rows]), similarity))
            held.clear()

        def flush():
            made = np.array(out, dtype=np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

        for batch in batches:
            values, sizes = batch.column(4).flatten().to_numpy(), batch.column(4).value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            for k, (cluster, block, side, node) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)):
                if (cluster, block) != held_key:
                    close()
                    held_key = (cluster, block)
                # A node may come in several rows of one id and text.
                held[node] = (side, values[ends[k] - sizes[k] : ends[k]])
            if len(out) > 10_000:
                yield flush()
        close()
        yield flush()

    return run


def verified(docs: DataFrame, clusters: DataFrame, width: int, similarity: Fraction, cluster: int, elements: int) -> DataFrame:
    """(a, b) of at least the similarity that connect whatever is linked in a cluster of clusters (node, first, n, cluster)."""
    parts = F.greatest(F.ceil(F.count("*") / cluster), F.ceil(F.sum("n") / elements))
    large = written(clusters.groupBy("cluster").agg(parts.alias("blocks")).filter("blocks > 1").select((F.col("cluster") + 0).alias("__c"), "blocks"), "near-crowds")
    none = large.isEmpty()
    dealt = clusters.withColumn("blocks", F.lit(1).cast("long")) if none else clusters.join(large, F.col("cluster") == F.col("__c"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    sets = sets_of(docs, dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks"))), width)
    other = F.lit(0).cast("long") if none else F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    placed = sets.withColumn("other", other).select("cluster", (high * (high + 1) / 2 + low).cast("long").alias("block"), (F.col("mine") > F.col("other")).cast("long").alias("side"), "node", "set")
    sorted_rows = placed.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "side")
    return sorted_rows.mapInArrow(linked(similarity), "a bigint, b bigint")


def links(docs: DataFrame, nodes: DataFrame, ring: Ring, width: int = WIDTH, similarity: Fraction = SIMILARITY, nearest: int = NEAREST, bucket: int = BUCKET, cluster: int = CLUSTER, elements: int = ELEMENTS) -> DataFrame:
    """(node, component) for nodes of nodes (node, first, n, ring) that link with others."""
    rows = on_ring(nodes, ring)
    large = written(key_counts(nodes, ring).filter(F.col("m") > bucket), "near-large")
    # A bucket over the limit is dealt as pairs of blocks; every block meets every other, and itself.
    block = F.lit(0).cast("long")
    if not large.isEmpty():
        blocks = F.coalesce(F.ceil(F.col("m") / bucket).cast("long"), F.lit(1))
        placed = rows.join(large, "key", "left").withColumn("__mine", F.pmod(F.xxhash64("node"), blocks))
        rows = placed.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        low, high = F.least("__mine", "__other"), F.greatest("__mine", "__other")
        block = (high * (high + 1) / 2 + low).cast("long")
    placed = rows.select("key", block.alias("block"), "node", "n", "chain", *RANKS)
    dealt = placed.repartition("key", "block").sortWithinPartitions("key", "block")
    met = connected_components(dealt.mapInArrow(spanned(ring, similarity, nearest), "a bigint, b bigint"))
    clusters = written(nodes.select("node", "first", "n").join(met.withColumnRenamed("component", "cluster"), "node"), "near-clusters")
    return connected_components(verified(docs, clusters, width, similarity, cluster, elements))


def grouped(docs: DataFrame, id_column: str, text: str, width: int, similarity: Fraction, **options) -> DataFrame:
    """(id, row, component, component_id), a row for each document with an id; row is a hash of its columns."""
    own = docs.select(F.col(id_column).cast("long").alias("id"), row_hash(docs).alias("row"), F.col(text).cast("string").alias("text")).filter("id is not null")
    ring = Ring(own.count(), similarity)
    made = written(sketches(own, ring, width), "near-sketches")
    nodes = written(made.groupBy(F.col("digest").alias("node")).agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("ring").alias("ring")), "near-nodes")
    parts = links(own.select("id", "text"), nodes, ring, width, similarity, **options)
    named = nodes.join(parts, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    least = named.groupBy(F.col("component").alias("__c")).agg(F.min("first").alias("component_id"))
    named = named.join(least.select((F.col("__c") + 0).alias("__c"), "component_id"), F.col("component") == F.col("__c")).select((F.col("node") + 0).alias("__digest"), "component", "component_id")
    named = written(named, "near-named")
    return made.join(named, F.col("digest") == F.col("__digest")).select("id", "row", "component", "component_id")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: Fraction = SIMILARITY, **options) -> DataFrame:
    """(id, component_id), a row for each document with an id; component_id is the smallest id of its group."""
    return grouped(docs, id_column, text, width, similarity, **options).select("id", "component_id")


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: Fraction = SIMILARITY, **options) -> DataFrame:
    """docs without all but one row of each group: of the rows with its smallest id that whose columns hash lowest.

    Rows without an id stay. Rows are told apart by id and a hash of their columns, so rows that share an id but not a
    text are judged by their own groups, and of rows that agree in every column one stays.
    """
    rows = written(grouped(docs, id_column, text, width, similarity, **options).select("id", "row", "component"), "near-rows")
    first = rows.groupBy(F.col("component").alias("__c")).agg(F.min(F.struct("id", "row")).alias("first"))
    first = written(first.select((F.col("__c") + 0).alias("__c"), "first"), "near-first")
    gone = rows.join(first, F.col("component") == F.col("__c")).filter(F.struct("id", "row") != F.col("first")).select(F.col("id").alias("__id"), F.col("row").alias("__row")).distinct()
    own = docs.withColumns({"__id": F.col(id_column).cast("long"), "__row": row_hash(docs)})
    kept = own.filter("__id is not null").join(gone, ["__id", "__row"], "left_anti")
    # Rows that agree in every column: of each such set that stays, all but one go.
    same = written(rows.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(F.count("*").alias("m")).filter("m > 1").select("__id", "__row"), "near-same")
    if not same.isEmpty():
        kept = kept.join(same, ["__id", "__row"], "left_anti").unionByName(kept.join(same, ["__id", "__row"], "left_semi").dropDuplicates(["__id", "__row"]))
    return kept.select(*docs.columns).unionByName(own.filter("__id is null").select(*docs.columns))
