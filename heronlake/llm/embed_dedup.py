"""Embedding near-deduplication by sorted projection passes.

Each pass hashes a vector by the signs of random projections; the signs, concatenated, order the vectors of a label
lexicographically. Every vector is compared with the next `window` ones in that order, pairs whose cosine reaches the
threshold are links, and the links of all passes are united. The length of a label's codes follows from its size and
from the angles within a sample of it: tight labels split less by a sign and get longer codes. Its number of passes
follows from that length, so that a pair at the threshold is missed with a chance under `miss`, if the sample shows how
crowded the surroundings of its vectors are. A crowd of under about one in SAMPLE of its label may escape the sample.

A label of up to `space_bytes` is dealt to one task, which makes all its passes there: its vectors travel once. A larger
one is spread: its codes alone are sorted over all tasks, and each pass then brings the vectors together in blocks, which
overlap by a window, so the comparisons don't depend on how rows are partitioned.

Windows are bounded, and a dense group holds more neighbours than a window. So the passes only have to connect the
group: within every component all links are then counted exactly, block by block. Identical vectors are one node from
the start, however many there are, told by 128 bits of hash.

Defined cases: a null label, a null vector, or one that is zero or holds a null or non-finite component links with
nothing; vectors of different lengths don't link; rows that repeat an id and a vector are separate vectors that link;
a null id can't name a component (null if a component has no other); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.components import connected_components
from heronlake.llm.support import written

SIGNS = 32
WINDOW = 64
BLOCK = 4096
#: Vectors of a label whose angles are measured.
SAMPLE = 1000
#: Vectors of a block when a component's links are counted.
PART = 2048
#: Bytes of the distinct vectors of a label that one task takes.
SPACE_BYTES = 64 << 20
NO_ID = (1 << 63) - 1


def planes(width: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).standard_normal((width, n))


def read_vectors(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, space, key, vec): space is the label and length within which vectors are compared, null for vectors that
    link with nothing; vec holds little-endian floats, or doubles if the column does; equal keys mean equal vectors."""
    single = isinstance(rows.schema[vector].dataType.elementType, T.FloatType)

    def run(batches):
        for batch in batches:
            ids, lists, labels = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum([n or 0 for n in lists.value_lengths().to_pylist()])
            spaces, keys, data = [], [], []
            for i, name in enumerate(labels):
                v = values[ends[i - 1] if i else 0 : ends[i]] + 0.0
                if name is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    spaces.append(None), keys.append(None), data.append(None)
                    continue
                # Squares of doubles might overflow or vanish; those of floats don't, as doubles.
                raw = v.astype("<f4").tobytes() if single else (v / np.abs(v).max()).astype("<f8").tobytes()
                space = f"{len(v)}/{name}"
                spaces.append(space), data.append(raw), keys.append(hashlib.md5(space.encode() + b"\0" + raw).digest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(spaces, pa.string()), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], names=["id", "space", "key", "vec"])

    chosen = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector), F.col(label).cast("string"))
    return chosen.mapInArrow(run, "id bigint, space string, key binary, vec binary")


def n_passes(signs: float, threshold: float, miss: float) -> int:
    """Enough passes to miss a pair at the threshold with a chance under `miss`, if so many signs narrow the order to a window."""
    meet = (1 - math.acos(threshold) / math.pi) ** max(1.0, signs)
    return max(4, math.ceil(math.log(miss) / math.log1p(-meet)))


def signs_needed(x: np.ndarray, size: int, threshold: float, window: int) -> float:
    """Signs after which at most half a window of a label's `size` vectors is expected beside any of the sample x of unit
    vectors, besides those that link with it."""
    cosines = np.clip(x @ x.T, -1, 1)
    same, far = 1 - np.arccos(cosines) / math.pi, cosines < threshold

    def crowd(n: float) -> float:
        return size * float((same**n * far).mean(axis=1).max())

    low, high = 0.0, 1.0
    while crowd(high) > window / 2:
        low, high = high, 2 * high
    while high - low > 0.01:
        middle = (low + high) / 2
        low, high = (middle, high) if crowd(middle) > window / 2 else (low, middle)
    return high


def plan(x: np.ndarray, size: int, threshold: float, window: int, miss: float) -> tuple[int, int]:
    """(passes, signs of a code) for a label of `size` vectors, from a sample x of them."""
    signs = signs_needed(x, size, threshold, window)
    return n_passes(signs, threshold, miss), max(SIGNS, math.ceil(signs) + 8)


class Vectors:
    """Vectors as they were stored; unit vectors are made for some rows at a time."""

    def __init__(self, space: str, data: pa.ChunkedArray | list[bytes]):
        raw = b"".join(data) if isinstance(data, list) else b"".join(memoryview(x.as_buffer()) for x in data)
        width = int(space.partition("/")[0])
        kind = "<f4" if len(raw) == 4 * width * len(data) else "<f8"
        self.stored = np.frombuffer(raw, dtype=kind).reshape(len(data), width)

    def units(self, at=slice(None)) -> np.ndarray:
        x = self.stored[at].astype(np.float64)
        return x / np.sqrt((x * x).sum(1))[:, None]

    def __len__(self) -> int:
        return len(self.stored)


def codes(x: Vectors, at: int, signs: int, all_planes: np.ndarray, step: int = 8192) -> np.ndarray:
    """The codes of a pass, as rows of big-endian 64-bit words."""
    own = all_planes[:, at * signs : (at + 1) * signs]
    out = np.zeros((len(x), -(-signs // 64) * 8), dtype=np.uint8)
    for begin in range(0, len(x), step):
        out[begin : begin + step, : -(-signs // 8)] = np.packbits(x.units(slice(begin, begin + step)) @ own > 0, axis=1)
    return out.view(">u8")


def window_links(x: Vectors, order: np.ndarray, threshold: float, window: int, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of places in the order, at most a window apart, that link."""
    low, high = [], []
    for at in range(0, len(order) - 1, step):
        y = x.units(order[at : at + step + window])
        i, j = np.nonzero(y[:step] @ y.T >= threshold)
        near = (j > i) & (j - i <= window)
        low.append(i[near] + at), high.append(j[near] + at)
    return (np.concatenate(low), np.concatenate(high)) if low else (np.zeros(0, np.int64),) * 2


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest that links reach."""
    parts = np.arange(n)
    while True:
        before = parts.copy()
        least = np.minimum(parts[a], parts[b])
        np.minimum.at(parts, a, least)
        np.minimum.at(parts, b, least)
        while (parts != parts[parts]).any():
            parts = parts[parts]
        if (parts == before).all():
            return parts


def local_counts(x: Vectors, parts: np.ndarray, n: np.ndarray, threshold: float, part: int) -> np.ndarray:
    """For each node the vectors in other nodes of its component that it links with."""
    out = np.zeros(len(x), dtype=np.int64)
    order = np.argsort(parts, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
        if len(own) < 2:
            continue
        # Vectors that link are at most `reach` apart on any line, so only blocks that near are compared.
        ends = x.units(own[[0, -1]])
        direction = (ends[1] - ends[0]) / (np.linalg.norm(ends[1] - ends[0]) or 1.0)
        line = np.concatenate([x.units(own[at : at + 8192]) @ direction for at in range(0, len(own), 8192)])
        own, line = own[np.argsort(line)], np.sort(line)
        reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
        for at in range(0, len(own), part):
            mine = own[at : at + part]
            low, high = np.searchsorted(line, [line[at] - reach, line[min(at + part, len(own)) - 1] + reach])
            for begin in range(int(low), int(high), part):
                others = own[begin : min(begin + part, int(high))]
                hit = x.units(mine) @ x.units(others).T >= threshold
                hit &= mine[:, None] != others[None, :]
                out[mine] += hit @ n[others]
    return out


def solve_space(threshold: float, window: int, miss: float, part: int, seed: int):
    """(node, least, others) for the nodes of a label, from rows (space, node, first, n, vec)."""

    def run(rows: pa.Table) -> pa.Table:
        space = rows.column("space")[0].as_py()
        rows = rows.sort_by("node")
        x = Vectors(space, rows.column("vec"))
        size = len(x)
        chosen = np.sort(np.random.default_rng(seed).permutation(size)[:SAMPLE])
        passes, signs = plan(x.units(chosen), size, threshold, window, miss)
        made = planes(x.stored.shape[1], passes * signs, seed)
        a, b = [], []
        for p in range(passes):
            words = codes(x, p, signs, made)
            order = np.lexsort(words.T[::-1])
            i, j = window_links(x, order, threshold, window)
            i, j = order[i], order[j]
            a.append(np.minimum(i, j)), b.append(np.maximum(i, j))
        pairs = np.unique(np.concatenate(a) * size + np.concatenate(b))
        parts = local_components(size, pairs // size, pairs % size)
        others = local_counts(x, parts, rows.column("n").to_numpy(), threshold, part)
        first = np.array([NO_ID if v is None else v for v in rows.column("first").to_pylist()], dtype=np.int64)
        least = np.full(size, NO_ID)
        np.minimum.at(least, parts, first)
        return pa.table({"node": rows.column("node"), "least": pa.array(least[parts], pa.int64(), mask=least[parts] == NO_ID), "others": pa.array(others, pa.int64())})

    return run


def plans(classes: DataFrame, threshold: float, window: int, miss: float) -> DataFrame:
    """(space, passes, signs) for each space of (space, size, node, vec)."""
    chosen = classes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) * F.col("size") <= F.lit(SAMPLE << 30))

    def run(rows: pa.Table) -> pa.Table:
        space = rows.column("space")[0].as_py()
        passes, signs = plan(Vectors(space, rows.column("vec")).units(), rows.column("size")[0].as_py(), threshold, window, miss)
        return pa.table({"space": [space], "passes": pa.array([passes], pa.int32()), "signs": pa.array([signs], pa.int32())})

    return chosen.select("space", "size", "vec").groupBy("space").applyInArrow(run, "space string, passes int, signs int")


def pass_links(classes: DataFrame, planned: DataFrame, threshold: float, window: int, block: int, seed: int) -> DataFrame:
    """(a, b) between nodes that some pass brings within a window of each other; a spanning forest for each block."""
    names, kinds = ["pass", "space", "code", "node"], [pa.int32(), pa.string(), pa.binary(), pa.int64()]

    def hash_all(batches):
        made: dict[tuple, np.ndarray] = {}
        for batch in batches:
            nodes, spaces, data, passes, signs = (c.to_pylist() for c in batch.columns)
            for i, (node, space, raw, n, length) in enumerate(zip(nodes, spaces, data, passes, signs, strict=True)):
                x = Vectors(space, [raw])
                if (kind := (x.stored.shape[1], n * length)) not in made:
                    made[kind] = planes(*kind, seed)
                yield _batch([(p, space, codes(x, p, length, made[kind]).tobytes(), node) for p in range(n)], names, kinds)

    # The plans are one row for each label of over SPACE_BYTES.
    with_plan = classes.join(planned.withColumnRenamed("space", "__space"), F.col("space") == F.col("__space"))
    coded = with_plan.select("node", "space", "vec", "passes", "signs").mapInArrow(hash_all, "pass int, space string, code binary, node bigint")
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["pass", "space", "code", "node"]

    def number(batches):
        from pyspark import TaskContext

        at, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array([task] * m, pa.int32()), pa.array(range(at, at + m), pa.int64())], names=["pass", "space", "node", "task", "at"])
            at += m

    coded = written(coded, "vector-codes")
    ranged = written(coded.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(number, "pass int, space string, node bigint, task int, at bigint"), "vector-order")
    # One row for each task.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("task").count().select("task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    placed = ranged.join(F.broadcast(bases), "task").withColumn("rank", F.col("base") + F.col("at"))
    home = F.expr(f"rank div {block}")
    placed = placed.withColumn("block", F.explode(F.when(F.col("rank") % block >= block - window, F.array(home, home + 1)).otherwise(F.array(home))))
    with_vectors = placed.select("block", "rank", "pass", "space", "node").join(classes.select(F.col("node").alias("__node"), "vec"), F.col("node") == F.col("__node"))

    def compare(batches):
        held: list[tuple] = []

        def close():
            out = []
            keys = [(r[2], r[3]) for r in held]
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                a, b = window_links(Vectors(held[s][3], [r[5] for r in held[s:e]]), np.arange(e - s), threshold, window)
                parts = local_components(e - s, a, b)
                out += [(held[s + i][4], held[s + int(p)][4]) for i, p in enumerate(parts) if p != i]
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    if links := close():
                        yield _batch(links, ["a", "b"], [pa.int64()] * 2)
                held.append(row)
        if held and (links := close()):
            yield _batch(links, ["a", "b"], [pa.int64()] * 2)

    dealt = with_vectors.repartition(tasks, "block").sortWithinPartitions("block", "rank").select("block", "rank", "pass", "space", "node", "vec")
    return dealt.mapInArrow(compare, "a bigint, b bigint")


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def count_links(members: DataFrame, threshold: float, part: int = PART) -> DataFrame:
    """(node, others): vectors in other nodes of the same component that a node's vectors link with, from members of
    (component, space, node, n, vec)."""
    sizes = members.groupBy("component").agg(F.count("*").alias("m")).filter("m > 1")
    parts = F.ceil(F.col("m") / part).cast("int")
    placed = members.join(sizes, "component").withColumn("mine", F.pmod(F.xxhash64("node"), parts).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    paired = paired.select("component", low.alias("low"), high.alias("high"), (F.col("mine") == low).alias("is_low"), "node", "n", "space", "vec")

    def count(rows: pa.Table) -> pa.Table:
        x = Vectors(rows.column("space")[0].as_py(), rows.column("vec")).units()
        n, first = rows.column("n").to_numpy(), rows.column("is_low").to_numpy()
        others = np.zeros(len(x), dtype=np.int64)
        if rows.column("low")[0].as_py() == rows.column("high")[0].as_py():
            hit = x @ x.T >= threshold
            np.fill_diagonal(hit, False)
            others = hit @ n
        else:
            a, b = np.flatnonzero(first), np.flatnonzero(~first)
            hit = x[a] @ x[b].T >= threshold
            others[a], others[b] = hit @ n[b], hit.T @ n[a]
        return pa.table({"node": rows.column("node"), "others": pa.array(others, pa.int64())})

    return paired.groupBy("component", "low", "high").applyInArrow(count, "node bigint, others bigint").groupBy("node").agg(F.sum("others").alias("others"))


def spread_spaces(classes: DataFrame, threshold: float, window: int, block: int, part: int, miss: float, seed: int) -> DataFrame:
    """(node, least, others) for the nodes of labels that no single task takes."""
    planned = written(plans(classes, threshold, window, miss), "vector-plans")
    links = pass_links(classes, planned, threshold, window, block, seed)
    parts = written(connected_components(links), "vector-components")
    members = parts.join(classes, "node").select("component", "node", "first", "n", "space", "vec")
    counted = count_links(members.drop("first"), threshold, part)
    named = members.groupBy("component").agg(F.min("first").alias("least")).select((F.col("component") + 0).alias("__c"), "least")
    of_node = parts.join(named, F.col("component") == F.col("__c")).select("node", "least").join(counted, "node", "left")
    return classes.select("node", "first").join(of_node, "node", "left").select("node", F.coalesce("least", "first").alias("least"), F.coalesce("others", F.lit(0)).alias("others"))


def embedding_groups(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98, window: int = WINDOW,
    block: int = BLOCK, part: int = PART, miss: float = 1e-4, seed: int = 7, space_bytes: int = SPACE_BYTES,
) -> DataFrame:
    """(id, n_links, component_id, kept), a row for each vector."""
    vectors = written(read_vectors(rows, id_column, vector, label), "vectors")
    usable = vectors.filter("key is not null")
    made = usable.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.first("space").alias("space"), F.first("vec").alias("vec"))
    made = written(made.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    # One row for each label, with its bytes.
    sizes = made.groupBy("space").agg(F.count("*").alias("size"), F.sum(F.octet_length("vec").cast("long")).alias("bytes"))
    sizes = written(sizes.select(F.concat("space", F.lit("")).alias("__space"), "size", "bytes"), "vector-spaces")
    classes = made.join(sizes, F.col("space") == F.col("__space")).drop("__space")
    small = classes.filter(F.col("bytes") <= space_bytes).select("space", "node", "first", "n", "vec")
    of_node = small.groupBy("space").applyInArrow(solve_space(threshold, window, miss, part, seed), "node bigint, least bigint, others bigint")
    if not sizes.filter(F.col("bytes") > space_bytes).isEmpty():
        of_node = of_node.union(spread_spaces(classes.filter(F.col("bytes") > space_bytes).drop("bytes"), threshold, window, block, part, miss, seed))
    of_node = written(of_node, "vector-nodes")
    named = made.select(F.col("key").alias("__key"), "node", "n").join(of_node, "node").select("__key", "n", "least", "others")
    joined = vectors.select("id", "key").join(named, F.col("key") == F.col("__key"), "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("least"))
    n_links = F.coalesce(F.col("others") + F.col("n") - 1, F.lit(0)).cast("long")
    return joined.select("id", n_links.alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
