"""Passages of benchmark items within documents, found by winnowed fingerprints and extended to whole windows.

Words are lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII. A window is SPAN consecutive words of
an item, or all words of a shorter item; a document word is hit if it lies within an occurrence of a window.

Winnowing: each window of SPAN words holds SPAN - GRAM + 1 grams of GRAM words, and the one with the lowest hash (of equal
ones the last) is its fingerprint. The choice depends on the window's words only, so wherever a document holds a window
of an item, both chose the same gram, and no shared passage of SPAN words goes unseen. Neighbouring windows mostly choose
the same gram, so about one gram in three is looked up. Shorter items have windows of their own length, with the same rule
for their grams.

Fingerprints of documents stay in the task that reads them: a bitmap of the benchmark's fingerprints (MAX_BITS / 8 bytes
at most, whatever the size of the benchmark) tells which may be shared, and only those leave it, each with the windows that
chose it. These extensions meet the benchmark's windows in a join on their words, so that hashes decide nothing. A window
that many documents hold is one row of the other side, and rows of a hot window are split among tasks.

Items travel as sets: windows with the same items share one list, and documents with the same lists share their union, so a
passage that many items and many documents hold costs a row for each of them and not for each pair.

Defined cases: a null or empty text has no words, and an item without words no windows; texts are read whole, in pieces of
bounded size; rows with the same id are documents of their own, items with the same id one item; item ids are compared as
strings, and null ids of items are left out; an empty table on either side gives no hits; other columns aren't read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.exact_dedup import BUCKET, filter_bits
from heronlake.llm.support import written

#: Words of a window, and of the grams that are hashed.
SPAN, GRAM = 10, 6
MAX_BITS = 1 << 29
#: Bytes of text that are cut into words at once.
PIECE = 1 << 20
#: Bytes of a word that are hashed column by column; the words that are longer are hashed one by one.
COLUMNS = 48

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=np.int8)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = 1
_NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of some texts: where they are in the joined lower-cased bytes, whose they are, and their hashes."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        low = _LOWER[joined]
        edges = np.flatnonzero(np.diff(_IS_WORD[low], prepend=0, append=0))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.bytes = low.tobytes()
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.counts = np.diff(np.searchsorted(self.starts, firsts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.of = np.repeat(np.arange(len(texts)), self.counts)
        self.hashes = self._hash(low)

    def _hash(self, low: np.ndarray) -> np.ndarray:
        sizes = self.ends - self.starts
        order = np.argsort(-sizes, kind="stable")
        starts, h = self.starts[order], np.zeros(len(sizes), dtype=np.uint64)
        longer = len(sizes) - np.searchsorted(sizes[order][::-1], np.arange(COLUMNS + 1), side="right")
        for j in range(COLUMNS):
            n = longer[j]
            if not n:
                break
            h[:n] = (h[:n] + low[starts[:n] + j] + np.uint64(1)) * _STEP
            h[:n] ^= h[:n] >> np.uint64(31)
        for i in range(longer[COLUMNS]):
            at = order[i]
            h[i] = xxhash.xxh64_intdigest(self.bytes[self.starts[at] : self.ends[at]])
        found = np.empty_like(h)
        found[order] = h
        return found

    def fingerprints(self, size: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first words of all windows of `size` words, the word where the gram that each chose starts, its hash)."""
        gram = min(gram, size)
        if len(self.of) < size:
            return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),)
        n = len(self.of) - gram + 1
        grams = np.full(n, size, dtype=np.uint64)
        for j in range(gram):
            grams = _mixed(grams + self.hashes[j : j + n])
        n = len(self.of) - size + 1
        windows = np.flatnonzero(self.of[:n] == self.of[size - 1 :])
        last = size - gram
        best, chosen = grams[last : last + n].copy(), np.full(n, last)
        for j in range(last - 1, -1, -1):
            lower = grams[j : j + n] < best
            best = np.where(lower, grams[j : j + n], best)
            chosen[lower] = j
        return windows, windows + chosen[windows], best[windows]

    def window(self, first: int, size: int) -> str:
        starts, ends = self.starts[first : first + size].tolist(), self.ends[first : first + size].tolist()
        return b" ".join([self.bytes[a:b] for a, b in zip(starts, ends, strict=True)]).decode()


class Benchmark:
    """What tells a task which fingerprints the items may have: a bitmap and the sizes of windows."""

    def __init__(self, bits: int, bitmap: np.ndarray, sizes: list[int]):
        self.shift, self.bitmap, self.sizes = np.uint64(64 - bits.bit_length() + 1), bitmap, sizes

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def candidates(self, words: Words):
        """(first word, size) of the windows whose fingerprint may be an item's."""
        for size in self.sizes:
            windows, chosen, hashes = words.fingerprints(size)
            # Neighbours mostly chose the same gram: each is looked up once.
            fresh = np.flatnonzero(np.diff(chosen, prepend=-1))
            known = np.repeat(self.holds(hashes[fresh]), np.diff(np.append(fresh, len(chosen))))
            yield from ((int(i), size) for i in windows[known])


def _pieces(data: bytes, size: int = PIECE):
    """data in pieces of about `size` bytes that end where a word does."""
    at = 0
    while len(data) - at > size:
        end = _NO_WORD.search(data, at + size)
        end = end.start() if end else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def find_in(texts: list[bytes], known: Benchmark, piece: int = PIECE) -> list[tuple[int, dict[str, list[int]]]]:
    """(number of words, window -> where it starts) of each text, for windows whose fingerprint may be an item's."""
    out: list = [None] * len(texts)
    group: list[int] = []

    def settle() -> None:
        words = Words([texts[k] for k in group])
        for i, k in enumerate(group):
            out[k] = (int(words.counts[i]), {})
        for first, size in known.candidates(words):
            i = words.of[first]
            out[group[i]][1].setdefault(words.window(first, size), []).append(first - int(words.first[i]))
        group.clear()

    waiting = 0
    for k, text in enumerate(texts):
        if len(text) > piece:
            out[k] = _find_in_long(text, known, piece)
            continue
        group.append(k)
        waiting += len(text)
        if waiting > piece:
            settle()
            waiting = 0
    if group:
        settle()
    return out


def _find_in_long(text: bytes, known: Benchmark, piece: int) -> tuple[int, dict[str, list[int]]]:
    """The same for one text by pieces; the last words of a piece stand before the next one, so no window is cut."""
    seen, tail, found = 0, b"", {}
    for part in _pieces(text, piece):
        words = Words([tail + b" " + part])
        carried = len(tail.split())
        for first, size in known.candidates(words):
            if first + size > carried:
                found.setdefault(words.window(first, size), []).append(seen - carried + first)
        n = len(words.starts)
        seen += n - carried
        tail = words.window(max(0, n - SPAN + 1), min(n, SPAN - 1)).encode()
    return seen, found


def _texts(column: pa.Array, size: int = 200):
    for at in range(0, len(column), size):
        yield at, [(t or "").encode("utf-8", "surrogatepass") for t in column.slice(at, size).to_pylist()]


def item_windows(benchmark: DataFrame, id_column: str = "item_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """(item, size, window, fingerprint): the distinct windows of each item."""

    def run(batches):
        for batch in batches:
            for at, texts in _texts(batch.column(1), 100):
                words, rows = Words(texts), {}
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                for size in sorted({min(span, int(n)) for n in words.counts} - {0}):
                    whole = words.counts == size if size < span else words.counts >= span
                    windows, _, hashes = words.fingerprints(size)
                    mine = whole[words.of[windows]]
                    for first, h in zip(windows[mine].tolist(), hashes[mine].view(np.int64).tolist(), strict=True):
                        rows[ids[words.of[first]], words.window(first, size)] = (size, h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in rows], pa.string()), pa.array([v[0] for v in rows.values()], pa.int32()), pa.array([k[1] for k in rows], pa.string()), pa.array([v[1] for v in rows.values()], pa.int64())],
                    names=["item", "size", "window", "fingerprint"],
                )

    items = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text)).filter("item IS NOT NULL")
    return items.mapInArrow(run, "item string, size int, window string, fingerprint bigint")


def _known(windows: DataFrame, max_bits: int) -> Benchmark:
    """The bitmap comes by way of the driver; it has max_bits / 8 bytes at most. So many sizes as SPAN, at most."""
    bits = filter_bits(windows.count(), 32, max_bits)
    shift = 64 - bits.bit_length() + 1
    at = windows.select(F.expr(f"shiftrightunsigned(fingerprint, {shift})").alias("at"))
    maps = at.groupBy(F.expr(f"at div {BUCKET}").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(at % {BUCKET})").alias("bitmap"))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in maps.toLocalIterator():
        part = np.frombuffer(row["bitmap"], dtype=np.uint8)
        bitmap[row["bucket"] * (BUCKET // 8) :][: len(part)] = part
    return Benchmark(bits, bitmap, sorted(r["size"] for r in windows.select("size").distinct().collect()))


def _candidates(docs: DataFrame, id_column: str, text: str, known: Benchmark) -> DataFrame:
    """(id, row, n_words, found): the windows of each document that may be an item's, with where they start."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kind = pa.list_(pa.struct([("window", pa.string()), ("at", pa.list_(pa.int64()))]))

    def run(batches):
        # A number for each row; the rows are written once, so it needn't be the same in another attempt.
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, texts in _texts(batch.column(1)):
                found = find_in(texts, shared.value)
                rows = pa.array(range(row, row + len(texts)), pa.int64())
                row += len(texts)
                lists = pa.array([[{"window": w, "at": p} for w, p in f.items()] for _, f in found], kind)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), rows, pa.array([n for n, _ in found], pa.int64()), lists], names=["id", "row", "n_words", "found"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text))
    schema = T.StructType([source.schema["id"], *T._parse_datatype_string("row bigint, n_words bigint, found array<struct<window:string,at:array<bigint>>>").fields])
    return source.mapInArrow(run, schema)


def merge_spans(hits: DataFrame) -> DataFrame:
    """(row, spans, sets) from (row, hits, sets): the union of a document's windows as runs of words."""

    def run(batches):
        for batch in batches:
            spans = []
            for hits in batch.column(1).to_pylist():
                starts = np.concatenate([np.asarray(h["at"], dtype=np.int64) for h in hits])
                ends = np.concatenate([np.asarray(h["at"], dtype=np.int64) + h["size"] for h in hits])
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], np.maximum.accumulate(ends[order])
                new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
                stops = ends[np.append(new[1:] - 1, len(ends) - 1)]
                spans.append([{"start": a, "end": b} for a, b in zip(starts[new].tolist(), stops.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), batch.column(2)], names=["row", "spans", "sets"])

    return hits.mapInArrow(run, "row bigint, spans array<struct<start:bigint,end:bigint>>, sets array<string>")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, n_words, spans, items): a row for each document, with the runs of words that are hit (from start up to end) and
    the ids of the items with occurring windows, sorted as strings."""
    windows = written(item_windows(benchmark, item_id, item_text), "benchmark-windows")
    rows = written(_candidates(docs, id_column, text, _known(windows, max_bits)), "benchmark-candidates")
    # A set of items for each window; windows of one passage share it.
    of_window = windows.groupBy("window", "size").agg(F.sort_array(F.collect_set("item")).alias("items"))
    of_window = written(of_window.withColumn("set", F.sha2(F.to_json("items"), 256)), "benchmark-sets")
    sets = of_window.select(F.col("set").alias("__set"), "items").distinct()
    words = of_window.select(F.col("window").alias("__window"), "size", "set")
    met = rows.select("row", F.inline("found")).join(words, F.col("window") == F.col("__window"))
    # What is gathered of a document is bounded by its own words.
    met = met.groupBy("row").agg(F.collect_list(F.struct("at", "size")).alias("hits"), F.sort_array(F.collect_set("set")).alias("sets"))
    spans = merge_spans(met).withColumn("union", F.sha2(F.array_join("sets", ","), 256))
    spans = written(spans, "benchmark-spans")
    unions = spans.select("union", "sets").distinct().select("union", F.explode("sets").alias("set")).join(sets, F.col("set") == F.col("__set"))
    unions = unions.select(F.col("union").alias("__union"), F.explode("items").alias("item")).groupBy("__union").agg(F.sort_array(F.collect_set("item")).alias("items"))
    unions = written(unions, "benchmark-unions")
    named = spans.join(unions, F.col("union") == F.col("__union")).select(F.col("row").alias("__row"), "spans", "items")
    none = "array<struct<start:bigint,end:bigint>>"
    return rows.select("id", "row", "n_words").join(named, F.col("row") == F.col("__row"), "left").select(
        "id", "n_words", F.coalesce("spans", F.array().cast(none)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
