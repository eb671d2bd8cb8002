"""Removal of long byte strings that occur in an earlier document, by run-length compressed indexes.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id. Texts are UTF-8
bytes, read whole; matches stay within documents.

An index of all earlier documents can't stand in one task, and streaming every document through the index of every
block of documents takes quadratic time. So content decides which strings meet in which index. The hashes of all
`gram`-byte strings choose an anchor for every window of `length` bytes: its lowest hash. Equal windows have equal
anchors at equal places. Neighbouring windows that share an anchor make one context, the bytes that they cover.

1. Documents are packed into blocks of bounded size. Texts that are equal as a whole are one string with several
   documents: the smallest id stands for all, and the others lose everything.
2. A block sends the hash of each of its anchors once, in packed rows, to the bucket of that hash. The bucket answers
   which anchors occur in several documents.
3. A block sends the distinct contexts of such anchors once, with the smallest and largest of its documents that hold
   them, to buckets. A common passage thus costs one row a block, however many documents repeat it. An anchor of over
   `hot` blocks is cut in two: each of its windows holds the anchor and half of the remaining bytes before it, or the
   other half behind it, and these longer strings are the anchors that choose buckets then.
4. A bucket builds run-length compressed Burrows-Wheeler transforms with sampled run ends (`run_index`) of its distinct
   contexts, and streams the matching statistics of those that an earlier document might hold in part or whole. Where
   `length` or more bytes match, the index names the smallest document that holds them.
5. Blocks gather the answers: a window goes if a document smaller than its own holds it.

Apart from copies of whole texts, which SHA-256 tells, hashes only choose what meets; two strings that collide are in one
index and don't match there. The numbers of blocks and buckets follow from the bytes, so none grows with the corpus.

Defined cases: null counts as empty; texts shorter than `length` lose nothing; rows that repeat an id and a text are
documents of the same id, and none removes the other; a null id ranks above all others; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heronlake.llm.run_index import END, RunIndex, packed_words
from heronlake.llm.support import written

LENGTH, GRAM = 50, 20
#: Bytes of the texts of a block, of the texts that a bucket of anchors stands for, and contexts of a bucket.
BLOCK_BYTES, BUCKET_BYTES, BUCKET_CONTEXTS = 4 << 20, 32 << 20, 30_000
#: Contexts of one index.
PIECE = 8_000
#: Blocks beyond which an anchor is cut in two.
HOT = 2048
#: Bytes that are hashed at once, so that the numbers stay in the processor's cache.
CHUNK = 1 << 16
NULL_ID = (1 << 63) - 1
U = np.uint64
A, B, C, D = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(29))) * D
    return h ^ (h >> U(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width], for every i where that fits."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


class Texts:
    """The bytes of some documents, one behind another."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.n = int(self.sizes.sum())
        self.data = np.frombuffer(b"".join(texts) + b"\0" * (2 * length + 16), dtype=np.uint8)

    def contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, windows, gram_at): a context's first byte, its number of windows, and the place of its anchor."""
        whole = np.zeros(self.n + 1, dtype=np.int8)
        long = self.sizes >= self.length
        whole[self.starts[long]] += 1
        whole[self.starts[long] + self.sizes[long] - self.length + 1] -= 1
        whole = np.cumsum(whole[:-1], dtype=np.int8).astype(bool)
        parts = [self._contexts(at, whole[at : at + CHUNK]) for at in range(0, self.n, CHUNK)]
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3

    def hashes(self, begin: int, end: int, width: int) -> np.ndarray:
        """Of the strings of `width` bytes, 8 or more, that start at these places."""
        words = packed_words(self.data[begin : end + width])
        h = words[: end - begin] * A
        for at, factor in zip(range(8, width, 8), (B, C, D, A ^ B, A ^ C, A ^ D), strict=False):
            at = min(at, width - 8)
            h = h + words[at : at + end - begin] * factor
        return h ^ (h >> U(29))

    def _contexts(self, at: int, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reach = self.length - self.gram + 1
        keys = self.hashes(at, at + len(whole) + reach - 1, self.gram) * C
        # Equal high halves are told apart by place; so the anchor depends on the window's bytes only.
        keys = keys & U(0xFFFFFFFF00000000) | np.arange(len(keys), dtype=np.uint64)
        anchor = (_sliding_min(keys, reach) & U(0xFFFFFFFF)).astype(np.int64)
        new = whole.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
        first = np.flatnonzero(new)
        counted = np.concatenate([[0], np.cumsum(whole)])
        windows = np.diff(np.append(counted[first], counted[-1]))
        return first + at, windows, anchor[first] + at

    def owner(self, places: np.ndarray) -> np.ndarray:
        # Of documents that start at one place, all but the last are empty.
        return np.searchsorted(self.starts, places, side="right") - 1

    def route(self, places: np.ndarray, width: int) -> np.ndarray:
        """Hashes that choose buckets for the strings of `width` bytes at these places."""
        words = np.ndarray((len(self.data) - 7,), "<u8", self.data, 0, (1,))
        h = np.full(len(places), C)
        for at in [*range(0, width - 8, 8), width - 8]:
            h = _mix(h ^ words[places + at]) * A
        return _mix(h)

    def context_bytes(self, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, sizes): the bytes of contexts in rows of equal width, a multiple of 8, filled up with END."""
        sizes = windows + self.length - 1
        width = -(-(2 * self.length - self.gram) // 8) * 8
        rows = np.lib.stride_tricks.sliding_window_view(self.data, width)[start]
        rows[np.arange(width) >= sizes[:, None]] = END
        return rows, sizes


def distinct(rows: np.ndarray, *before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): rows sorted by what stands before and by their hashes, and where other bytes begin."""
    words = rows.view("<u8")
    h = np.full(len(rows), C)
    for k in range(words.shape[1]):
        h = _mix(h ^ words[:, k]) * A
    order = np.lexsort((h, *before))
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1)
    for x in before:
        new[1:] |= x[order[1:]] != x[order[:-1]]
    return order, new


def _bucket(route: np.ndarray, buckets: int) -> np.ndarray:
    return ((route >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _pack(*columns: np.ndarray, level: int = 1) -> bytes:
    head = struct.pack("<B", len(columns)) + b"".join(struct.pack("<2sI", c.dtype.str[1:].encode(), c.size) for c in columns)
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at, out = 1 + 6 * data[0], []
    for kind, size in struct.iter_unpack("<2sI", data[1:at]):
        out.append(np.frombuffer(data, dtype="<" + kind.decode(), count=size, offset=at))
        at += out[-1].nbytes
    return out


def _cuts(of: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the runs of equal numbers."""
    at = np.flatnonzero(np.diff(of)) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(of)], strict=True)) if len(of) else []


def _table(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


SENDS = pa.list_(pa.struct([("bucket", pa.int32()), ("data", pa.binary())]))


class _Block:
    """Documents of a block."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], length: int, gram: int):
        self.ids, self.texts, self.t = ids, texts, Texts(texts, length, gram)

    @classmethod
    def read(cls, data: bytes, length: int, gram: int) -> _Block:
        ids, sizes, body = _unpack(data)
        ends = np.cumsum(sizes, dtype=np.int64).tolist()
        body = body.tobytes()
        return cls(ids, [body[s:e] for s, e in zip([0, *ends], ends, strict=False)], length, gram)

    def packed(self) -> bytes:
        return _pack(self.ids, self.t.sizes.astype("<u4"), self.t.data[: self.t.n], level=3)

    def find(self) -> _Block:
        """Have the contexts and the hashes that choose their anchors' buckets."""
        self.start, self.windows, self.gram_at = self.t.contexts()
        self.route = self.t.route(self.gram_at, self.t.gram)
        # Anchors by their hashes, so those of a bucket stand together.
        self.order = np.argsort(self.route, kind="stable")
        new = np.ones(len(self.order), dtype=bool)
        new[1:] = np.diff(self.route[self.order]) != 0
        self.first = np.flatnonzero(new)
        self.anchors = self.route[self.order[self.first]]
        return self

    def sends(self, buckets: int) -> list[dict]:
        """For each bucket the low halves of its anchors' hashes, and a bit for those of several documents."""
        own = self.t.owner(self.start)[self.order]
        several = np.zeros(0, bool) if not len(own) else np.minimum.reduceat(own, self.first) != np.maximum.reduceat(own, self.first)
        low = self.anchors.astype(np.uint32)
        return [{"bucket": b, "data": low[s:e].tobytes() + np.packbits(several[s:e]).tobytes()} for s, e, b in self._by_bucket(buckets)]

    def _by_bucket(self, buckets: int):
        to = _bucket(self.anchors, buckets)
        return [(s, e, int(to[s])) for s, e in _cuts(to)]

    def contexts(self, buckets: int, answers: dict[int, bytes], copies: list[int], to_buckets: int) -> tuple[bytes, list[dict]]:
        """(where the block's shared contexts are, what goes to buckets); copies: documents that need none."""
        shared, hot = np.zeros(len(self.anchors), bool), np.zeros(len(self.anchors), bool)
        for s, e, b in self._by_bucket(buckets):
            if b in answers:
                bits = np.unpackbits(np.frombuffer(answers[b], dtype=np.uint8).reshape(2, -1), axis=1)[:, : e - s].astype(bool)
                shared[s:e], hot[s:e] = bits
        anchor = np.empty(len(self.order), dtype=np.int64)
        new = np.zeros(len(self.order), dtype=np.int64)
        new[self.first] = 1
        anchor[self.order] = np.cumsum(new) - 1
        t = self.t
        first_rows = np.ones(len(self.ids), dtype=bool)
        first_rows[copies] = False
        chosen = np.flatnonzero(shared[anchor])
        chosen = chosen[first_rows[t.owner(self.start[chosen])]]
        start, windows, route, gram_at = self.start[chosen], self.windows[chosen], self.route[chosen], self.gram_at[chosen]
        if hot.any():
            start, windows, route = self._halves(start, windows, route, gram_at, hot[anchor[chosen]])
        if not len(start):
            return _pack(start.astype("<u4"), start.astype("<u4")), []
        rows, sizes = t.context_bytes(start, windows)
        ids = self.ids[t.owner(start)]
        to = _bucket(_mix(route * B), to_buckets)
        order, new = distinct(rows, route, to)
        first = np.flatnonzero(new)
        variant = np.cumsum(new) - 1
        least, most = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
        lead = order[first]
        sends = []
        for s, e in _cuts(to[lead]):
            own = lead[s:e]
            body = rows[own][np.arange(rows.shape[1]) < sizes[own][:, None]]
            # Most contexts have one document here: the difference to the largest is 0.
            sends.append({"bucket": int(to[own[0]]), "data": _pack(np.arange(s, s + 1, dtype="<u4"), route[own].astype("<u4"), sizes[own].astype("u1"), least[s:e], most[s:e] - least[s:e], body)})
        return _pack(start[order].astype("<u4"), variant.astype("<u4")), sends

    def _halves(self, start, windows, route, gram_at, hot):
        """Contexts of hot anchors in two: windows that hold `half` more bytes before the anchor, and all others, which
        hold more behind it."""
        t = self.t
        half = (t.length - t.gram) // 2
        cold = ~hot
        begin, end, gram_at = start[hot], start[hot] + windows[hot], gram_at[hot]
        middle = np.clip(gram_at - half + 1, begin, end)
        left, right = middle > begin, end > middle
        parts = [(start[cold], windows[cold], route[cold])]
        parts.append((begin[left], (middle - begin)[left], t.route(gram_at[left] - half, t.gram + half)))
        parts.append((middle[right], (end - middle)[right], t.route(gram_at[right], t.gram + half)))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def cut(self, where: bytes | None, answers: list[bytes], copies: list[int]) -> pa.Table:
        """(id, n_bytes, spans, kept) of every document."""
        t = self.t
        mark = np.zeros(t.n + 1, dtype=np.int32)
        start, variant = (c.astype(np.int64) for c in _unpack(where)) if where else (np.zeros(0, np.int64),) * 2
        owner = t.owner(start)
        for data in answers:
            which, begin, count, least = (c.astype(np.int64) for c in _unpack(data))
            # Every place of a variant takes every answer for it.
            low, high = np.searchsorted(variant, which, side="left"), np.searchsorted(variant, which, side="right")
            answer = np.repeat(np.arange(len(which)), high - low)
            place = np.arange(len(answer)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[answer]
            earlier = least[answer] < self.ids[owner[place]]
            answer, place = answer[earlier], place[earlier]
            at = start[place] + begin[answer]
            np.add.at(mark, at, 1)
            np.add.at(mark, at + count[answer] + t.length - 1, -1)
        for k in copies:
            if len(self.texts[k]) >= t.length:
                mark[t.starts[k]] += 1
                mark[t.starts[k] + t.sizes[k]] -= 1
        gone = np.cumsum(mark[:-1], dtype=np.int32) > 0
        touched = np.add.reduceat(np.append(gone, False), t.starts, dtype=np.int64) if len(t.starts) else t.starts
        out = []
        for k, data in enumerate(self.texts):
            spans, kept = [], data
            if len(data) and touched[k]:
                own = gone[t.starts[k] : t.starts[k] + len(data)]
                edge = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
                spans = [{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                kept = np.frombuffer(data, dtype=np.uint8)[~own].tobytes()
            out.append((None if self.ids[k] == NULL_ID else int(self.ids[k]), len(data), spans, kept))
        return _table(["id", "n_bytes", "spans", "kept"], [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()], out)


BLOCK = "block bigint, docs array<struct<id:bigint,sha:binary>>, data binary"


def pack_blocks(length: int, gram: int, block_bytes: int):
    """Rows (block, docs, data): the ids and digests of some documents, and their texts."""
    names, kinds = ["block", "docs", "data"], [pa.int64(), pa.list_(pa.struct([("id", pa.int64()), ("sha", pa.binary())])), pa.binary()]

    def run(batches):
        from pyspark import TaskContext

        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close():
            docs = [{"id": i, "sha": hashlib.sha256(x).digest()} for i, x in zip(ids, texts, strict=True)]
            return _table(names, kinds, [(block, docs, _Block(np.array(ids, dtype="<i8"), texts, length, gram).packed())]).to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for i, x in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    ids.append(i), texts.append(x)
                    size += len(x) + 64
                    if size >= block_bytes:
                        yield from close()
                        block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield from close()

    return run


def send_anchors(length: int, gram: int, buckets: int):
    """Rows (block, bucket, data) of blocks (block, data)."""
    names, kinds = ["block", "bucket", "data"], [pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        for block, data in _rows(batches):
            sends = _Block.read(data, length, gram).find().sends(buckets)
            yield from _table(names, kinds, [(block, x["bucket"], x["data"]) for x in sends]).to_batches()

    return run


PACKED = "block bigint, bucket int, data binary"


def _rows(batches):
    """The rows of Arrow batches, one at a time as Python objects."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def _by_bucket(solve):
    """Over rows (bucket, block, data) sorted by bucket: solve(blocks, data) gives rows (block, data) for each bucket."""
    names, kinds = ["block", "bucket", "data"], [pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        held, now = [], None

        def close():
            rows = [(held[k][0], now, answer) for k, answer in solve([d for _, d in held])]
            held.clear()
            yield from _table(names, kinds, rows).to_batches()

        for bucket, block, data in _rows(batches):
            if held and bucket != now:
                yield from close()
            now = bucket
            held.append((block, data))
        if held:
            yield from close()

    return run


def find_shared(hot: int):
    """Of the anchors that blocks sent: a bit for those of several documents, and one for those of over `hot` blocks."""

    def solve(sent: list[bytes]):
        sizes = [len(d) * 8 // 33 for d in sent]
        low = np.concatenate([np.frombuffer(d, "<u4", n) for n, d in zip(sizes, sent, strict=True)])
        several = np.concatenate([np.unpackbits(np.frombuffer(d, "u1", offset=4 * n))[:n] for n, d in zip(sizes, sent, strict=True)]).astype(bool)
        order = np.argsort(low)
        new = np.ones(len(low), dtype=bool)
        new[1:] = np.diff(low[order]) != 0
        blocks = np.empty(len(low), dtype=np.int64)
        blocks[order] = np.diff(np.append(np.flatnonzero(new), len(low)))[np.cumsum(new) - 1]
        shared, is_hot, at = several | (blocks > 1), blocks > hot, 0
        for k, n in enumerate(sizes):
            if shared[at : at + n].any():
                yield k, np.packbits(shared[at : at + n]).tobytes() + np.packbits(is_hot[at : at + n]).tobytes()
            at += n

    return solve


def earliest(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray, least: np.ndarray, most: np.ndarray, length: int, piece: int):
    """(context, window, document) for distinct contexts, in the order of their groups: the smallest document that holds
    a window, where that is smaller than the largest that holds the context."""
    begins = np.array([s for s, _ in _cuts(groups)])
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(groups))))
    asked = most > np.minimum.reduceat(least, begins)[group]
    wanted = np.flatnonzero(np.logical_or.reduceat(asked, begins)[group])
    # Pieces end where a group ends, unless a group is larger than a piece: then it is streamed against each of its own.
    ends, at = [], 0
    group_ends = np.flatnonzero(np.append(np.diff(group[wanted]) != 0, True)) + 1 if len(wanted) else wanted
    while at < len(wanted):
        fits = group_ends[(group_ends > at) & (group_ends <= at + piece)]
        end = int(fits[-1]) if len(fits) else min(at + piece, len(wanted))
        ends.append((at, end))
        at = end
    found = []
    for s, e in ends:
        held = wanted[s:e]
        index = RunIndex(rows[held], sizes[held], least[held], length)
        low, high = np.searchsorted(group, [group[held[0]], group[held[-1]] + 1])
        patterns = low + np.flatnonzero(asked[low:high])
        patterns = patterns[np.argsort(-sizes[patterns], kind="stable")]
        for at in range(0, len(patterns), piece):
            part = patterns[at : at + piece]
            for column, k, matched, places, runs in index.matching_statistics(rows[part], sizes[part]):
                hit = np.flatnonzero(matched >= length)
                document = index.least_document(places[hit], runs[hit])
                hit, document = part[:k][hit], document
                smaller = document < most[hit]
                if smaller.any():
                    found.append((hit[smaller], np.full(int(smaller.sum()), column), document[smaller]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def solve_contexts(length: int, gram: int, piece: int):
    """Of the contexts that blocks sent: (variant, first window, windows, smallest document that holds them)."""
    width = -(-(2 * length - gram) // 8) * 8

    def solve(sent: list[bytes]):
        parts = [_unpack(d) for d in sent]
        base, route, sizes, least, most = (np.concatenate([p[i] for p in parts]) for i in range(5))
        most = least + most
        counts = np.array([len(p[1]) for p in parts])
        sizes = sizes.astype(np.int64)
        rows = np.full((len(sizes), width), END, dtype=np.uint8)
        rows[np.arange(width) < sizes[:, None]] = np.concatenate([p[5] for p in parts])
        source = np.repeat(np.arange(len(parts)), counts)
        variant = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts) + base.astype(np.int64)[source]
        order, new = distinct(rows, route)
        first = np.flatnonzero(new)
        lead = order[first]
        context, window, document = earliest(rows[lead], sizes[lead], route[lead], np.minimum.reduceat(least[order], first), np.maximum.reduceat(most[order], first), length, piece)
        if not len(context):
            return
        # Neighbouring windows with one answer make one.
        by = np.lexsort((window, document, context))
        context, window, document = context[by], window[by], document[by]
        fresh = np.ones(len(by), dtype=bool)
        fresh[1:] = (np.diff(context) != 0) | (np.diff(document) != 0) | (np.diff(window) > 1)
        repeat = ~fresh & np.concatenate([[False], np.diff(window) == 0])
        head = np.flatnonzero(fresh)
        count = np.add.reduceat((~repeat).astype(np.int64), head)
        context, window, document = context[head], window[head], document[head]
        # To each block for its own variants.
        member = np.cumsum(new) - 1
        low, high = np.searchsorted(member, context, side="left"), np.searchsorted(member, context, side="right")
        answer = np.repeat(np.arange(len(context)), high - low)
        place = order[np.arange(len(answer)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[answer]]
        of_use = document[answer] < most[place]
        answer, place = answer[of_use], place[of_use]
        by = np.lexsort((variant[place], source[place]))
        answer, place = answer[by], place[by]
        for s, e in _cuts(source[place]):
            a, p = answer[s:e], place[s:e]
            yield int(source[p[0]]), _pack(variant[p].astype("<u4"), window[a].astype("u1"), count[a].astype("u1"), document[a].astype("<i8"))

    return solve


#: Kinds of what a block learns: an answer about anchors, a document that is a copy, where contexts are, an answer about
#: contexts.
ANCHORS, COPY, WHERE, WINDOWS = range(4)
CONTEXTS = "block bigint, where binary, sends array<struct<bucket:int,data:binary>>"
SPANS = "id bigint, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary"


def _learned(notes: list[dict] | None, kind: int) -> list[dict]:
    return [x for x in notes or () if x["kind"] == kind]


def block_contexts(length: int, gram: int, buckets: int, to_buckets: int):
    """Rows (block, where, sends) from rows (block, data, notes)."""

    def run(batches):
        for block, data, notes in _rows(batches):
            answers = {x["n"]: x["data"] for x in _learned(notes, ANCHORS)}
            if answers:
                where, sends = _Block.read(data, length, gram).find().contexts(buckets, answers, [x["n"] for x in _learned(notes, COPY)], to_buckets)
                yield from _table(["block", "where", "sends"], [pa.int64(), pa.binary(), SENDS], [(block, where, sends)]).to_batches()

    return run


def cut_blocks(length: int, gram: int):
    """Rows (id, n_bytes, spans, kept) from rows (block, data, notes)."""

    def run(batches):
        for _, data, notes in _rows(batches):
            where = [x["data"] for x in _learned(notes, WHERE)]
            cut = _Block.read(data, length, gram).cut(where[0] if where else None, [x["data"] for x in _learned(notes, WINDOWS)], [x["n"] for x in _learned(notes, COPY)])
            yield from cut.to_batches(max_chunksize=1000)

    return run


def copied(blocks: DataFrame) -> DataFrame:
    """(block, n) of the documents whose whole text a document with a smaller id holds."""
    prints = blocks.select("block", F.posexplode("docs").alias("n", "doc")).select("block", "n", "doc.id", "doc.sha")
    groups = prints.groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("m")).filter("m > 1")
    # The key is rewritten so that both sides are dealt anew and Spark can split a hot text among tasks.
    groups = groups.select(F.concat("sha", F.lit(b"")).alias("__sha"), "least")
    return prints.join(groups, F.col("sha") == F.col("__sha")).filter("id > least").select("block", "n")


def long_matches(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, piece: int = PIECE, hot: int = HOT,
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, bucket_contexts: int = BUCKET_CONTEXTS,
) -> DataFrame:
    """(id, n_bytes, spans, kept): for each document its removed runs (byte offsets) and its remaining bytes."""
    if not 16 <= gram <= length - 2 <= 126:
        raise ValueError("gram may be 16 or more, and length gram + 2 to 128")
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    blocks = written(rows.mapInArrow(pack_blocks(length, gram, block_bytes), BLOCK), "match-blocks")
    copies = written(copied(blocks), "match-copies").select("block", F.lit(COPY).alias("kind"), "n", F.lit(None).cast("binary").alias("data"))

    def dealt(sent: DataFrame, buckets: int) -> DataFrame:
        return sent.select("bucket", "block", "data").repartition(max(tasks, buckets), "bucket").sortWithinPartitions("bucket")

    n_blocks = blocks.count()

    def with_notes(notes: DataFrame) -> DataFrame:
        # A task takes a few blocks, however many there are.
        n = max(tasks, -(-n_blocks // 4))
        gathered = notes.repartition(n, "block").groupBy("block").agg(F.collect_list(F.struct("kind", "n", "data")).alias("notes"))
        return blocks.select("block", "data").repartition(n, "block").join(gathered, "block", "left").select("block", "data", "notes")

    buckets = max(1, -(-n_blocks * block_bytes // bucket_bytes))
    anchors = blocks.select("block", "data").mapInArrow(send_anchors(length, gram, buckets), PACKED)
    flags = written(dealt(anchors, buckets).mapInArrow(_by_bucket(find_shared(hot)), PACKED), "match-anchors")
    n_shared = flags.agg(F.sum(F.expr("bitmap_count(data)"))).first()[0] or 0
    to_buckets = max(1, -(-n_shared // bucket_contexts))
    asked = with_notes(flags.select("block", F.lit(ANCHORS).alias("kind"), F.col("bucket").alias("n"), "data").union(copies))
    contexts = written(asked.mapInArrow(block_contexts(length, gram, buckets, to_buckets), CONTEXTS), "match-contexts")
    solved = written(dealt(contexts.select("block", F.inline("sends")), to_buckets).mapInArrow(_by_bucket(solve_contexts(length, gram, piece)), PACKED), "match-windows")
    found = contexts.select("block", F.lit(WHERE).alias("kind"), F.lit(0).alias("n"), F.col("where").alias("data")).union(solved.select("block", F.lit(WINDOWS).alias("kind"), F.lit(0).alias("n"), "data"))
    return with_notes(found.union(copies)).mapInArrow(cut_blocks(length, gram), SPANS)
