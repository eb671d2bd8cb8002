"""Alignment of two tokenizers' tokens by the bytes that they cover, and how often each pair of ids is linked.

Both tokenizers cut the same bytes, a space and the text, so a token's place follows from the lengths of the tokens before
it. The ends of either side's tokens are marked in a packed bitset over the bytes. AND of the two leaves the shared cuts; for
each cut the popcount of either bitset up to it is the number of tokens that end by then (words are counted once, and the
rest within a word by a mask), which turns byte cuts into ranges of tokens. The tokens between two shared cuts are a group,
and each token of one side is linked to each of the other side's in its group. Links are expanded in blocks of bounded
size, and what leaves a task is the distinct pairs of a document with how often each is linked.

Counts of pairs need all documents. Tasks count their own documents first. A pair that over 1 in HOT of all rows (document,
pair) hold is looked up by each task in a table, which so can't hold more than HOT pairs, and never is shuffled; the rest,
which so is held by few documents, meets its counts in a join.

Encoding is most of the work. Chunks of text are independent in both tokenizers if their pieces never go on past white
space, which is looked up in the vocabulary; such chunks are encoded by the library once and kept in a memo.

Defined cases: a null or empty text, and one whose tokens' bytes differ from a space and the text on either side, has no
tokens, and zeros; rows with the same id are documents of their own; texts are read whole; an empty table gives an empty
result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.bpe import UNEVEN, ChunkEncoder
from heronlake.llm.support import held_by_worker, written

#: Chunks of text that a worker keeps the ids of, for each tokenizer.
MEMO = 600_000
#: Bytes of text that are aligned at once, and links that are expanded at once.
PIECE, LINKS = 1 << 20, 1 << 21
#: Pairs of the table that tasks look up, at most.
HOT = 1 << 21
SPACE = "▁"


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str, memo: int = MEMO):
        # The memo is trimmed here, between texts.
        self.of, self.most = ChunkEncoder(path, lead=True, memo=1 << 62), memo
        self.of.tokenizer.encode_special_tokens = True
        vocabulary = self.of.tokenizer.get_vocab(with_added_tokens=True)
        # The 188 printable bytes stand for themselves, the others for characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        of_char = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()

    @property
    def memo(self) -> dict[str, bytes]:
        return self.of.memo

    def chunks(self, text: str) -> list[str]:
        """A space and the text, which isn't empty, in chunks that the library encodes independently."""
        if text[0].isspace():
            return self.of.chunks(" " + text)
        chunks = self.of.chunks(text)
        chunks[0] = " " + chunks[0]
        return chunks

    def learn(self, chunks: list[str]) -> None:
        self.of.learn([chunks])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and the text, which isn't empty."""
        return np.frombuffer(b"".join(self.of.parts(self.chunks(text))), dtype="<u4")

    def forget(self) -> None:
        """Leave no more in the memo than it may have."""
        _trim(self.memo, self.most)

    def spelled(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


class Pieces:
    """A tokenizer of the sentencepiece library that puts a space before a text."""

    def __init__(self, path: str, memo: int = MEMO):
        from sentencepiece import SentencePieceProcessor

        self.of, self.memo, self.most = SentencePieceProcessor(model_file=path), {}, memo
        names = [self.of.id_to_piece(i) for i in range(self.of.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.of.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        probe = "a  b　ﬁ é\t x "
        as_is = b"".join(self.bytes[i] for i in self.of.encode(probe)) == (" " + probe).encode()
        # No piece goes on past white space, and texts aren't changed: words with the spaces before them are independent.
        self.separable = as_is and all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p in names) and SPACE in names
        #: Nor does one hold a line end, so that lines are independent, too.
        line_end = [i for i, x in enumerate(self.bytes) if b"\n" in x]
        self.apart = self.separable and [self.bytes[i] for i in line_end] == [b"\n"]
        #: Pieces that start a chunk.
        self.starts = np.array([p[0] == SPACE for p in names])
        if self.apart:
            self.starts[line_end] = True

    def learn(self, chunks: list[str]) -> None:
        """Have the ids of chunks in the memo, each a space or a line end and no more white space after it."""
        if not chunks:
            return
        # All in one call, behind a word of their own; pieces that start with white space start the chunks.
        ids = np.array(self.of.encode("x" + "".join(chunks)), dtype="<u4")
        cuts = (np.flatnonzero(self.starts[ids]) * 4).tolist()
        raw = ids.tobytes()
        self.memo.update((c, raw[i:j]) for c, i, j in zip(chunks, cuts[1:], [*cuts[2:], len(raw)], strict=True))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and the text, which isn't empty."""
        return np.array(self.of.encode(text), dtype="<u4")

    def forget(self) -> None:
        _trim(self.memo, self.most)

    def spelled(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def _trim(memo: dict[str, bytes], most: int) -> None:
    """Frequent chunks come early: the first half stays."""
    if len(memo) > most:
        for chunk in list(memo)[most // 2 :]:
            del memo[chunk]


def even(text: str) -> bool:
    """Whether single spaces and line ends are the only white space, and none stands at an end."""
    return not (any(map(text.__contains__, UNEVEN)) or text[0].isspace() or text[-1].isspace())


class Bits:
    """A packed bitset over byte offsets, with the number of bits before each of its words."""

    def __init__(self, at: np.ndarray, size: int):
        marks = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        marks[at] = 1
        self.words = np.packbits(marks, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set up to and with each offset."""
        word, below = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(2) << below) - np.uint64(1)  # wraps to all bits for the last of a word
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


def select(words: np.ndarray) -> np.ndarray:
    """The offsets of the bits that are set."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either side end by each shared cut, from the tokens' lengths; both sides cover the same bytes."""
    ends = [np.cumsum(x, dtype=np.int64) - 1 for x in (a_sizes, b_sizes)]
    size = int(ends[0][-1]) + 1
    a, b = (Bits(x, size) for x in ends)
    cuts = select(a.words & b.words)
    return a.rank(cuts), b.rank(cuts)


class Aligner:
    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b, self.n_b = a, b, len(b.bytes)
        #: Chunks whose bytes one side spells differently; rare, or the tokenizers aren't made for aligning.
        self.odd: set[str] = set()
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (a, b))
        n_a = len(a.bytes)
        # Ids with what may stand behind them, to be picked by number.
        self.names = [b"%d," % i for i in range(n_a)] + [b"%d|" % i for i in range(n_a)] + [b"%d," % i for i in range(self.n_b)] + [b"%d;" % i for i in range(self.n_b)]
        self.name_at = (0, n_a, 2 * n_a, 2 * n_a + self.n_b)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of both sides of each text; None where there is nothing to align."""
        out: list = [None] * len(texts)
        chunks = {k: self.a.chunks(t) for k, t in enumerate(texts) if t and self.b.apart and SPACE not in t and even(t)}
        known = self._known(set().union(*chunks.values()))
        for k, text in enumerate(texts):
            if k in chunks:
                # Both sides of each chunk cover its bytes, so both sides of the text do.
                if known.issuperset(chunks[k]):
                    out[k] = tuple(np.frombuffer(b"".join(map(t.memo.__getitem__, chunks[k])), dtype="<u4") for t in (self.a, self.b))
            elif text:
                data, sides = (" " + text).encode("utf-8", "surrogatepass"), [t.encode(text) for t in (self.a, self.b)]
                if all(t.spelled(ids) == data for t, ids in zip((self.a, self.b), sides, strict=True)):
                    out[k] = tuple(sides)
        for t in (self.a, self.b):
            t.forget()
        return out

    def _known(self, chunks: set[str]) -> set[str]:
        """Has the ids of chunks in both memos; those of the chunks whose bytes both sides spell."""
        fresh = set()
        for t in (self.a, self.b):
            new = list(chunks.difference(t.memo))
            t.learn(new)
            if t.spelled(np.frombuffer(b"".join(map(t.memo.__getitem__, new)), dtype="<u4")) != "".join(new).encode("utf-8", "surrogatepass"):
                fresh.update(new)
        # All in one are compared first. A chunk that was learned before may be one that differs, as well.
        self.odd.update(c for c in fresh if any(t.spelled(np.frombuffer(t.memo[c], dtype="<u4")) != c.encode("utf-8", "surrogatepass") for t in (self.a, self.b)))
        return chunks - self.odd if self.odd else chunks

    def align(self, texts: list[str | None], digest: bool) -> list[dict]:
        """n_a, n_b, n_groups, n_links, groups and pairs (packed) of each text."""
        found = self.tokens(texts)
        out = [{"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": None} for _ in texts]
        held = [k for k, f in enumerate(found) if f is not None]
        if not held:
            return out
        a, b = (np.concatenate([found[k][side] for k in held]).astype(np.int64) for side in (0, 1))
        a_ends, b_ends = groups_of(self.a_sizes[a], self.b_sizes[b])
        a_starts, b_starts = np.append(0, a_ends[:-1]), np.append(0, b_ends[:-1])
        a_n, b_n = a_ends - a_starts, b_ends - b_starts
        # Documents end at shared cuts, so no group is in two.
        a_upto, b_upto = (np.cumsum([0, *(len(found[k][side]) for k in held)]) for side in (0, 1))
        g_upto = np.searchsorted(a_ends, a_upto, side="right")
        names = self._names(a, b, a_starts, a_ends, b_starts, b_ends)
        pairs = self._pairs(a, b, a_starts, a_n, b_starts, b_n, np.repeat(np.arange(len(held)), np.diff(g_upto)), len(held))
        links = np.concatenate([[0], np.cumsum(a_n * b_n)])
        for i, k in enumerate(held):
            g, h = g_upto[i], g_upto[i + 1]
            text = b"".join(map(self.names.__getitem__, names[a_upto[i] + b_upto[i] : a_upto[i + 1] + b_upto[i + 1]].tolist()))[:-1]
            out[k] = {"n_a": int(a_upto[i + 1] - a_upto[i]), "n_b": int(b_upto[i + 1] - b_upto[i]), "n_groups": int(h - g), "n_links": int(links[h] - links[g]),
                      "groups": hashlib.sha256(text).hexdigest() if digest else text.decode(), "pairs": pairs[i]}
        return out

    def _names(self, a, b, a_starts, a_ends, b_starts, b_ends) -> np.ndarray:
        """Numbers of the names of all ids, group by group, a's before b's."""
        names = np.empty(len(a) + len(b), dtype=np.int64)
        own = a + self.name_at[0]
        own[a_ends - 1] += self.name_at[1] - self.name_at[0]
        names[np.arange(len(a)) + np.repeat(b_starts, a_ends - a_starts)] = own
        own = b + self.name_at[2]
        own[b_ends - 1] += self.name_at[3] - self.name_at[2]
        names[np.arange(len(b)) + np.repeat(a_ends, b_ends - b_starts)] = own
        return names

    def _pairs(self, a, b, a_starts, a_n, b_starts, b_n, owners, n: int) -> list[bytes]:
        """Each document's distinct pairs and how often it links them, packed."""
        parts, size = [], a_n * b_n
        upto, at = np.cumsum(size), 0
        while at < len(size):
            # Whole groups of about LINKS links; one that alone has more is expanded by itself, in strips.
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, side="right")))
            if end == at + 1 and size[at] > LINKS:
                parts += self._strips(a[a_starts[at] :][: a_n[at]], b[b_starts[at] :][: b_n[at]], owners[at])
            else:
                many, width = size[at:end], np.repeat(b_n[at:end], size[at:end])
                inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                key = a[np.repeat(a_starts[at:end], many) + inner // width] * self.n_b + b[np.repeat(b_starts[at:end], many) + inner % width]
                key += np.repeat(owners[at:end], many) << 44
                parts.append(np.unique(key, return_counts=True))
            at = end
        keys, times = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        cuts = np.searchsorted(keys, np.arange(n + 1) << 44)
        keys &= (1 << 44) - 1
        return [pack(keys[i:j], times[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _strips(self, a, b, owner):
        """The same for one group of very many links: distinct ids with their numbers are multiplied."""
        a, a_times = np.unique(a, return_counts=True)
        b, b_times = np.unique(b, return_counts=True)
        step = max(1, LINKS // len(b))
        for at in range(0, len(a), step):
            key = (a[at : at + step, None] * self.n_b + b + (int(owner) << 44)).ravel()
            yield key, (a_times[at : at + step, None] * b_times).ravel()


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(times, new) if len(new) else times


def pack(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pairs as differences, and their times, in one zstandard frame."""
    data = np.diff(pairs, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8).T[:6]
    rest = times.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(data.tobytes() + rest.tobytes())


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(14, -1)
    sides = np.zeros((2, rows.shape[1], 8), dtype=np.uint8)
    sides[0, :, :6], sides[1] = rows[:6].T, rows[6:].T
    return np.cumsum(sides[0].view("<i8").ravel()), sides[1].view("<i8").ravel()


def _aligned(docs: DataFrame, a_path: str, b_path: str, id_column: str, text: str, digest: bool) -> DataFrame:
    def run(batches):
        own = held_by_worker(("align", a_path, b_path), lambda: Aligner(ByteLevel(a_path), Pieces(b_path)))
        # A number for each row; the rows are written once, so it needn't be the same in another attempt.
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.append(0, np.cumsum(pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + PIECE, side="right")) - 1)
                rows = pa.RecordBatch.from_pylist(own.align(batch.column(1).slice(at, end - at).to_pylist(), digest), schema=_ROW)
                numbers = pa.array(range(row, row + end - at), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), numbers, *rows.columns], names=["id", "row", *_ROW.names])
                row, at = row + end - at, end

    source = docs.select(F.col(id_column).alias("id"), F.col(text))
    schema = T.StructType([source.schema["id"], *T._parse_datatype_string("row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs binary").fields])
    return source.mapInArrow(run, schema)


_ROW = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("pairs", pa.binary())])


def _counted(rows: DataFrame, at_once: int = 1 << 21) -> DataFrame:
    """(pair, docs): how many rows hold each pair; summed within tasks as far as memory goes, then among them."""

    def run(batches):
        held, size = [], 0

        def total():
            return summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

        def batch_of(pairs, docs):
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(docs, pa.int64())], names=["pair", "docs"])

        for batch in batches:
            for data in batch.column(0).to_pylist():
                pairs = unpack(data)[0]
                held.append((pairs, np.ones(len(pairs), dtype=np.int64)))
                size += len(pairs)
                if size > 2 * at_once:
                    held = [total()]
                    size = len(held[0][0])
                    if size > at_once:
                        yield batch_of(*held[0])
                        held, size = [], 0
        if held:
            yield batch_of(*total())

    return rows.filter("pairs IS NOT NULL").select("pairs").mapInArrow(run, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))


def _looked_up(rows: DataFrame, hot: pa.Table) -> DataFrame:
    """rows with best and total over the hot pairs, and the others as cold: (pair, times)."""
    table = [hot.column(c).to_numpy() for c in ("pair", "docs", "best")]
    order = np.argsort(table[0])
    shared = rows.sparkSession.sparkContext.broadcast([x[order] for x in table])
    names = [c for c in rows.columns if c != "pairs"]
    kind = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def run(batches):
        pairs_hot, docs_hot, best_hot = shared.value
        for batch in batches:
            best, total, values, offsets = [], [], [], [0]
            for data in batch.column(batch.schema.get_field_index("pairs")).to_pylist():
                pairs, times = unpack(data) if data is not None else (np.zeros(0, dtype=np.int64),) * 2
                at = np.searchsorted(pairs_hot, pairs)
                at[at == len(pairs_hot)] = 0
                known = pairs_hot[at] == pairs if len(pairs_hot) else np.zeros(len(pairs), dtype=bool)
                best.append(int((times * best_hot[at])[known].sum()) if known.any() else 0)
                total.append(int((times * docs_hot[at])[known].sum()) if known.any() else 0)
                values.append((pairs[~known], times[~known]))
                offsets.append(offsets[-1] + len(values[-1][0]))
            sides = [pa.array(np.concatenate([v[side] for v in values]), pa.int64()) for side in (0, 1)]
            cold = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(sides, fields=list(kind.value_type)))
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(best, pa.int64()), pa.array(total, pa.int64()), cold], names=[*names, "best", "total", "cold"])

    schema = T.StructType([*(rows.schema[c] for c in names), *T._parse_datatype_string("best bigint, total bigint, cold array<struct<pair:bigint,times:bigint>>").fields])
    return rows.mapInArrow(run, schema)


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text", digest: bool = False, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Two tables of the alignment of a byte-level tokenizer (a) and a sentencepiece one (b).

    The first has a row for each document: (id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum). groups are the ids of
    each group, `a1,a2|b1;a3|b2,b3`, or with `digest` the SHA-256 of that text. n_best counts the links whose pair is in as many
    documents as any of its a id, count_sum adds up the links' counts. The second is (a, b, docs, best): the linked pairs of
    ids, the number of documents that link them, and whether that is a's highest.
    """
    n_b = len(Pieces(b_path, memo=0).bytes)
    rows = written(_aligned(docs, a_path, b_path, id_column, text, digest), "aligned")
    counts = written(_counted(rows), "pair-counts")
    a_id = F.expr(f"pair div {n_b}")
    # One row for each id of a's vocabulary, at most.
    highest = counts.groupBy(a_id.alias("__a")).agg(F.max("docs").alias("__most"))
    counts = written(counts.join(F.broadcast(highest), a_id == F.col("__a")).select("pair", "docs", (F.col("docs") == F.col("__most")).alias("best")), "pair-bests")
    everything = counts.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    # Fewer than `hot` pairs can have more than 1 in `hot` of all rows.
    split = written(_looked_up(rows, counts.filter(F.col("docs") * hot > everything).toArrow()), "looked-up")
    cold = split.select("row", F.inline("cold")).join(counts.withColumnRenamed("pair", "__pair").filter(F.col("docs") * hot <= everything), F.col("pair") == F.col("__pair"))
    cold = cold.groupBy(F.col("row").alias("__row")).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("times") * F.col("docs")).alias("__total"))
    made = split.drop("cold").join(cold, F.col("row") == F.col("__row"), "left")
    zero = F.lit(0).cast("long")
    made = made.select(
        "id", "n_a", "n_b", "n_groups", "n_links", "groups", (F.col("best") + F.coalesce("__best", zero)).alias("n_best"), (F.col("total") + F.coalesce("__total", zero)).alias("count_sum")
    )
    return made, counts.select(a_id.cast("int").alias("a"), F.expr(f"cast(pair % {n_b} as int)").alias("b"), "docs", "best")
