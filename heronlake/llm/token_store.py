"""Token ids in seekable files: independent zstandard frames, a trailing seek table, a checksum for each frame.

A shard holds the ids of consecutive documents, as unsigned 16-bit integers where the vocabulary fits and else 32-bit
ones. Frames of about `frame_bytes` end where a document ends; a document that is larger has frames of its own. Behind
them stand two skippable frames, so any zstandard tool still unpacks the plain ids:

* the index of documents: id (and whether it is null), number of the first token in the shard, number of tokens;
* the seek table of the seekable zstandard format: for every frame its packed and plain size and the low half of the
  XXH64 of its plain bytes, then the number of frames, a flag byte and the closing magic number.

A reader fetches the table and the index from the end of the file, and then unpacks and verifies only the frames of
the documents that it is asked for.

Documents are dealt by ranges of their ids and sorted within a range, so shard by shard they are in ascending order
of id, nulls first, equal ids by token ids. Tasks write files under names of their own attempt; the manifest names those
that count, so tasks may be repeated and executors lost. Where a shard starts in the whole is a running sum over the
manifest, which has one row for each shard.

Defined cases: null texts are empty and hold the end id only; rows may repeat; an empty table gives no shard; further
columns are not stored.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heronlake.llm.bpe import ChunkEncoder, encoder
from heronlake.llm.support import file_system, scratch_path, written

FRAME_BYTES = 1 << 18
#: Chunks of a worker's memo; encoding is most of the work here, and there is no other operator beside it.
MEMO = 1_600_000
# Fixed values of the zstandard and seekable formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_END = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Magic, bytes an id, reserved, documents: the head of the index of documents.
INDEX_HEAD = struct.Struct("<4sBxxxQ")


class ShardWriter:
    def __init__(self, out, width: int, frame_bytes: int = FRAME_BYTES, level: int = 1):
        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[bytes] = []
        self.size = self.n_tokens = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        """A document with its ids, as little-endian unsigned integers of the shard's width."""
        if self.size and self.size + len(data) > self.frame_bytes:
            self._frame(b"".join(self.held))
        for at in range(0, len(data) - self.frame_bytes + 1, self.frame_bytes):
            self._frame(data[at : at + self.frame_bytes])
        rest = data[len(data) - len(data) % self.frame_bytes :] if len(data) >= self.frame_bytes else data
        self.held.append(rest)
        self.size += len(rest)
        self.ids.append(doc_id)
        self.counts.append(len(data) // self.width)
        self.n_tokens += self.counts[-1]

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._frame(b"".join(self.held))
        nulls = np.array([x is None for x in self.ids], dtype=np.uint8)
        numbers = np.array([x or 0 for x in self.ids], dtype="<i8")
        counts = np.array(self.counts, dtype="<u8")
        body = INDEX_HEAD.pack(b"docs", self.width, len(self.ids)) + self.packer.compress(numbers.tobytes() + counts.tobytes() + nulls.tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        self.frames.append((len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_END)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class ShardReader:
    """Random access to a shard; `source` has read, seek and size."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n_frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_END or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n_frames, 12 * n_frames), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.plain, self.sums = table.T
        self.offsets = np.concatenate([[0], np.cumsum(self.packed)])
        self.starts = np.concatenate([[0], np.cumsum(self.plain)])
        self.unpacker = zstandard.ZstdDecompressor()
        body = self._at(int(self.offsets[n_frames - 1]) + 8, int(self.packed[-1]) - 8)
        magic, self.width, n = INDEX_HEAD.unpack_from(body)
        if magic != b"docs":
            raise ValueError("the index of documents is missing")
        data = self.unpacker.decompress(body[INDEX_HEAD.size :], max_output_size=17 * n) if n else b""
        self.nulls = np.frombuffer(data, dtype=np.uint8, count=n, offset=16 * n).astype(bool)
        self.ids = np.frombuffer(data, dtype="<i8", count=n)
        self.counts = np.frombuffer(data, dtype="<u8", count=n, offset=8 * n).astype(np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])
        self.last: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            data = self.unpacker.decompress(self._at(int(self.offsets[k]), int(self.packed[k])))
            if len(data) != self.plain[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self.last = (k, data)
        return self.last[1]

    def document(self, n: int) -> np.ndarray:
        """Ids of the n-th document; only its frames are unpacked."""
        start, end = int(self.firsts[n]) * self.width, int(self.firsts[n + 1]) * self.width
        k = int(np.searchsorted(self.starts, start, side="right")) - 1
        parts = []
        while start < end:
            upto = min(end, int(self.starts[k + 1]))
            parts.append(self.frame(k)[start - int(self.starts[k]) : upto - int(self.starts[k])])
            start, k = upto, k + 1
        return np.frombuffer(b"".join(parts), dtype=f"<u{self.width}")


def write_tokens(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text: str = "text", lead: bool = True, shards: int | None = None, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode docs into shards under uri; gives the written manifest (shard, path, n_docs, n_tokens)."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Bounds between the shards: ranges of ids with about as many documents each. They only deal; the order is exact.
    bounds = np.array(rows.approxQuantile("id", [k / shards for k in range(1, shards)], 0.25 / shards) if shards > 1 else [], dtype=np.float64).astype(np.int64)
    width = 2 if max(ChunkEncoder(tokenizer, lead).tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4

    def encode(batches):
        of, end = encoder(tokenizer, lead, MEMO), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [of.chunks(t) for t in part.column(1).to_pylist()]
                of.learn(texts)
                ids = (np.frombuffer(b"".join([*of.parts(chunks), end]), dtype="<u4") for chunks in texts)
                shard = [0 if i is None else int(np.searchsorted(bounds, i, side="right")) for i in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), part.column(0), pa.array([x.astype(f"<u{width}").tobytes() for x in ids], pa.binary())], names=["shard", "id", "ids"])

    # Token ids are smaller than texts, so they are what shuffles.
    coded = rows.mapInArrow(encode, "shard int, id bigint, ids binary")
    dealt = coded.repartitionById(shards, "shard").sortWithinPartitions("id", "ids").select("id", "ids")

    def write(batches):
        from pyspark import TaskContext

        shard, writer, path, out = TaskContext.get().partitionId(), None, "", None
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    fs, root = file_system(uri)
                    fs.create_dir(root, recursive=True)
                    path = f"{root}/tokens-{shard:06d}-{uuid.uuid4().hex}.zst"
                    out = fs.open_output_stream(path, compression=None)
                    writer = ShardWriter(out, width, frame_bytes)
                writer.add(doc_id, data)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (shard, path, len(writer.ids), writer.n_tokens)], names=["shard", "path", "n_docs", "n_tokens"])

    return written(dealt.mapInArrow(write, "shard bigint, path string, n_docs bigint, n_tokens bigint"), "token-manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, uri: str, wanted: list[int] | None = None, batch_bytes: int = 8 << 20) -> DataFrame:
    """(id, start, n_tokens, ids) from the shards of a manifest; ids as little-endian unsigned 32-bit integers.

    wanted: ids of the documents to read; others are not unpacked.
    """
    # One row for each shard.
    before = Window.orderBy("shard", "path").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    only = None if wanted is None else np.array(sorted(wanted), dtype=np.int64)

    def read(batches):
        fs, _ = file_system(uri)
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(path) as source:
                    shard = ShardReader(source)
                    chosen = range(len(shard.ids)) if only is None else np.flatnonzero(np.isin(shard.ids, only) & ~shard.nulls).tolist()
                    rows, held = [], 0
                    for n in chosen:
                        data = shard.document(n).astype("<u4").tobytes()
                        rows.append((None if shard.nulls[n] else int(shard.ids[n]), base + int(shard.firsts[n]), len(data) // 4, data))
                        held += len(data)
                        if held > batch_bytes or len(rows) >= 4096:
                            yield _rows(rows)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows)

    # A number of its own keeps Spark from reading all shards in one task because the manifest is short.
    return placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["id", "start", "n_tokens", "ids"])


def token_round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write docs to shards in the shared folder and read all of them back."""
    uri = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, write_tokens(docs, uri, tokenizer, **options), uri)
