"""WARC archives: write captures, read records, and assemble the records of a capture into one nested row.

A capture is written as three records, each a gzip member of its own: the response (or a revisit of an earlier one
with the same payload), and a request and a metadata record that point at it through WARC-Concurrent-To. Reading
gives one row per record; `assemble` joins requests and metadata to their response through these identifiers and
emits one nested row per capture, wherever the records stand in the archives.

Payloads of `min_revisit` bytes or more that occur again are stored once: the record with the smallest id is the
response, the others are revisits without a payload that refer to it. A Bloom filter of repeated digests lets unique
pages through without a shuffle; the others join their group by digest, where Spark splits a hot digest among tasks.

Archives are written by tasks under names of their own attempt, and only files in the manifest count, so a task may
fail, run twice or be lost with its executor.

Defined cases: a null payload is empty; a null url is written as an empty target; a null id ranks last and is left
out of the metadata; of rows that agree in id and payload one is the response; rows may repeat; further columns are
not archived; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heronlake.llm.exact_dedup import RepeatedDigests
from heronlake.llm.support import file_system, scratch_path, written

MIN_REVISIT = 100
FILE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = "type string, record_id string, concurrent_to string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes bigint, digest_ok boolean, fields map<string,string>, block binary"


def response_id(page_id, digest: str) -> str:
    """The record id of the one response of a payload that others may revisit."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}/{digest}'.encode()).hexdigest())}>"


def plan_records(pages: DataFrame, id_column: str, payload: str, min_revisit: int, **options) -> DataFrame:
    """pages with digest, record_type and refers_to (the id of the response that a revisit points at)."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumn("digest", F.sha2(body.cast("binary"), 256)).withColumn("n_bytes", F.octet_length(body).cast("long"))
    # Only rows whose payload is large, and may occur again, shuffle. Narrow rows decide which.
    prints = written(rows.filter(F.col("n_bytes") >= min_revisit).select("digest", id_column), "warc-prints")
    known = RepeatedDigests(prints, "digest", id_column, largest=False, **options)
    groups = known.groups.select(F.col("__key").alias("__digest"), "first", F.col("same").alias("ties"))
    flagged = known.flag(rows).withColumn("__maybe", F.col("__maybe") & (F.col("n_bytes") >= min_revisit))
    columns = [*pages.columns, "digest", "n_bytes"]
    alone = flagged.filter("not __maybe").select(*columns, F.lit("response").alias("record_type"), F.lit(None).cast(pages.schema[id_column].dataType).alias("refers_to"), F.lit(False).alias("shared"))
    large = flagged.filter("__maybe").select(*columns)
    settled = large.join(groups, F.col("digest") == F.col("__digest"), "left").withColumn("shared", F.col("__digest").isNotNull())
    settled = settled.withColumn("__lead", ~F.col("shared") | F.col(id_column).eqNullSafe(F.col("first"))).withColumn("ties", F.coalesce("ties", F.lit(1)))
    if not groups.filter("ties > 1").isEmpty():
        order = Window.partitionBy("digest", id_column).orderBy(F.xxhash64(*pages.columns))
        tied = settled.filter("__lead and ties > 1").withColumn("__lead", F.row_number().over(order) == 1)
        settled = settled.filter("not __lead or ties = 1").unionByName(tied)
    kind = F.when(F.col("__lead"), "response").otherwise("revisit")
    return alone.unionByName(settled.select(*columns, kind.alias("record_type"), F.when(~F.col("__lead"), F.col("first")).alias("refers_to"), "shared"))


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _capture(shard: int, n: int, page_id, url: str, payload: bytes, digest: str, n_bytes: int, kind: str, refers_to, shared: bool) -> bytes:
    if kind == "response" and shared:
        own = response_id(page_id, digest)
    else:
        own = f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{shard}/{n}/{page_id}/{digest}'.encode()).hexdigest())}>"
    others = [f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{own}/{x}'.encode()).hexdigest())}>" for x in ("request", "metadata")]
    url = " ".join(url.split())
    common = [("WARC-Target-URI", url), ("WARC-Date", DATE)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own), *common, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", response_id(refers_to, digest))]
    host = url.partition("://")[2].partition("/")[0]
    request = f"GET {url} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    note = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return b"".join((
        _record([("WARC-Type", "request"), ("WARC-Record-ID", others[0]), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/http; msgtype=request")], request),
        _record(fields, http if kind == "revisit" else http + payload),
        _record([("WARC-Type", "metadata"), ("WARC-Record-ID", others[1]), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/warc-fields")], note),
    ))


def write_warc(pages: DataFrame, uri: str, id_column: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive pages under uri; gives the written manifest (path, n_captures)."""
    planned = plan_records(pages.select(id_column, url, payload), id_column, payload, min_revisit)
    ready = planned.select(F.col(id_column).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.when(F.col("record_type") == "response", F.coalesce(F.col(payload), F.lit(""))).otherwise("").cast("binary").alias("payload"), "digest", "n_bytes", "record_type", "refers_to", "shared")

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, root = file_system(uri)
        out, path, n, inside, size = None, "", 0, 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path = f"{root}/capture-{shard:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, inside, size = fs.open_output_stream(path, compression=None), 0, 0
                data = _capture(shard, n, *row)
                out.write(data)
                n, inside, size = n + 1, inside + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    done.append((path, inside))
                    out = None
        if out is not None:
            out.close()
            done.append((path, inside))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], names=["path", "n_captures"])

    return written(ready.mapInArrow(write, "path string, n_captures bigint"), "warc-manifest")


def records_of(stream):
    """(header fields, block) of every record of an archive that is read as a stream of bytes."""
    unpack, held, raw = None, bytearray(), b""

    def more() -> bool:
        nonlocal unpack, raw
        while True:
            if not raw:
                raw = stream.read(1 << 20)
                if not raw:
                    return False
            unpack = unpack or zlib.decompressobj(31)
            held.extend(unpack.decompress(raw))
            raw = unpack.unused_data if unpack.eof else b""
            if unpack.eof:
                unpack = None
            if held:
                return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        lines = held[:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        del held[: end + 4]
        length = int(fields["content-length"])
        while len(held) < length + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        block = bytes(held[:length])
        del held[: length + 4]
        yield fields, block


def read_warc(spark: SparkSession, manifest: DataFrame, uri: str, blocks: bool = True) -> DataFrame:
    """One row per record of the manifest's archives. blocks=False leaves the blocks of responses out."""

    def read(batches):
        fs, _ = file_system(uri)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for fields, block in records_of(stream):
                        kind, digest, n_bytes, ok = fields["warc-type"], None, None, None
                        if kind in ("response", "revisit"):
                            head, _, payload = block.partition(b"\r\n\r\n")
                            digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                            if kind == "response":
                                n_bytes, real = len(payload), hashlib.sha256(payload).hexdigest()
                                ok, digest = real == digest, real
                            else:
                                n_bytes = int(head.lower().partition(b"content-length:")[2].partition(b"\r\n")[0])
                        keep = block if blocks or kind == "metadata" else None
                        rows.append((kind, fields["warc-record-id"], fields.get("warc-concurrent-to"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-refers-to"), digest, n_bytes, ok, list(fields.items()) if blocks else None, keep))
                        held += len(keep or b"")
                        if len(rows) >= 5000 or held > 16 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    # A number of its own keeps Spark from reading all archives in one task because their names are short.
    files = manifest.select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.mapInArrow(read, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.int64(), pa.bool_(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, page_id, response, request, metadata.

    A response without a request or metadata record has null there; request and metadata records that point at no
    response in the archives are no capture and are left out.
    """
    parts = [f.split()[0] for f in RECORD.split(", ")]
    response = records.filter(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), F.struct(*parts).alias("response"))
    request = records.filter("type = 'request'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target_uri", "date", "fields", "block").alias("request"))
    metadata = records.filter("type = 'metadata'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "fields", "block").alias("metadata"))
    page = F.expr("try_cast(nullif(regexp_extract(cast(metadata.block as string), '(?m)^page-id: (-?[0-9]+)', 1), '') as bigint)")
    joined = response.join(request, "capture_id", "left").join(metadata, "capture_id", "left")
    return joined.select("capture_id", page.alias("page_id"), "response", "request", "metadata")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """captures with refers_to: the page_id of the response that a revisit names, else null."""
    targets = captures.filter("response.type = 'response'").select(F.col("capture_id").alias("__target"), F.col("page_id").alias("refers_to"))
    return captures.join(targets, F.col("response.refers_to") == F.col("__target"), "left").drop("__target")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write pages to archives in the shared folder, read them back, and give one row per capture."""
    spark = pages.sparkSession
    uri = scratch_path(spark, "warc")
    manifest = write_warc(pages, uri, **options)
    records = written(read_warc(spark, manifest, uri, blocks=False), "warc-records")
    return resolve_revisits(assemble(records))
