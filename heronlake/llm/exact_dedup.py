"""Exact deduplication by two passes over a Bloom filter of positions that are hit more than once.

Pass 1 hashes every row to a few positions of a bit space and counts the hits; counts are summed within tasks first, so
a hot text shuffles one number a task. The positions hit at least twice are packed into bitmaps. A key that occurs twice
hits all its positions twice, so in pass 2 a row with any position outside the bitmaps is certainly unique and passes
straight through. Only the others shuffle by their full SHA-256, which settles them exactly.

All this is decided on written prints (digest, id). The bitmaps are the one thing that is broadcast, and `max_bits` bounds
them (64 MB as set). Where more bits are needed, the prints are dealt to rounds by a hash of their digest, each with a filter of
its own, one after the other. Whole rows are then told by one filter of the digests that do occur several times: those outside
pass straight through, the others meet their groups in a join. With very many such digests this filter lets more rows into the
join, and the result is the same.

Everything is DataFrame functions.

Defined cases: a null text counts as empty; texts are compared byte for byte; a null id ranks below every other id;
of rows that agree in text and id, one stays (the one whose remaining columns hash lowest); an empty table gives an
empty result; further columns are kept, and the columns that this adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm.support import scratch_path, written

ADDED = ("keep_id", "group_size", "kept", "text_sha256")
#: Bits of one row of the broadcast bitmaps, as bitmap_construct_agg makes them.
BUCKET = 32768


def text_digest(text: str = "text") -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _positions(digest: str, bits: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(digest), F.lit(k)), F.lit(bits)) for k in range(probes)]


def filter_bits(n_rows: int, bits_per_row: int, max_bits: int) -> int:
    bits = BUCKET
    while bits < min(n_rows * bits_per_row, max_bits):
        bits *= 2
    return bits


def repeated_bitmaps(rows: DataFrame, digest: str, bits: int, probes: int) -> DataFrame:
    """(bucket, bitmap) of the positions that rows hit at least twice."""
    hits = rows.select(F.explode(F.array(*_positions(digest, bits, probes))).alias("at"))
    twice = hits.groupBy("at").count().filter("count >= 2")
    return twice.groupBy(F.expr(f"at div {BUCKET}").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(at % {BUCKET})").alias("bitmap"))


def bit_at(bitmap: str, at: str) -> Column:
    byte = f"cast(conv(hex(substring({bitmap}, cast(({at} % {BUCKET}) div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.coalesce(F.expr(f"(shiftright({byte}, cast({at} % 8 as int)) & 1) = 1"), F.lit(False))


def _maybe(rows: DataFrame, digest: str, bitmaps: DataFrame, bits: int, probes: int) -> DataFrame:
    """rows with __maybe: false only where the bitmaps lack a position of the digest. Nothing shuffles."""
    columns, tested, maybe = rows.columns, rows, F.lit(True)
    for k, position in enumerate(_positions(digest, bits, probes)):
        probe = bitmaps.select(F.col("bucket").alias(f"__b{k}"), F.col("bitmap").alias(f"__m{k}"))
        # max_bits / 8 bytes at most, whatever the input
        tested = tested.withColumn(f"__p{k}", position).join(F.broadcast(probe), F.expr(f"__p{k} div {BUCKET} = __b{k}"), "left")
        maybe = maybe & bit_at(f"__m{k}", f"__p{k}")
    return tested.select(*columns, maybe.alias("__maybe"))


class RepeatedDigests:
    """The digests that several rows of `prints` share, and a filter that tells rows without such a digest.

    prints: a written table with the digests and ids of the rows, from which everything is decided. Where they need more than
    `max_bits`, they are dealt to rounds by a hash and each round has a filter of its own, one at a time; no round
    reads more than its own prints. The rows themselves are read by none of this.

    groups: (__key, first, n, same): a digest, the least or largest id that has it, how many rows have it, and how many have that
    id as well.
    """

    def __init__(self, prints: DataFrame, digest: str, id_column: str, largest: bool, bits_per_row: int = 16, max_bits: int = 1 << 29, probes: int = 2):
        self.digest, self.probes, spark = digest, probes, prints.sparkSession
        n_rows = prints.count()
        rounds = max(1, -(-n_rows * bits_per_row // max_bits))
        bits = filter_bits(-(-n_rows // rounds), bits_per_row, max_bits)
        if rounds > 1:
            dealt, prints = scratch_path(spark, "repeat-rounds"), prints.select(digest, id_column)
            prints.withColumn("__round", F.pmod(F.xxhash64(F.col(digest), F.lit(-1)), F.lit(rounds)).cast("int")).write.partitionBy("__round").parquet(dealt)
        schema, path = prints.schema, scratch_path(spark, "repeat-groups")
        chosen = F.max if largest else F.min
        of_chosen = F.max_by if largest else F.min_by
        for k in range(rounds):
            if rounds > 1 and not _exists(spark, f"{dealt}/__round={k}"):
                continue
            part = prints if rounds == 1 else spark.read.schema(schema).parquet(f"{dealt}/__round={k}")
            bitmaps = written(repeated_bitmaps(part, digest, bits, probes), "repeat-bits")
            suspects = _maybe(part, digest, bitmaps, bits, probes).filter("__maybe")
            groups = suspects.groupBy(digest, id_column).agg(F.count("*").alias("__m")).groupBy(digest)
            groups = groups.agg(chosen(id_column).alias("first"), F.sum("__m").alias("n"), of_chosen("__m", id_column).alias("__same")).filter("n > 1")
            # The key is rewritten so that both sides of a join are dealt anew: only then can Spark split a hot group among tasks.
            groups = groups.select(F.concat(digest, F.lit("")).alias("__key"), "first", "n", F.coalesce("__same", "n").alias("same"))
            groups.write.mode("append").parquet(path)
        if not _exists(spark, path):
            groups.write.parquet(path)
        self.groups = spark.read.schema(groups.schema).parquet(path)
        self.bits = filter_bits(self.groups.count(), bits_per_row, max_bits)
        hits = self.groups.select(F.explode(F.array(*_positions("__key", self.bits, probes))).alias("at"))
        self.bitmaps = written(hits.groupBy(F.expr(f"at div {BUCKET}").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(at % {BUCKET})").alias("bitmap")), "repeat-bits")

    def flag(self, rows: DataFrame) -> DataFrame:
        """rows with __maybe: false only where no other row has the digest. One read, and one filter however many rounds."""
        return _maybe(rows, self.digest, self.bitmaps, self.bits, self.probes)


def _exists(spark, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def mark_repeats(rows: DataFrame, digest: str = "text_sha256", id_column: str = "doc_id", prints: DataFrame | None = None, **options) -> DataFrame:
    """rows with keep_id, group_size and kept; rows with equal digests form a group and its largest id stays.

    prints: a written table of the rows' digests and ids, from which everything is decided; rows are read to mark them, once
    for those that pass straight through and once for those that meet their group.
    """
    rows = rows.drop("keep_id", "group_size", "kept")
    columns = rows.columns
    prints = written(rows.select(digest, id_column), "repeat-prints") if prints is None else prints
    known = RepeatedDigests(prints, digest, id_column, largest=True, **options)
    tested = known.flag(rows)
    single = [F.col(id_column).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")]
    alone = tested.filter("not __maybe").select(*columns, *single)
    own = known.groups.select("__key", F.col("first").alias("keep_id"), F.col("n").alias("group_size"), F.col("same").alias("__same"))
    met = tested.filter("__maybe").select(*columns).join(own, F.col(digest) == F.col("__key"), "left")
    # The filter lets some rows through whose digest no other has.
    grouped = F.col("__key").isNotNull()
    settled = met.select(
        *columns, "__same", F.when(grouped, F.col("keep_id")).otherwise(F.col(id_column)).alias("keep_id"), F.when(grouped, F.col("group_size")).otherwise(1).alias("group_size"),
        (~grouped | F.col(id_column).eqNullSafe(F.col("keep_id"))).alias("kept"),
    )
    if known.groups.filter("same > 1").isEmpty():
        return alone.unionByName(settled.drop("__same"))
    of_tie = F.col("kept") & (F.coalesce("__same", F.lit(1)) > 1)
    order = Window.partitionBy(digest, id_column).orderBy(F.xxhash64(*columns))
    tied = settled.filter(of_tie).withColumn("kept", F.row_number().over(order) == 1)
    return alone.unionByName(settled.filter(~of_tie).drop("__same")).unionByName(tied.drop("__same"))


def exact_dedup(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """docs with text_sha256, keep_id, group_size and kept."""
    return mark_repeats(docs.withColumn("text_sha256", text_digest(text)), "text_sha256", id_column, **options)


def drop_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that stay, with their own columns."""
    hashed = docs.withColumn("__sha", text_digest(text))
    clash = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    hashed = hashed.withColumnsRenamed(clash)
    own_id = clash.get(id_column, id_column)
    # Narrow rows decide, so texts are read to hash them, and then once for each way that they go.
    prints = written(hashed.select("__sha", own_id), "repeat-prints")
    kept = mark_repeats(hashed, "__sha", own_id, prints, **options).filter("kept").drop("keep_id", "group_size", "kept")
    return kept.withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)
