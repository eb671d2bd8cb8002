"""Substring search by an index of character trigrams.

Texts are dealt to blocks of at most BLOCK articles. For each field, trigram and block the index holds a bitmap of the
articles whose folded field has the trigram, in folders by the trigram's hash, sorted by trigram. A search reads the folders
and row groups of the trigrams that its pattern can't do without, and ANDs their bitmaps; what remains are candidates, and the
pattern itself is applied to them. So the result is that of a scan, whatever the index leaves in.

The fold maps character by character and takes no notice of case, so one index serves LIKE and ILIKE: texts that match a
pattern either way hold the pattern's folded literals.

Patterns are Spark's: % and _ are wildcards, and a backslash takes their meaning from them. A pattern whose literal runs are
all under three characters has no trigram; it is answered by a scan of the indexed texts.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.operators.search import like

#: Articles of a block: the bits of a bitmap.
BLOCK = 32768
FOLDERS = 64
#: Candidates that are fetched by their numbers, and blocks that are fetched by theirs; beyond, candidates are joined.
MAX_NUMBERS, MAX_BLOCKS = 5000, 256


def fold(x: Column) -> Column:
    """Without case, each character by itself: only of sigma the lower case depends on what follows."""
    return F.translate(F.lower(x), "ς", "σ")


def literals(pattern: str) -> list[str]:
    """The runs of characters of a pattern between its wildcards."""
    runs, now, i = [], "", 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            now += pattern[i + 1]
            i += 1
        elif pattern[i] in "%_":
            runs.append(now)
            now = ""
        else:
            now += pattern[i]
        i += 1
    return [r for r in [*runs, now] if r]


def grams_of(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(len(text) - 2)}


def folder_of(gram: str, folders: int) -> int:
    return zlib.crc32(gram.encode()) % folders


class Places:
    """The places of a block's articles that have a trigram: numbers of 2 bytes, or a bitmap once that is smaller."""

    def __init__(self):
        self.few: dict[str, array] = defaultdict(lambda: array("H"))
        self.many: dict[str, np.ndarray] = {}

    def grams(self) -> list[str]:
        return [*self.few, *(g for g in self.many if g not in self.few)]

    def fold(self) -> None:
        """Put what takes more than a bitmap into one. Numbers that are left take up to BLOCK / 8 bytes a trigram."""
        for g in [g for g, places in self.few.items() if len(places) > BLOCK // 16]:
            self.many[g] = self._united(g)

    def taken(self, gram: str) -> bytes:
        """The trigram's bitmap, which is then forgotten."""
        bits = self._united(gram)
        self.many.pop(gram, None)
        return bits.tobytes()

    def _united(self, gram: str) -> np.ndarray:
        bits = np.zeros(BLOCK, dtype=np.uint8)
        if gram in self.few:
            bits[np.frombuffer(self.few.pop(gram), dtype=np.uint16)] = 1
        bits = np.packbits(bits, bitorder="little")
        return bits | self.many[gram] if gram in self.many else bits


def _maps(texts: DataFrame, fields: tuple[str, ...], at_once: int = 1 << 25) -> DataFrame:
    """(field, gram, block, bitmap) of the texts that a task reads: a bitmap for each block and trigram, or several where one
    block has more than `at_once` trigrams of articles. Nothing is shuffled."""

    def made(held: Places, field: str, block: int):
        grams = held.grams()
        for at in range(0, len(grams), 250):
            part = grams[at : at + 250]
            maps = pa.array([held.taken(g) for g in part], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([field] * len(part), pa.string()), pa.array(part, pa.string()), pa.array([block] * len(part), pa.int64()), maps], names=["field", "gram", "block", "bitmap"])

    def run(batches):
        held, size, block, seen = {f: Places() for f in fields}, 0, None, 0
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            columns = [batch.column(k + 1) for k in range(len(fields))]
            for i, n in enumerate(numbers):
                if block is not None and n // BLOCK != block or size > at_once:
                    for f in fields:
                        yield from made(held[f], f, block)
                    size = 0
                block, place, seen = n // BLOCK, n % BLOCK, seen + 1
                for f, column in zip(fields, columns, strict=True):
                    grams, own = grams_of(column[i].as_py()), held[f].few
                    size += len(grams)
                    for g in grams:
                        own[g].append(place)
                    if seen % 1024 == 0:
                        held[f].fold()
        if block is not None:
            for f in fields:
                yield from made(held[f], f, block)

    folded = texts.select("n", *(F.coalesce(fold(F.col(f)), F.lit("")) for f in fields))
    return folded.mapInArrow(run, "field string, gram string, block bigint, bitmap binary")


class TrigramIndex:
    """Articles under path/texts, numbered, and bitmaps of their trigrams under path/grams."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.texts = spark, spark.read.parquet(f"{path}/texts")
        self.grams = spark.read.schema("field string, gram string, block bigint, bitmap binary, folder int").parquet(f"{path}/grams")
        options = spark.read.json(f"{path}/options").first()
        self.fields, self.folders, self.blocks = tuple(options["fields"]), options["folders"], options["blocks"]
        #: Whether a trigram has several bitmaps in a block, which are united before they are compared.
        self.partial = options["partial"]

    @classmethod
    def write(cls, articles: DataFrame, path: str, fields: tuple[str, ...] = ("title", "content"), folders: int = FOLDERS) -> TrigramIndex:
        """Index articles (id and the fields) under path, which must not exist, and open the index.

        Numbers follow the partitions in which articles are read, so they take no shuffle, and a block is written by one
        task. Tasks make the bitmaps of what they read; only these are dealt to folders, where a block that two tasks have
        read gets two bitmaps of a trigram.
        """
        spark = articles.sparkSession
        # A partition's numbers start at a multiple of 2^33, so no block is in two.
        articles.select("id", *fields).withColumn("n", F.monotonically_increasing_id()).write.parquet(f"{path}/texts")
        texts = spark.read.parquet(f"{path}/texts")
        maps = _maps(texts, fields).withColumn("folder", (F.crc32("gram") % folders).cast("int"))
        maps.hint("rebalance", "folder").sortWithinPartitions("folder", "gram", "field", "block").write.option("compression", "zstd").partitionBy("folder").parquet(f"{path}/grams")
        blocks = texts.select(F.expr(f"n div {BLOCK}").alias("block")).agg(F.count_distinct("block").alias("blocks"))
        partial = not spark.read.schema("field string, gram string, block bigint").parquet(f"{path}/grams").groupBy("field", "gram", "block").count().filter("count > 1").isEmpty()
        blocks.select(F.array(*map(F.lit, fields)).alias("fields"), F.lit(folders).alias("folders"), "blocks", F.lit(partial).alias("partial")).write.json(f"{path}/options")
        return cls(spark, path)

    def grams_in(self, query: str) -> list[str]:
        """The trigrams that a text with the query must have."""
        runs = literals(query)
        if not any(len(r) >= 3 for r in runs):
            return []
        # A local relation: the fold runs while the plan is made, without a job.
        folded = self.spark.sql("SELECT r FROM VALUES (:r) AS t(r)", args={"r": "\0".join(runs)}).select(fold(F.col("r"))).first()[0]
        return sorted(set().union(*map(grams_of, folded.split("\0"))))

    def candidates(self, wanted: list[str]) -> DataFrame:
        """(block, and a bitmap for each field) of the articles that hold all wanted trigrams in that field."""
        folders = sorted({folder_of(g, self.folders) for g in wanted})
        maps = self.grams.filter(F.col("folder").isin(folders) & F.col("gram").isin(wanted))
        if self.partial:
            maps = maps.groupBy("block", "gram", "field").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        own = [F.col("field") == f for f in self.fields]
        counts = [F.count_if(o).alias(f"n{k}") for k, o in enumerate(own)]
        # An AND of nothing has all bits set, and so has one of nulls; the counts tell.
        both = [F.bitmap_and_agg(F.when(o, F.col("bitmap"))).alias(f"bitmap{k}") for k, o in enumerate(own)]
        met = maps.groupBy("block").agg(*counts, *both)
        kept = [F.when(F.col(f"n{k}") == len(wanted), F.col(f"bitmap{k}")).alias(f"bitmap{k}") for k in range(len(own))]
        return met.select("block", *kept).filter(" OR ".join(f"bitmap_count(bitmap{k}) > 0" for k in range(len(own))))

    def like(self, query: str, ignore_case: bool = False) -> DataFrame:
        """(id, and the fields) of the articles with %query% in a field; the same rows as a scan finds."""
        matches = like(query, list(self.fields), ignore_case)
        wanted = self.grams_in(query)
        if not wanted:
            return self.texts.filter(matches).drop("n")
        found = self.candidates(wanted)
        # 4 KB a block and field, and no more than MAX_BLOCKS.
        blocks = (found if self.blocks <= MAX_BLOCKS else found.limit(MAX_BLOCKS + 1)).collect()
        if len(blocks) > MAX_BLOCKS:
            def has(k: int) -> Column:
                byte = f"cast(conv(hex(substring(bitmap{k}, cast(place div 8 as int) + 1, 1)), 16, 10) as int)"
                return F.coalesce(F.expr(f"(shiftright({byte}, cast(place % 8 as int)) & 1) = 1"), F.lit(False))

            dealt = self.texts.withColumns({"block": F.expr(f"n div {BLOCK}"), "place": F.col("n") % BLOCK})
            either = has(0)
            for k in range(1, len(self.fields)):
                either = either | has(k)
            return dealt.join(found, "block").filter(either).filter(matches).select("id", *self.fields)
        sets = {r["block"]: reduce(or_, (np.frombuffer(m, dtype=np.uint8) for m in r[1:] if m is not None)) for r in blocks}
        numbers = [block * BLOCK + int(i) for block, bits in sets.items() for i in np.flatnonzero(np.unpackbits(bits, bitorder="little"))]
        near = F.lit(False)
        if 0 < len(numbers) <= MAX_NUMBERS:
            near = F.expr(f"n IN ({', '.join(map(str, numbers))})")
        elif numbers:
            for block in sets:
                near = near | F.col("n").between(block * BLOCK, block * BLOCK + BLOCK - 1)
        return self.texts.filter(near).filter(matches).drop("n")
