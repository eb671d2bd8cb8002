"""JSON lines and tables: schemas, explicit row order, and writers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of articles and of search documents, as stored files have them.
ENTITY = T.StructType([T.StructField("text", T.StringType()), T.StructField("type", T.StringType())])
ARTICLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "url", "title", "content", "published_at", "crawled_at", "source", "source_domain", "source_type", "category_raw", "category_normalized", "author", "language")]
    + [T.StructField("keywords", T.ArrayType(T.StringType())), T.StructField("entities", T.ArrayType(ENTITY)), T.StructField("content_length", T.IntegerType()), T.StructField("has_full_content", T.BooleanType())]
)
READY = T.StructType(
    ARTICLE.fields
    + [T.StructField("dup_group_id", T.StringType()), T.StructField("is_canonical", T.BooleanType()), T.StructField("dup_count", T.LongType())]
    + [T.StructField("publish_date", T.DateType()), T.StructField("publish_hour", T.IntegerType()), T.StructField("publish_dow", T.IntegerType()), T.StructField("word_count", T.IntegerType())]
)
#: What search keeps of an article.
SEARCH_FIELDS = [
    "id", "url", "title", "content", "published_at", "crawled_at", "source", "category_normalized", "author", "keywords", "entities",
    "publish_date", "publish_hour", "publish_dow", "is_canonical", "dup_group_id", "dup_count", "content_length", "has_full_content", "word_count",
]


def expand_inputs(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The files that glob patterns name: patterns in their order, files of one by their whole paths, each file once.

    So `x.jsonl` comes before `x_2026-05.jsonl`. Partition sets have an order of their own, see `partition_order`.
    """
    names: list[str] = []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for pattern in patterns:
        where = hadoop.Path(pattern)
        found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
        paths = [str(f.getPath()) for f in found]
        names += sorted(paths)
    return list(dict.fromkeys(names))


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType = ARTICLE) -> DataFrame:
    """Lines of JSON with a fixed schema; broken and blank lines are skipped, unknown fields dropped; .gz is read too."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def count_broken(spark: SparkSession, paths: str | list[str], schema: T.StructType = ARTICLE) -> int:
    """How many lines read_jsonl skips."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").json(paths)
    # The column of broken records can't be read alone, so another is read with it.
    both = rows.agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("broken"), F.count(schema.fields[0].name))
    return both.first()["broken"]


def with_sequence(rows: DataFrame, rank: int | Column = 0) -> DataFrame:
    """rows with _seq: source rank, file path, offset of the file's split, then the order within it.

    Sorting by it gives back the order of files and lines. Apply to rows as they are read.
    """
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return rows.select("*", F.struct(rank.alias("rank"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("_seq"))


def partition_order(path: Column) -> Column:
    """Orders a partition set as base_2024-01.jsonl, base_2024-02.jsonl, ..., base.jsonl: the current file last."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.struct((~name.rlike(r"_\d{4}-\d{2}(_\d+)?\.jsonl")).alias("current"), name.alias("name"))


def union_all(*parts: DataFrame) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every


def write_jsonl(rows: DataFrame, path: str, max_records: int = 100_000, mode: str = "overwrite", gzip: bool = False) -> None:
    """Rotated JSON lines; overwrite clears all parts first."""
    writer = rows.write.mode(mode).option("maxRecordsPerFile", max_records)
    (writer.option("compression", "gzip") if gzip else writer).json(path)


def write_monthly(rows: DataFrame, path: str, day: str = "publish_date", sort: list[str] | None = None, mode: str = "append") -> None:
    """Parquet in a folder for each month, sorted within files by `sort` so that row groups can be skipped.

    Rows of a month spread over as many files as Spark finds fit; rows without a day go to month 0.
    """
    month = F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))
    dated = rows.withColumn("ym", month)
    dated = dated.hint("rebalance", "ym").sortWithinPartitions("ym", *(sort or [day]))
    dated.write.mode(mode).partitionBy("ym").parquet(path)


def in_months(rows: DataFrame, as_of: date, days: int, day: str = "publish_date") -> DataFrame:
    """Rows of the last days + 1 days of a table by write_monthly: the month is compared too, so folders are pruned."""
    first = as_of - timedelta(days=days)
    return rows.filter((F.col("ym") >= first.year * 100 + first.month) & (F.col(day) >= F.lit(first)))
