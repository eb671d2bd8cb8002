"""Deduplication and merging with an explicit row order.

Spark has no row order, so every operator that prefers earlier rows takes it as columns (`order`); see
`sources.tables.with_sequence` for files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.functions.entities import union_keywords
from heronlake.functions.text import title_hash
from heronlake.functions.vocab import FULL_LENGTH


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; rows without a key are dropped.

    An aggregate with partial minima, so a hot key sends one row for each task, not all of its rows.
    """
    keyed = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    best = F.min_by(F.struct(*rows.columns), F.struct(*order))
    return keyed.groupBy(F.col(key).alias("__key")).agg(best.alias("row")).select("row.*")


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key: an upsert by id."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(F.col(key).alias("__key")).agg(best.alias("row")).select("row.*")


def merge_fold(rows: DataFrame, key: str, order: list[str], content: str = "content", keywords: str = "keywords") -> DataFrame:
    """One row for each key: copies are folded in order, the strictly longer content wins, keywords are united with the
    winner's first, and the lengths are computed again.

    Aggregates with partial results do the fold, so no group is gathered, however many copies a key has. A copy that
    is longer than all before it goes before what is folded so far, every other copy goes after it; so keywords are in the
    order of these record copies, longest first, and then of their first place among the others. The records follow
    from the first copy of each length.
    """
    size = F.coalesce(F.length(content), F.lit(0))
    place = F.struct(*order, *(c for c in rows.columns if c not in order and c != content))
    keyed = rows.withColumns({"__key": F.col(key), "__less": -size, "__place": place})
    best = keyed.groupBy("__key").agg(F.min(F.struct("__less", "__place", content)).alias("best"))
    won = best.select("__key", *(F.col("best")[c].alias(c) if c == content else F.col("best.__place")[c].alias(c) for c in rows.columns))

    first = keyed.groupBy("__key", "__less").agg(F.min("__place").alias("__place"))
    longer = Window.partitionBy("__key").orderBy("__less").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("__before", F.min("__place").over(longer))
    records = first.filter(F.col("__before").isNull() | (F.col("__place") < F.col("__before")))
    of_records = records.select("__key", "__less", F.posexplode(F.col("__place")[keywords]).alias("__i", "__word"))
    of_records = of_records.select("__key", "__word", F.struct("__less", "__i").alias("__record"))
    of_all = keyed.select("__key", F.struct(*order).alias("__at"), F.posexplode(keywords).alias("__i", "__word"))
    of_all = of_all.select("__key", "__word", F.struct("__at", "__i").alias("__first"))
    both = of_records.unionByName(of_all, allowMissingColumns=True).groupBy("__key", "__word").agg(F.min("__record").alias("__record"), F.min("__first").alias("__first"))
    ranked = F.array_sort(F.collect_list(F.struct(F.col("__record").isNull().alias("late"), "__record", "__first", F.col("__word").alias("word"))))
    words = both.groupBy(F.col("__key").alias("__k")).agg(F.transform(ranked, lambda x: x["word"]).alias("__words"))

    merged = won.join(words, F.col("__key").eqNullSafe(F.col("__k")), "left").withColumn(keywords, union_keywords(F.col("__words"), F.lit(None).cast("array<string>"))).select(*rows.columns)
    length = F.coalesce(F.length(content), F.lit(0))
    return merged.withColumn("content_length", length).withColumn("has_full_content", length >= FULL_LENGTH)


def append_if_absent(stored: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of new to append to stored: the first of each key that isn't stored yet."""
    return first_wins(new, key, order).join(stored.select(key), key, "left_anti").select(*new.columns)


def not_yet_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in done, whatever done holds beside it."""
    return rows.join(done.select(key), key, "left_anti").select(*rows.columns)


def near_dup_groups(articles: DataFrame, order: list[str], title: str = "title", length: str = "content_length", full: str = "has_full_content") -> DataFrame:
    """articles with dup_group_id (empty for single rows), is_canonical and dup_count, by equal title keys.

    The canonical row is the fullest, then the longest, then the first. The choice travels as one struct a group with
    partial maxima; the rows join it by key, where Spark can split a hot title among tasks.
    """
    rank = F.struct(F.coalesce(F.col(full), F.lit(False)).alias("f"), F.coalesce(F.col(length), F.lit(0)).alias("n"))
    keyed = articles.withColumn("__h", title_hash(F.col(title)))
    # Narrow rows decide: the first of each rank of a group, then the best rank. Whole rows join once.
    first = keyed.select("__h", rank.alias("__rank"), F.struct(*order).alias("__at")).groupBy("__h", "__rank").agg(F.min("__at").alias("__at"), F.count("*").alias("__n"))
    best = first.groupBy("__h").agg(F.max("__rank").alias("__best"), F.max_by("__at", "__rank").alias("__first"), F.sum("__n").alias("dup_count"))
    best = best.select(F.concat("__h", F.lit("")).alias("__k"), "__best", "__first", "dup_count")
    marked = keyed.join(best, F.col("__h") == F.col("__k"))
    canonical = (rank == F.col("__best")) & (F.struct(*order) == F.col("__first"))
    group = F.when(F.col("dup_count") > 1, F.col("__h")).otherwise("")
    return marked.select(*articles.columns, group.alias("dup_group_id"), canonical.alias("is_canonical"), "dup_count")


def near_dup_groups_windowed(articles: DataFrame, order: list[str], title: str = "title", length: str = "content_length", full: str = "has_full_content") -> DataFrame:
    """The same by windows: one shuffle instead of three, for corpora without hot titles."""
    keyed = articles.withColumn("__h", title_hash(F.col(title)))
    group = Window.partitionBy("__h")
    place = F.row_number().over(group.orderBy(F.coalesce(F.col(full), F.lit(False)).desc(), F.coalesce(F.col(length), F.lit(0)).desc(), *order))
    n = F.count("*").over(group)
    return keyed.select(*articles.columns, F.when(n > 1, F.col("__h")).otherwise("").alias("dup_group_id"), (place == 1).alias("is_canonical"), n.alias("dup_count"))


def group_stats(grouped: DataFrame) -> DataFrame:
    """dup_groups and dup_records of near_dup_groups' rows."""
    return grouped.agg(
        F.count_distinct(F.when(F.col("dup_group_id") != "", F.col("dup_group_id"))).alias("dup_groups"),
        F.count_if((F.col("dup_group_id") != "") & ~F.col("is_canonical")).alias("dup_records"),
    )
