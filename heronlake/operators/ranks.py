"""Exact values at ranks of groups of any size, without a buffer or a sort of a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a group's distinct values are cut into; one task sorts those of one range.
RANGES = 128
#: Values for each range that a group's cuts are chosen from.
SAMPLE = 10


def values_at(rows: DataFrame, keys: list[str], value: str, ranks: dict[str, Column], ranges: int = RANGES) -> DataFrame:
    """(keys, a column for each rank): the values at 0-based ranks of each group in ascending order, nulls left out.

    A rank is an expression over n, the number of the group's values; outside of 0 to n - 1 it gives null, and a group all of
    whose ranks lie outside, or which has no values, has no row. Without keys there is one row, of nulls if need be. Null
    keys are a group; NaN is the greatest value. Other columns, whatever their names, play no part.

    Equal values are counted first. A sample by hash cuts the distinct values of a group into ranges, an exact histogram tells
    which ranges hold the ranks, and only these are sorted. The sample settles how even the ranges are, never a result. The cuts
    are needed twice and may be made twice, so they follow from the values alone; a sketch's follow from the order of merging too.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    rows = rows.filter(F.col(value).isNotNull()).select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(value).alias("__v"))
    counts = rows.groupBy(*names, "__v").agg(F.count("*").alias("__c"))
    distinct = counts.groupBy(*names).agg(F.count("*").alias("__m"))
    # About SAMPLE values for each range, of a group with fewer values all.
    chosen = F.when(F.pmod(F.xxhash64("__v"), F.col("__m")) < SAMPLE * ranges, F.col("__v"))
    bounds = join_groups(counts, distinct, names).groupBy(*names).agg(F.sort_array(F.collect_list(chosen)).alias("__chosen"), F.sum("__c").alias("n"))
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("__chosen", F.floor(i * F.size("__chosen") / ranges).cast("int")))
    placed = join_groups(counts, bounds.withColumn("__cuts", F.array_distinct(at)).drop("__chosen"), names)
    placed = placed.withColumn("__range", F.size(F.filter("__cuts", lambda c: c < F.col("__v")))).drop("__cuts")
    # At most `ranges` rows a group.
    sizes = placed.groupBy(*names, "__range").agg(F.sum("__c").alias("__size"), F.first("n").alias("n"))
    before = F.sum("__size").over(Window.partitionBy(*names).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    sizes = sizes.withColumn("__before", before)
    inside = F.lit(False)
    for rank in ranks.values():
        inside = inside | ((rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__size")))
    held = join_groups(placed.drop("n"), sizes.filter(inside).drop("__size"), [*names, "__range"])
    upto = F.sum("__c").over(Window.partitionBy(*names, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before")
    held = held.withColumn("__upto", upto)
    found = held.groupBy(*names).agg(*(F.max(F.when((rank >= F.col("__upto") - F.col("__c")) & (rank < F.col("__upto")), F.col("__v"))).alias(k) for k, rank in ranks.items()))
    return found.select(*(F.col(n).alias(k) for k, n in zip(keys, names, strict=True)), *ranks)


def percentiles(rows: DataFrame, keys: list[str], value: str, fractions: dict[str, float], ranges: int = RANGES) -> DataFrame:
    """(keys, a column for each fraction): exact percentiles, interpolated between neighbouring ranks, as doubles."""
    ranks: dict[str, Column] = {}
    for i, p in enumerate(fractions.values()):
        place = F.lit(float(p)) * (F.col("n") - 1)
        ranks |= {f"__low{i}": F.floor(place), f"__high{i}": F.ceil(place)}
    sized = rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("__size"))
    found = join_groups(sized, values_at(rows, keys, value, ranks, ranges), keys)
    made = []
    for i, (name, p) in enumerate(fractions.items()):
        place, low, high = F.lit(float(p)) * (F.col("__size") - 1), F.col(f"__low{i}").cast("double"), F.col(f"__high{i}").cast("double")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        made.append(F.when(F.floor(place) == F.ceil(place), low).otherwise(between).alias(name))
    return found.select(*keys, *made)


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The rows of left with the columns of right's group, null keys included; without keys, right has one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row
    names, same = [f"__r{i}" for i in range(len(keys))], F.lit(True)
    right = right.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), *(c for c in right.columns if c not in keys))
    for k, n in zip(keys, names, strict=True):
        same = same & left[k].eqNullSafe(right[n])
    return left.join(right, same, how).drop(*names)
