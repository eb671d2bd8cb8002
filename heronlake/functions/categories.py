"""Categories: an ordered lookup by equality, else by containment either way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.functions.text import trimmed
from heronlake.functions.vocab import CATEGORY_GROUPS


def ordered_keys(groups: dict[str, list[str]]) -> list[tuple[str, str]]:
    return [(key, label) for label, keys in groups.items() for key in keys]


def bound(x: Column, made: Callable[[Column], Column]) -> Column:
    """made of x, which is computed once however often made uses it, also within its lambdas."""
    return F.element_at(F.transform(F.array(x), made), 1)


def lookup_expression(raw: Column, groups: dict[str, list[str]] = CATEGORY_GROUPS, fallback: str = "other") -> Column:
    """The label of a raw value, as an expression over an array of the keys in their order."""
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in ordered_keys(groups)))

    def label(key: Column) -> Column:
        exact = F.filter(pairs, lambda p: p["k"] == key)
        partial = F.filter(pairs, lambda p: F.contains(key, p["k"]) | F.contains(p["k"], key))
        return F.coalesce(F.try_element_at(exact, F.lit(1))["v"], F.try_element_at(partial, F.lit(1))["v"], F.lit(fallback))

    return bound(F.coalesce(raw, F.lit("")), lambda r: F.when(r == "", fallback).otherwise(bound(F.lower(trimmed(r)), label)))


def with_category(rows: DataFrame, raw: str, out: str, groups: dict[str, list[str]] = CATEGORY_GROUPS, fallback: str = "other") -> DataFrame:
    """rows with the label of raw in out.

    The lookup stands in each row. A join by raw would deal the rows by a few values, the most frequent to one task, and would
    need whatever gives the rows twice.
    """
    return rows.withColumn("__label", lookup_expression(F.col(raw), groups, fallback)).drop(out).withColumnRenamed("__label", out)
