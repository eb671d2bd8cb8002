"""Which filter removes what: every order of a set of filters, audited from counts of failure masks.

Each document gets a mask with a bit for each filter that it fails. All that an order of filters does to a part of the
corpus follows from how many documents of the part have each mask, so documents are read for their masks, and the orders
are worked out on at most 2^n counts a part.

One filter needs other documents: a text that is identical to that of a document with a smaller id. Copies are found by
partition refinement. Texts are split by their number of code points, then by the hashes of successive blocks, and after
each split the classes of one text are dropped. Classes travel as counts, and rows of 60 bytes or so are what is split.
Only texts of the classes that survive are read again and compared in full, as the key of an aggregation, so a task sends
one row for all copies that it has. Hashes therefore decide nothing: two texts of one class that differ, as equal hashes
may let them, are told apart by their texts.

A bitmap of the surviving classes, at most MAX_BITS / 8 bytes whatever the input, keeps other texts from being moved. Beyond
what it can tell apart more texts are moved, with the same result.

Everything is DataFrame functions.

Defined cases: a null text is empty; a null part and an empty one are the part named by the empty string; a null id is above
every other, and null ids are no copies of each other; rows with the same id and text are no copies of each other; of
several labels for an id any that says 1 counts, and a null id has none; an empty table has no parts and gives no rows;
other columns aren't read, and none of the names used in between can clash with them.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heronlake.llm.exact_dedup import BUCKET, bit_at, filter_bits
from heronlake.llm.support import WHITE, written

#: The filters in the order of their bits.
FILTERS = "ABCDE"
#: Code points of the successive blocks whose hashes split a class; the last block is all the rest.
BLOCKS = (128, 4096)
MAX_BITS = 1 << 29


def own_failures(text: Column) -> Column:
    """The mask of the filters that judge a text by itself: A short, B repetitive, C capitals, D symbols."""
    words = F.array_remove(F.split(text, WHITE), "")
    fails = (
        F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text), text.rlike(r"[#$%&*|]"),
    )
    mask = F.lit(0)
    for k, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    return mask


def splits(text: Column, blocks: tuple[int, ...] = BLOCKS, keys: int | None = None) -> list[Column]:
    """The class of a text after each split: by its length, then by each block's hash. keys: classes at most, for tests."""
    found, at = [F.length(text).cast("long")], 1
    for size in (*blocks, None):
        block = F.substring(text, at, size) if size else F.substring(text, at, 2**31 - 1)
        key = F.xxhash64(found[-1], block)
        found.append(key if keys is None else F.pmod(key, F.lit(keys)).cast("long"))
        at += size or 0
    return found


def refine(prints: DataFrame, classes: list[str]) -> DataFrame:
    """The rows of prints whose class still has another row after every split."""
    for k, split in enumerate(classes):
        shared = prints.groupBy(F.col(split).alias("__class")).agg(F.count("*").alias("__n")).filter("__n > 1")
        # Written, so that both sides of the join are dealt anew and Spark can split a class that most rows are in.
        shared = written(shared.select("__class"), f"audit-classes-{k}")
        prints = written(prints.join(shared, F.col(split) == F.col("__class"), "left_semi"), f"audit-rows-{k}")
    return prints


def _in_bitmaps(rows: DataFrame, key: str, held: DataFrame, max_bits: int) -> DataFrame:
    """The rows whose key may be among those of held, without moving any."""
    bits = filter_bits(held.count(), 16, max_bits)
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    maps = held.select(at.alias("__at")).groupBy(F.expr(f"__at div {BUCKET}").alias("__bucket")).agg(F.expr(f"bitmap_construct_agg(__at % {BUCKET})").alias("__map"))
    maps = written(maps, "audit-bits")
    # max_bits / 8 bytes at most, whatever the input
    tested = rows.withColumn("__at", at).join(F.broadcast(maps), F.expr(f"__at div {BUCKET} = __bucket"))
    return tested.filter(bit_at("__map", "__at")).select(*rows.columns)


def mark_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id", carry: dict[str, Column] | None = None, blocks: tuple[int, ...] = BLOCKS, keys: int | None = None, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, copy, and `carry` as given): a row for each document; copy tells whether a smaller id has the identical text."""
    carry = carry or {}
    whole = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), *(c.alias(n) for n, c in carry.items()))
    names = [f"__split{k}" for k in range(len(blocks) + 2)]
    last = names[-1]
    whole = whole.select("*", *(c.alias(n) for c, n in zip(splits(F.col("__text"), blocks, keys), names, strict=True)))
    prints = written(whole.drop("__text"), "audit-prints")
    held = written(refine(prints, names).select(last).distinct(), "audit-survivors")
    suspects = _in_bitmaps(whole, last, held, max_bits)
    # The full texts are compared as a key: a copy that meets its like in a task goes no further.
    per_text = suspects.select("id", last, "__text").groupBy(last, "__text").agg(F.min("id").alias("__least"))
    least = written(per_text.select(F.col(last).alias("__class"), "__least"), "audit-least")
    mixed = written(least.groupBy("__class").agg(F.count("*").alias("__n")).filter("__n > 1").select("__class"), "audit-mixed")
    copy = F.coalesce(F.col("id") > F.col("__least"), F.col("id").isNull() & F.col("__least").isNotNull())
    out = ["id", copy.alias("copy"), *carry]
    if mixed.isEmpty():
        return prints.join(least, F.col(last) == F.col("__class"), "left").select(*out)
    # Some classes hold texts that differ: their rows, and no others, are matched by text.
    plain = prints.join(mixed, F.col(last) == F.col("__class"), "left_anti").join(least, F.col(last) == F.col("__class"), "left").select(*out)
    of_mixed = whole.join(mixed, F.col(last) == F.col("__class"), "left_semi")
    by_text = of_mixed.groupBy(F.col("__text").alias("__t")).agg(F.min("id").alias("__least"))
    return plain.unionByName(of_mixed.join(by_text, F.col("__text") == F.col("__t")).select(*out))


def order_effects(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders of
    the filters, from (part, mask, n, good, toxic): how many documents fail just these filters."""
    size, every = len(filters), (1 << len(filters)) - 1
    # Documents that pass all filters of a set, for each set; a mask adds to the sets that it doesn't meet.
    passed = masks.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(every)))).filter("(mask & set) = 0")
    passed = passed.groupBy("part", "set").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    # 2^n entries a part at most.
    of_part = passed.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("set", F.struct("n", "good", "toxic")))).alias("passed"))

    def count(which: str, field: str = "n") -> str:
        return f"coalesce(try_element_at(passed, {which}).{field}, 0L)"

    shares = []
    for k in range(size):
        terms = []
        for others in range(1 << size):
            if not others >> k & 1:
                ways = factorial(others.bit_count()) * factorial(size - 1 - others.bit_count())
                terms.append(f"{ways}L * ({count(str(others))} - {count(str(others | 1 << k))})")
        shares.append(" + ".join(terms))
    of_part = of_part.withColumn("shares", F.expr(f"array({', '.join(shares)})"))
    steps = []
    for order in permutations(range(size)):
        name, before = "".join(filters[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append({"filter_order": name, "step": step, "k": k, "before": before, "after": before | 1 << k})
            before |= 1 << k
    each = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, k int, before int, after int>>")
    rows = of_part.select("part", "passed", "shares", F.inline(each))
    removed = f"{count('before')} - {count('after')}"
    one = "shiftleft(1, k)"
    return rows.selectExpr(
        "part", "filter_order", "step", f"{count('after')} AS kept", f"{removed} AS removed", f"{count('0')} - {count(one)} - ({removed}) AS redundant",
        f"{count(f'{every} - {one}')} - {count(str(every))} AS unique_fails", f"{count('before', 'good')} - {count('after', 'good')} AS good_lost",
        f"{count('before', 'toxic')} - {count('after', 'toxic')} AS toxic_lost", "shares[k] AS shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", part: str = "source", **options) -> DataFrame:
    """What each of the five filters does in each of their orders, for each part of docs; see `order_effects`.

    labels: (doc_id, quality, toxic); documents without a label count in no loss.
    """
    carry = {"part": F.coalesce(F.col(part).cast("string"), F.lit("")), "mask": own_failures(F.coalesce(F.col(text), F.lit("")))}
    marked = mark_copies(docs, text, id_column, carry, **options)
    of = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    of = written(of, "audit-labels")
    judged = marked.join(of, F.col("id") == F.col("__id"), "left").withColumn("mask", F.col("mask") + F.when(F.col("copy"), 1 << FILTERS.index("E")).otherwise(0))
    masks = judged.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return order_effects(written(masks, "audit-masks"))
