"""Mixing sources to target weights by size-weighted pivotal rounding.

Every source gets a target in words: the whole corpus shared by weight, no source above `max_copies` times its own
size, what is cut off reshared by weight until no source is above (solved in closed form with running sums). A row of
a source with rate = target / size is taken floor(rate) times, and a fractional copy probability remains. Those are
settled by pivotal dependent rounding: two rows meet, and mass (probability times words) moves from one to the other
until one probability is 0 or 1. Either direction is drawn so that both expectations are kept, and the words taken
stay the same. The reduction is a tree: rows are dealt by hash to chunks of about `chunk` rows, each chunk leaves at
most one fractional row, and these residuals are dealt to chunks again until a source has one chunk only. So a hot
source spreads over all tasks, and the words that a source takes differ from its target by less than one row's size.

Everything is DataFrame functions; draws are hashes of the seed and the ids, so reruns agree.

Defined cases: a null text has size 0; rows of size 0 take nothing; the null source is a source and ranks last;
rows that agree in id, source and size share their copies as evenly as whole numbers allow; an empty table gives an
empty result; further columns are kept, and the columns that this adds replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.llm.support import row_hash, words_in, written

CHUNK = 64
#: A probability closer than this to 0 or 1 counts as 0 or 1.
NEAR = 1e-9
ADDED = ("size", "source_size", "target", "taken", "copies")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """(source, source_size, n_units, weight, target) from rows (source, size, ...)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_units"))
    # One row a source from here on.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = sources.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    sources = sources.withColumn("__cap", F.col("source_size") * F.lit(float(max_copies)))
    everything = Window.partitionBy()
    up = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    onward = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # With sources in the order of cap / weight, the first whose share fits under its cap fixes the level for all after it.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    sources = sources.withColumn("__level", level).withColumn("__fits", F.col("__level") * F.col("weight") <= F.col("__cap"))
    sources = sources.withColumn("__share", F.min(F.when(F.col("__fits"), F.struct((F.col("__cap") / F.col("weight")).alias("r"), F.col("__level").alias("l")))).over(everything)["l"])
    target = F.least(F.col("__cap"), F.coalesce(F.col("__share") * F.col("weight"), F.col("__cap")))
    return sources.select("source", "source_size", "n_units", "weight", target.alias("target"))


def _fold(level: int, seed: int) -> str:
    """SQL that runs the pivotal steps over a chunk's sorted array `units`; gives (left, settled)."""
    unit = "struct<id:bigint,size:bigint,p:double>"
    draw = f"pmod(xxhash64({seed}L, {level}, s.left.id, s.left.size, x.id, x.size), 9007199254740992L) / 9007199254740992D"
    # a, b: the chance of each after the mass has moved from the left unit to x, or from x to the left unit.
    step = f"""
      transform(array(named_struct(
        'give', least(s.left.size * s.left.p, x.size * (1D - x.p)),
        'take', least(x.size * x.p, s.left.size * (1D - s.left.p)))), d ->
      transform(array(IF({draw} * (d.give + d.take) < d.take,
        named_struct('a', s.left.p - d.give / s.left.size, 'b', x.p + d.give / x.size),
        named_struct('a', s.left.p + d.take / s.left.size, 'b', x.p - d.take / x.size))), n ->
      named_struct(
        'left', IF(n.a > {NEAR}D AND n.a < 1D - {NEAR}D, named_struct('id', s.left.id, 'size', s.left.size, 'p', n.a),
                IF(n.b > {NEAR}D AND n.b < 1D - {NEAR}D, named_struct('id', x.id, 'size', x.size, 'p', n.b), CAST(NULL AS {unit}))),
        'settled', concat(s.settled,
          IF(n.a > {NEAR}D AND n.a < 1D - {NEAR}D, CAST(array() AS array<{unit}>), array(named_struct('id', s.left.id, 'size', s.left.size, 'p', round(n.a)))),
          IF(n.b > {NEAR}D AND n.b < 1D - {NEAR}D AND NOT (n.a > {NEAR}D AND n.a < 1D - {NEAR}D), CAST(array() AS array<{unit}>), array(named_struct('id', x.id, 'size', x.size, 'p', round(n.b))))))
      )[0])[0]"""
    return f"""
      aggregate(transform(array_sort(units), u -> named_struct('id', u.id, 'size', u.size, 'p', u.p)),
        CAST(named_struct('left', CAST(NULL AS {unit}), 'settled', array()) AS struct<left:{unit},settled:array<{unit}>>),
        (s, x) -> CAST(IF(s.left IS NULL, named_struct('left', x, 'settled', s.settled), {step}) AS struct<left:{unit},settled:array<{unit}>>))"""


def mix_sources(rows: DataFrame, id_column: str = "doc_id", text: str | None = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 20177, chunk: int = CHUNK) -> DataFrame:
    """rows with size, source_size, target, copies and taken (= copies * size). text=None: rows hold their size already.

    Only id, source and size of a row travel in the reduction; the rows themselves are joined once, at the end. Weights go
    to sources by their rank, which one task finds: sources are few, and hosts in their place would need another rule.
    """
    if text is None:
        own = rows.drop(*(c for c in ADDED if c != "size"))
        sized = own.withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
    else:
        own = rows.drop(*ADDED) if text not in ADDED else rows
        sized = own.withColumn("size", words_in(text))
    narrow = written(sized.select(F.col(id_column).cast("long").alias("id"), F.col(source).alias("source"), "size"), "mix-sizes")
    # Units: rows that can't be told apart by id, source and size.
    units = narrow.groupBy("id", "source", "size").agg(F.count("*").alias("m"))
    targets = written(source_targets(narrow, weights, max_copies), "mix-targets")
    rated = units.join(targets, units["source"].eqNullSafe(targets["source"]), "left").drop(targets["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = rated.withColumn("whole", F.floor(rate + NEAR)).withColumn("__x", F.greatest(rate - F.col("whole"), F.lit(0.0)) * F.col("m"))
    rated = rated.withColumn("plus", F.floor(F.col("__x") + NEAR)).withColumn("p", F.greatest(F.col("__x") - F.col("plus"), F.lit(0.0)))
    rated = written(rated.select("id", "source", "size", "m", "source_size", "n_units", "target", "whole", "plus", "p"), "mix-units")

    # Residuals of each level go to chunks by hash; the number of chunks follows from the source's count alone.
    left = rated.filter((F.col("p") > NEAR) & (F.col("p") < 1 - NEAR) & (F.col("size") > 0)).select("source", "n_units", "id", "size", "p")
    settled = []
    most = rated.agg(F.max("n_units")).first()[0] or 0
    level = 0
    while True:
        n_chunks = F.greatest(F.ceil(F.col("n_units") / F.lit(float(chunk) ** (level + 1))), F.lit(1)).cast("long")
        mixed = F.xxhash64(F.lit(seed), F.lit(level), "id", "size")
        dealt = left.select("source", "n_units", F.pmod(mixed, n_chunks).alias("chunk"), F.struct(F.xxhash64(F.lit(seed + 1), "id", "size").alias("h"), "id", "size", "p").alias("u"))
        folded = dealt.groupBy("source", "n_units", "chunk").agg(F.collect_list("u").alias("units")).select("source", "n_units", F.expr(_fold(level, seed)).alias("s"))
        folded = written(folded, f"mix-level{level}")
        settled.append(folded.select("source", F.inline("s.settled")))
        left = folded.filter("s.left is not null").select("source", "n_units", "s.left.*")
        level += 1
        if most <= float(chunk) ** level:
            break
    last = F.pmod(F.xxhash64(F.lit(seed + 2), "id", "size"), F.lit(1 << 53)) / F.lit(float(1 << 53)) < F.col("p")
    settled.append(left.select("source", "id", "size", last.cast("double").alias("p")))
    bits = settled[0]
    for part in settled[1:]:
        bits = bits.unionByName(part)
    bits = bits.select(F.col("source").alias("__source"), F.col("id").alias("__id"), F.col("size").alias("__size"), F.col("p").cast("long").alias("bit"))

    same = (F.col("id").eqNullSafe(F.col("__id"))) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size"))
    fallback = F.when(F.col("p") >= 1 - NEAR, 1).when((F.col("size") == 0) & (F.pmod(F.xxhash64(F.lit(seed + 3), "id"), F.lit(1 << 20)) < F.col("p") * (1 << 20)), 1).otherwise(0)
    decided = rated.join(bits, same, "left").select(
        F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("m").alias("__m"), "source_size", "target",
        (F.col("m") * F.col("whole") + F.col("plus") + F.coalesce("bit", fallback)).alias("__copies"),
    )
    # Rows that tie are told apart by a hash, made before they travel.
    joined = sized.withColumn("__row", row_hash(own)).join(decided, F.col(id_column).cast("long").eqNullSafe(F.col("__id")) & F.col(source).eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    columns = list(dict.fromkeys([*own.columns, "size", "source_size", "target"]))
    ties = not rated.filter("m > 1").isEmpty()
    one = joined.filter("__m = 1") if ties else joined
    found = one.select(*columns, F.col("__copies").cast("long").alias("copies"))
    if ties:
        order = Window.partitionBy("__id", "__source", "__size").orderBy("__row")
        several = joined.filter("__m > 1").withColumn("__r", F.row_number().over(order))
        found = found.unionByName(several.select(*columns, (F.expr("__copies div __m") + F.when(F.expr("__r <= __copies % __m"), 1).otherwise(0)).cast("long").alias("copies")))
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def take_mix(rows: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of rows."""
    clash = {c: f"__own_{c}" for c in rows.columns if c in ADDED}
    mixed = mix_sources(rows.withColumnsRenamed(clash), **options)
    mixed = mixed.filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return mixed.drop(*ADDED, "__copy").withColumnsRenamed({v: k for k, v in clash.items()}).select(*rows.columns)
