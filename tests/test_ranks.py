"""Values at ranks beside sorted lists; plans without a buffer of a group."""

import random

import pytest
from pyspark.sql import functions as F

from heronlake.operators import profile, ranks, reports


def grouped(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("ranges", [2, 7, 128])
def test_values_at_ranks_equal_sorted_lists(spark, ranges):
    r = random.Random(ranges)
    rows = [("hot", r.randrange(10**6)) for _ in range(3000)] + [("ties", r.randrange(3)) for _ in range(500)] + [("wide", r.choice([-1, 1]) * 2 ** r.randrange(62)) for _ in range(200)]
    rows += [(None, 5), (None, None), ("one", -4), ("nothing", None)]
    wanted = {"first": F.lit(0), "middle": F.expr("n div 2"), "late": F.expr("cast(floor(n * 0.95D) as bigint)"), "beyond": F.col("n")}
    data = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "g string, v long, n string, __c long")
    found = {x["g"]: tuple(x)[1:] for x in ranks.values_at(data, ["g"], "v", wanted, ranges).collect()}
    assert found == {k: (v[0], v[len(v) // 2], v[int(len(v) * 0.95)], None) for k, v in grouped(rows).items()}
    everything = sorted(v for _, v in rows if v is not None)
    assert tuple(ranks.values_at(data, [], "v", wanted, ranges).first()) == (everything[0], everything[len(everything) // 2], everything[int(len(everything) * 0.95)], None)


def test_percentiles_equal_the_built_in_ones(spark):
    r = random.Random(1)
    rows = [(r.choice("aab"), 1, r.lognormvariate(0, 4)) for _ in range(2000)] + [(None, 2, 1.5), ("c", None, None), ("d", 1, float("inf")), ("d", 1, float("nan"))]
    data = spark.createDataFrame(rows, "g string, h int, v double")
    fractions = {"low": 0.0, "p33": 0.33, "median": 0.5, "p95": 0.95, "high": 1.0}
    own = ranks.percentiles(data, ["g", "h"], "v", fractions, 5).filter("coalesce(g, '') <> 'd'")
    built_in = data.filter("v is not null and coalesce(g, '') <> 'd'").groupBy("g", "h").agg(*(F.percentile("v", p).alias(k) for k, p in fractions.items()))
    key = lambda rows: sorted(((x["g"], x["h"], *(round(x[k], 9) for k in fractions)) for x in rows.collect()), key=repr)
    assert key(own) == key(built_in) and own.count() == 3
    none = ranks.percentiles(data.limit(0), ["g"], "v", fractions)
    assert none.count() == 0 and none.columns == ["g", *fractions]


def test_reports_and_profiles_use_them(spark):
    runs = spark.createDataFrame([("s", None, float(i % 13), i) for i in range(100)] + [("t", "e", None, 9)], "scenario string, engine string, ms double, run int")
    made = {x["scenario"]: x for x in reports.latency_summary(runs, ["scenario", "engine"]).collect()}
    kept = runs.filter("run >= 3 and scenario = 's'").agg(F.percentile("ms", 0.5).alias("m"), F.percentile("ms", 0.95).alias("p")).first()
    assert (made["s"]["median_ms"], made["s"]["p95_ms"], made["s"]["runs"]) == (kept["m"], kept["p"], 97) and made["t"]["median_ms"] is None
    lengths = spark.createDataFrame([(n,) for n in [3, None, 7, 7, 900]], "content_length int")
    assert profile.length_profile(lengths).first().asDict() == {"mean": 183.4, "p50": 7, "p95": 900, "shortest": 0, "longest": 900, "n": 5}
    assert profile.length_profile(lengths.limit(0)).first()["p50"] is None
    plan = profile.length_profile(lengths)._jdf.queryExecution().executedPlan().toString()
    # The one window without keys is over the histogram, of at most RANGES + 1 rows.
    assert "percentile(" not in plan


def test_ranges_follow_from_the_values_alone(spark):
    data = spark.range(0, 120000, 1, 12).select((F.col("id") % 2).alias("g"), (F.xxhash64("id") % 1000003).cast("double").alias("v"))
    own = ranks.percentiles(data, ["g"], "v", {"median": 0.5, "p95": 0.95})
    built_in = data.groupBy("g").agg(F.percentile("v", 0.5).alias("median"), F.percentile("v", 0.95).alias("p95"))
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, built_in.collect()))
    # The cuts are made twice in a plan, and a sketch's depend on the order in which parts are merged.
    assert "approx" not in own._jdf.queryExecution().executedPlan().toString()
