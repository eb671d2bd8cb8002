"""Bucketed tables: nothing is moved by a join or a rollup by their key."""

import pytest

from heronlake.plans.queries import QUERIES
from heronlake.sources.catalog import save_bucketed
from tests.compare import SMALL


def test_the_registered_join_moves_nothing(spark):
    plan = QUERIES["snk6_bucketed_join"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_a_bucket_is_a_file(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS n")
    table = save_bucketed(rows, "heronlake_test_buckets", ["id"], ["n"], buckets=4, path=f"{tmp_path}/t")
    assert len(list(tmp_path.glob("t/*.parquet"))) == 4 and sorted(map(tuple, table.collect())) == [(i, i % 7) for i in range(1000)]
    with pytest.raises(Exception, match="exists"):
        save_bucketed(rows, "heronlake_test_buckets", ["id"], buckets=4)
    spark.sql("DROP TABLE heronlake_test_buckets")
