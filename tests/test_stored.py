"""Tables that are merged into: states, failures, writers that meet."""

import random

import pytest
from pyspark.sql import functions as F

from heronlake.sources.stored import StateTaken, StoredTable

SCHEMA = "id string, n long, text string"


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable.create(spark, f"file://{tmp_path}/table", spark.createDataFrame([], SCHEMA).schema, "id", buckets=4)


def rows(df):
    return {r["id"]: (r["n"], r["text"]) for r in df.collect()}


def test_loads_equal_a_dictionary(spark, table):
    r, state, kept = random.Random(1), {}, {}
    for load in range(4):
        batch = [(f"k{r.randrange(30)}", load * 100 + k, r.choice(["a", None, "é"])) for k in range(r.choice([0, 3, 40]))]
        for i, n, t in batch:
            state[i] = (n, t)
        table.upsert(spark.createDataFrame(batch, SCHEMA).repartition(3), ["n"])
        kept[load + 1] = dict(state)
        found = table.read().collect()
        assert rows(table.read()) == state and len(found) == len(state)
    # Older states are there as they were.
    assert {s: rows(table.read(s)) for s in kept} == kept and rows(table.read(0)) == {}


def test_inserts_skip_what_is_stored(spark, table):
    table.insert_absent(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("", 5, "empty"), ("b", 3, None)], SCHEMA), ["n"])
    table.insert_absent(spark.createDataFrame([("a", 0, "z"), ("c", 1, "c")], SCHEMA), ["n"])
    expected = {"a": (1, "x"), "": (5, "empty"), "b": (3, None), "c": (1, "c")}
    assert rows(table.read()) == expected
    state = table.compact()
    assert rows(table.read()) == expected and table.compact() == state
    assert rows(table.get(["a", "zz", ""])) == {"a": (1, "x"), "": (5, "empty")}
    table.upsert(spark.createDataFrame([("a", 4, "again")], SCHEMA), ["n"])
    assert table.drop_old_states() > 0 and rows(table.read()) == expected | {"a": (4, "again")} and len(table.states()) == 1


def test_a_load_that_fails_leaves_the_state(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA), ["n"])
    broken = spark.createDataFrame([("a", 2, "y"), ("b", 3, "z")], SCHEMA).withColumn("n", F.when(F.col("id") == "b", F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(broken, ["n"])
    with pytest.raises(ValueError, match="without id"):
        table.upsert(spark.createDataFrame([(None, 2, "y"), ("a", 9, "q")], SCHEMA), ["n"])
    assert table.states() == [0, 1] and rows(table.read()) == {"a": (1, "x")}
    # The same load again, twice: a retry changes nothing.
    for _ in range(2):
        table.upsert(spark.createDataFrame([("a", 2, "y"), ("b", 3, "z")], SCHEMA), ["n"])
    assert rows(table.read()) == {"a": (2, "y"), "b": (3, "z")}


def test_a_writer_that_comes_second_starts_from_the_first_ones_state(spark, table, monkeypatch):
    reader = table.read()
    other, commit, met = StoredTable(spark, table.path), table._commit, []

    def late(state, manifest):
        if not met:
            met.append(state)
            other.upsert(spark.createDataFrame([("a", 1, "other"), ("b", 1, "other")], SCHEMA), ["n"])
        commit(state, manifest)

    monkeypatch.setattr(table, "_commit", late)
    table.upsert(spark.createDataFrame([("a", 2, "own"), ("c", 2, "own")], SCHEMA), ["n"])
    assert table.states() == [0, 1, 2] and rows(table.read()) == {"a": (2, "own"), "b": (1, "other"), "c": (2, "own")}
    assert reader.collect() == []


def test_a_state_is_taken_once(table):
    with pytest.raises(StateTaken):
        table._commit(0, {})
    assert table.manifest()["key"] == "id"


def test_columns_are_those_of_the_table(spark, table):
    table.upsert(spark.createDataFrame([("a", 7, 1)], "id string, __bucket int, more int").withColumn("n", F.lit("5")), ["more"])
    assert rows(table.read()) == {"a": (5, None)} and table.read().columns == ["id", "n", "text"]
    with pytest.raises(ValueError):
        StoredTable.create(table.spark, table.path, table.read().schema, "id")
    with pytest.raises(ValueError):
        StoredTable(table.spark, table.path + "-none").upsert(table.read(), ["n"])


def test_only_touched_buckets_are_written(spark, table):
    table.upsert(spark.createDataFrame([(f"k{k}", k, "") for k in range(40)], SCHEMA), ["n"])
    before = table.manifest()["folders"]
    table.upsert(spark.createDataFrame([("k3", 99, "new")], SCHEMA), ["n"])
    after = table.manifest()["folders"]
    assert len(before) == 4 and sum(before[b] != after[b] for b in before) == 1
