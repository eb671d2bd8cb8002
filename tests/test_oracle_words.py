"""All words of a title in the check SQL."""

from heronlake.plans import oracle


def test_the_sql_of_ordered_dedup_reads_all_words():
    import duckdb

    sql = oracle.SQL["fn17_ordered_dedup"]
    inner = "SELECT 1 AS id, array_to_string(list_transform(range(0, 6000), lambda i: 'w' || i), ' ') AS title"
    assert sql.count(f"({oracle.ART})") == 1
    (row,) = duckdb.sql(sql.replace(f"({oracle.ART})", f"({inner})")).fetchall()
    assert row[1].split("|") == [f"w{i}" for i in range(6000)]
