"""Tables of the catalog, dealt to buckets by a key and sorted by it, so that joins and rollups by that key move no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS = 64


def save_bucketed(rows: DataFrame, table: str, by: list[str], sort: list[str] | None = None, buckets: int = BUCKETS, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """rows as a table of the catalog, a file for each bucket, sorted by `by` and then `sort`; gives the table.

    Tables that are bucketed alike join, and group, by `by` where they lie. A bucket is read by one task, so the key must
    be one without hot values, as ids are; for keywords, of which one may be in a third of all rows, use monthly folders.
    path: where its files are, if not in the warehouse.
    """
    # Tasks and buckets are told by the same hash, so each task writes one bucket.
    writer = rows.repartition(buckets, *by).write.mode(mode).bucketBy(buckets, *by).sortBy(*by, *(sort or []))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return rows.sparkSession.table(table)
