"""Benchmark and storage reports: latency summaries, rankings, speed-ups, sizes."""

from __future__ import annotations

import csv
import json
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heronlake.operators.ranks import join_groups, percentiles


def latency_summary(runs: DataFrame, keys: list[str], ms: str = "ms", run: str = "run", warm_up: int = 3) -> DataFrame:
    """By case: min, median, mean, 95th percentile (interpolated), max, sample deviation and queries a second, without
    the first warm_up runs. Percentiles are exact, and no task buffers or sorts a whole case."""
    kept = runs.filter(F.col(run) >= warm_up)
    made = kept.groupBy(*keys).agg(
        F.count("*").alias("runs"), F.min(ms).alias("min_ms"), F.avg(ms).alias("mean_ms"),
        F.max(ms).alias("max_ms"), F.coalesce(F.stddev_samp(ms), F.lit(0.0)).alias("stdev_ms"), (1000 / F.avg(ms)).alias("qps"),
    )
    ranked = percentiles(kept, keys, ms, {"median_ms": 0.5, "p95_ms": 0.95})
    made = join_groups(made, ranked, keys, "left")
    return made.select(*keys, "runs", "min_ms", "median_ms", "mean_ms", "p95_ms", "max_ms", "stdev_ms", "qps")


def engine_ranking(summary: DataFrame) -> DataFrame:
    """Engines by the median of their cases' medians."""
    return summary.groupBy("engine").agg(F.percentile("median_ms", 0.5).alias("median_of_medians"), F.count("*").alias("cases")).orderBy("median_of_medians", "engine")


def speed_up(summary: DataFrame) -> DataFrame:
    """Each case against the fastest of its scenario."""
    return summary.withColumn("times_fastest", F.col("median_ms") / F.min("median_ms").over(Window.partitionBy("scenario")))


def speed_up_against(summary: DataFrame, baseline: str) -> DataFrame:
    """Each case against the best case of the engines whose name starts with baseline, in the same scenario."""
    best = F.min(F.when(F.col("engine").startswith(baseline), F.col("median_ms"))).over(Window.partitionBy("scenario"))
    return summary.withColumn("speed_up", best / F.col("median_ms"))


def count_mismatches(summary: DataFrame, tolerance: float = 0.05, skip: str = "aggregation") -> DataFrame:
    """Scenarios whose engines' result counts differ by more than the tolerance; aggregations are limited and skipped."""
    by = summary.filter(F.col("category") != skip).groupBy("scenario").agg(F.min("result_count").alias("least"), F.max("result_count").alias("most"))
    return by.withColumn("difference", (F.col("most") - F.col("least")) / F.greatest("least", F.lit(1))).filter(F.col("difference") > tolerance)


def storage_totals(sizes: DataFrame, raw_bytes: float) -> DataFrame:
    """By engine: data, index and disk sizes, and disk against the raw size."""
    totals = sizes.groupBy("engine").agg(F.sum("data_size").alias("data_size"), F.sum("index_size").alias("index_size"), F.sum("disk_size").alias("disk_size"))
    return totals.withColumn("times_raw", F.col("disk_size") / F.lit(float(raw_bytes)))


def table_sizes(spark, paths: dict[str, str]) -> DataFrame:
    """(table, files, disk_size) of tables in any file system that Spark reads, from file listings."""
    rows = None
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
        one = files.agg(F.lit(name).alias("table"), F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("disk_size"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def column_sizes(spark, paths: dict[str, str]) -> DataFrame:
    """(table, column, files, n_rows, packed_size, plain_size) of Parquet tables, from the footers of their files.

    Tasks read footers only; a table may have any number of files.
    """

    def read(batches):
        for batch in batches:
            rows = []
            for table, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, name = FileSystem.from_uri(unquote(path))
                with fs.open_input_file(name) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    sizes: dict[str, list[int]] = {}
                    for c in range(group.num_columns):
                        leaf = group.column(c)
                        own = sizes.setdefault(leaf.path_in_schema.split(".")[0], [0, 0])
                        own[0] += leaf.total_compressed_size
                        own[1] += leaf.total_uncompressed_size
                    rows += [(table, column, path, group.num_rows, *own) for column, own in sizes.items()]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["table", "column", "file", "n_rows", "packed", "plain"])

    files = None
    for name, path in paths.items():
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(F.lit(name).alias("table"), "path")
        files = found if files is None else files.unionByName(found)
    parts = files.mapInArrow(read, "table string, column string, file string, n_rows bigint, packed bigint, plain bigint")
    return parts.groupBy("table", "column").agg(F.count_distinct("file").alias("files"), F.sum("n_rows").alias("n_rows"), F.sum("packed").alias("packed_size"), F.sum("plain").alias("plain_size"))


def human_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if abs(n) < 1024 or unit == "TB":
            return f"{n:.2f} {unit}" if unit != "B" else f"{int(n)} B"
        n /= 1024


def write_report(rows: DataFrame, path: str, most: int = 10_000) -> None:
    """A small result as .json, .csv or .md; one of over `most` rows is refused."""
    names, data = rows.columns, [r.asDict(recursive=True) for r in rows.limit(most + 1).collect()]
    if len(data) > most:
        raise ValueError(f"a report holds at most {most} rows")
    if path.endswith(".json"):
        Path(path).write_text(json.dumps(data, ensure_ascii=False, indent=2, default=str))
    elif path.endswith(".csv"):
        with open(path, "w", newline="") as f:
            out = csv.DictWriter(f, names)
            out.writeheader()
            out.writerows(data)
    else:
        lines = ["| " + " | ".join(names) + " |", "|" + " --- |" * len(names)]
        Path(path).write_text("\n".join(lines + ["| " + " | ".join(str(r[n]) for n in names) + " |" for r in data]) + "\n")
