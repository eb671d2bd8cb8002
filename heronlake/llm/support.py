"""Shared folder, written tables and file access that the operators have in common."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: U+0020 and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}
_held: tuple = (None, None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local master gets a folder of its own; on a cluster no folder of this machine would do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="heronlake-")
        spark.sparkContext.setCheckpointDir(_own_folder[app])
    return _own_folder[app]


def held_by_worker(key, make):
    """What `make` gives, kept by the worker process from task to task until it makes something else.

    One such thing at a time: a worker that serves several operators doesn't hold the memos of all.
    """
    global _held
    if _held[0] != key:
        _held = (None, None)
        _held = (key, make())
    return _held[1]


def let_go() -> None:
    """Drop what the worker process holds, for work that needs memory of its own."""
    held_by_worker(None, lambda: None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; two runs never meet in one."""
    path = f"{shared_folder(spark)}/heronlake/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this application has written to the shared folder so far; gives how many paths there were.

    Results read from there until they are written elsewhere, so call this once they are.
    """
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table in the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without recomputing df, and df runs once however
    often the result is used.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_in(text: str | Column) -> Column:
    """Number of runs of characters that aren't ASCII white space; a null text has none."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    # White space at an end leaves an empty piece there.
    edges = F.substring(text, 1, 1).rlike(WHITE).cast("int") + F.substring(text, -1, 1).rlike(WHITE).cast("int")
    return F.when(text == "", 0).otherwise(F.size(F.split(text, WHITE)) - edges).cast("long")


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row, but maps, which Spark doesn't hash."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()))


def file_system(uri: str):
    """(file system, path) of a URI, for code that runs on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
