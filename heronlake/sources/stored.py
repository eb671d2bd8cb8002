"""Tables that are merged into: rows by key in buckets, and a manifest for each state that they have been in.

A row's bucket follows from the hash of its key. A merge reads and rewrites only the buckets that its keys fall in
(copy on write), or, where rows are only added, writes further files beside them. Files are never changed. What a
state consists of is listed in a manifest with a number; the highest number is the present state.

A writer first writes its files, and then its manifest under the next number, by a rename that fails where the number is
taken. So a load that fails leaves no trace but files that no manifest names, a load that is retried starts from what is there,
and of two writers that meet one begins again on the state that the other left. Readers open one manifest, and later loads
don't touch the files that it names until `drop_old_states` is called.

The rename must refuse to replace a file, as on HDFS; an object store without such a rename takes one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
#: Beginnings that a merge makes, if other writers keep coming in between.
ATTEMPTS = 5


class StateTaken(RuntimeError):
    """Another writer has made the next state."""


class StoredTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # States

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> StoredTable:
        """An empty table; fails where there is one."""
        table = cls(spark, path)
        if table.states():
            raise ValueError(f"there is a table at {path}")
        table._commit(0, {"schema": schema.jsonValue(), "key": key, "buckets": buckets, "folders": {}})
        return table

    def states(self) -> list[int]:
        """The numbers of the states whose manifests are there, in order."""
        where = self._hadoop().Path(f"{self.path}/states")
        files = where.getFileSystem(self._conf())
        if not files.exists(where):
            return []
        names = [f.getPath().getName() for f in files.listStatus(where)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, state: int | None = None) -> dict:
        state = self.states()[-1] if state is None else state
        where = self._hadoop().Path(f"{self.path}/states/{state}.json")
        stream = where.getFileSystem(self._conf()).open(where)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text) | {"state": state}

    def _commit(self, state: int, manifest: dict) -> None:
        """The manifest under its number, whole or not at all; StateTaken if there is one."""
        context = self._hadoop().FileContext.getFileContext(self._hadoop().Path(self.path).toUri(), self._conf())
        made, at = self._hadoop().Path(f"{self.path}/states/.{uuid.uuid4().hex}"), self._hadoop().Path(f"{self.path}/states/{state}.json")
        stream = made.getFileSystem(self._conf()).create(made, False)
        stream.write(bytearray(json.dumps({k: v for k, v in manifest.items() if k != "state"}).encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm().org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(made, at, options)
        except Exception as e:  # py4j wraps what Hadoop raises
            made.getFileSystem(self._conf()).delete(made, False)
            if "FileAlreadyExists" in str(e):
                raise StateTaken(f"state {state} is taken") from e
            raise

    def _jvm(self):
        return self.spark.sparkContext._jvm

    def _hadoop(self):
        return self._jvm().org.apache.hadoop.fs

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    # Reading

    def read(self, state: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a state, the present one if none is named; those of some buckets only, if these are."""
        return self._rows(self.manifest(state), buckets)

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        wanted = manifest["folders"] if buckets is None else {str(b): manifest["folders"].get(str(b), []) for b in buckets}
        paths = [f"{self.path}/{folder}" for folders in wanted.values() for folder in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def get(self, keys: list) -> DataFrame:
        """The rows of some keys, from their buckets."""
        manifest = self.manifest()
        key = manifest["key"]
        kind = T.StructType.fromJson(manifest["schema"])[key].dataType
        asked = self.spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(key, kind)]))
        buckets = [r[0] for r in asked.select(self._bucket(manifest)).distinct().collect()]
        return self._rows(manifest, buckets).filter(F.col(key).isin(list(keys)))

    # Merging

    def upsert(self, rows: DataFrame, order: list[str]) -> int:
        """Rows replace those with their key; of several new rows of a key the last by `order` counts. Gives the state.

        Rows without a key are refused. Columns that the table lacks are dropped, those that rows lack are null.
        """
        return self._merge(rows, F.max_by(F.struct(*rows.columns), F.struct(*order)), self._replaced)

    def insert_absent(self, rows: DataFrame, order: list[str]) -> int:
        """Rows whose key the table lacks are added, of several the first by `order`; the others are skipped."""
        return self._merge(rows, F.min_by(F.struct(*rows.columns), F.struct(*order)), self._added)

    def _bucket(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(F.col(manifest["key"])), F.lit(manifest["buckets"])).cast("int").alias("__bucket")

    def _replaced(self, key: str, stored: DataFrame, new: DataFrame) -> DataFrame:
        return stored.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)

    def _added(self, key: str, stored: DataFrame, new: DataFrame) -> DataFrame:
        return new.join(stored.select(key), key, "left_anti").select(*new.columns)

    def _merge(self, rows: DataFrame, chosen: Column, how: Callable) -> int:
        if not self.states():
            raise ValueError(f"there is no table at {self.path}")
        manifest = self.manifest()
        key, schema = manifest["key"], T.StructType.fromJson(manifest["schema"])
        one = rows.groupBy(F.col(key).alias("__key")).agg(chosen.alias("__row")).select("__row.*")
        one = one.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        # The batch runs once, however often it is read here and whatever other writers do.
        batch = f"{self.path}/incoming/{uuid.uuid4().hex}"
        one.write.parquet(batch)
        try:
            new = self.spark.read.schema(schema).parquet(batch)
            if not new.filter(F.col(key).isNull()).isEmpty():
                raise ValueError(f"rows without {key}")
            # No more numbers than the table has buckets.
            touched = sorted(r[0] for r in new.select(self._bucket(manifest)).distinct().collect())
            for _ in range(ATTEMPTS):
                manifest = self.manifest()
                try:
                    return self._write(manifest, how(key, self._rows(manifest, touched), new), touched, how == self._replaced)
                except StateTaken:
                    continue
            raise StateTaken(f"other writers came first {ATTEMPTS} times")
        finally:
            self._delete(batch)

    def _write(self, manifest: dict, rows: DataFrame, touched: list[int], whole: bool) -> int:
        """Rows as the contents of the touched buckets, or in addition to these; the number of the new state."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("__bucket", self._bucket(manifest))
        dealt.hint("rebalance", "__bucket").sortWithinPartitions("__bucket", manifest["key"]).write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
        written, folders = self._listed(folder), dict(manifest["folders"])
        for b in touched:
            folders[str(b)] = ([] if whole else folders.get(str(b), [])) + ([f"{folder}/__bucket={b}"] if b in written else [])
        state = manifest["state"] + 1
        try:
            self._commit(state, manifest | {"folders": {b: f for b, f in folders.items() if f}})
        except StateTaken:
            self._delete(f"{self.path}/{folder}")
            raise
        return state

    def _delete(self, path: str) -> None:
        where = self._hadoop().Path(path)
        where.getFileSystem(self._conf()).delete(where, True)

    def _listed(self, folder: str) -> set[int]:
        """The buckets that have files in a folder."""
        where = self._hadoop().Path(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in where.getFileSystem(self._conf()).listStatus(where)]
        return {int(n.partition("=")[2]) for n in names if n.startswith("__bucket=")}

    # Upkeep

    def compact(self) -> int:
        """Buckets of several folders rewritten as one, as a state of its own."""
        manifest = self.manifest()
        many = [int(b) for b, folders in manifest["folders"].items() if len(folders) > 1]
        if not many:
            return manifest["state"]
        return self._write(manifest, self._rows(manifest, many), many, True)

    def drop_old_states(self, keep: int = 1) -> int:
        """Delete all but the last `keep` manifests, and the buckets' folders that none of these names; gives how many.

        Readers of older states fail from then on, and so does a load that is under way: call it when there is none.
        """
        states = self.states()
        named = {folder for s in states[-keep:] for folders in self.manifest(s)["folders"].values() for folder in folders}
        files = self._hadoop().Path(self.path).getFileSystem(self._conf())
        for s in states[:-keep]:
            files.delete(self._hadoop().Path(f"{self.path}/states/{s}.json"), False)
        data, gone = self._hadoop().Path(f"{self.path}/data"), 0
        for load in files.listStatus(data) if files.exists(data) else []:
            parts = [f.getPath() for f in files.listStatus(load.getPath()) if f.getPath().getName().startswith("__bucket=")]
            old = [f for f in parts if f"data/{load.getPath().getName()}/{f.getName()}" not in named]
            for f in old:
                files.delete(f, True)
            gone += len(old)
            if len(old) == len(parts):
                files.delete(load.getPath(), True)
        return gone
