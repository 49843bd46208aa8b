"""Tables that streams keep on plain parquet: append tables and keyed tables.

``BatchTable`` has one folder per batch, overwritten when the batch is tried again. ``KeyedTable`` holds one row per key
in hash buckets: a batch writes a small change file for each bucket it touches, readers merge the files of a bucket,
and a bucket with many of them is compacted. One manifest file names the files that count; it is replaced in one step,
so what a failed batch left behind is never seen and a batch that comes again changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convoy.functions.newest import newest_rows

BATCH = "batch_id"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a folder, or None where nothing has been written yet; a table that cannot be read is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class BatchTable:
    """A parquet table whose rows are grouped by the batch that wrote them."""

    path: str

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """All rows, or those of the batches before ``before``; None while there are none."""
        rows = _stored(spark, self.path)
        if rows is None:
            return None
        return rows if before is None else rows.filter(F.col(BATCH) < before)

    def append(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function that appends."""
        return self.write


class _Files:
    """Small files of a folder through Spark's file system, whichever store it is in."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm, self.root, settings = spark._jvm, root, spark._jsc.hadoopConfiguration()
        self._store = self._path("").getFileSystem(settings)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), settings)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._store.exists(path):
            return None
        stream = self._store.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes a file and puts it in the place of the old one in one step."""
        fresh = self._path(f".{name}.{uuid4().hex}")
        stream = self._store.create(fresh, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        how[0] = rename.OVERWRITE
        self._context.rename(fresh, self._path(name), how)

    def names(self) -> list[str]:
        return [status.getPath().getName() for status in self._store.listStatus(self._path(""))]

    def delete(self, name: str) -> None:
        self._store.delete(self._path(name), True)


class Notes:
    """Numbers under names in one small file each, for instance the last batch that a sink has finished."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._files = _Files(spark, root)

    def last(self, name: str) -> int:
        return int(self._files.read(f"{name}.txt") or -1)

    def put(self, name: str, number: int) -> None:
        self._files.replace(f"{name}.txt", str(number))


@dataclass(frozen=True)
class KeyedTable:
    """One row per key; see the module's text.

    With ``order`` (timestamps or whole numbers) the row of the greatest order stays, otherwise the first that came.
    ``buckets`` is fixed by the first batch. One writer at a time.
    """

    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    buckets: int = 64
    #: Change files of a bucket that are left to the readers before they are merged.
    max_changes: int = 8

    # -- the manifest: schema, number of buckets, change folders per bucket oldest first, folders no longer used

    def _manifest(self, spark: SparkSession) -> dict | None:
        text = _Files(spark, self.path).read("manifest.json")
        return None if text is None else json.loads(text)

    def _folders(self, manifest: dict, buckets: list[int] | None) -> list[str]:
        return [
            f"{self.path}/{change}/_bucket={bucket}" for bucket, changes in manifest["changes"].items()
            if buckets is None or int(bucket) in buckets for change in changes
        ]

    def _rows(self, spark: SparkSession, manifest: dict, buckets: list[int] | None) -> DataFrame:
        schema, folders = StructType.fromJson(manifest["schema"]), self._folders(manifest, buckets)
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        return newest_rows(rows, self.keys, self.order) if self.order else rows.dropDuplicates(list(self.keys))

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, buckets: int) -> tuple[str, list[int]]:
        """(folder of the change, buckets that have rows in it)."""
        change = f"change-{uuid4().hex}"
        marked = rows.withColumn("_bucket", self._bucket(buckets))
        marked.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{change}")
        written = _stored(rows.sparkSession, f"{self.path}/{change}")
        return change, [] if written is None else sorted(r[0] for r in written.select("_bucket").distinct().collect())

    def _commit(self, spark: SparkSession, manifest: dict) -> None:
        """Makes ``manifest`` the one that counts, and removes what the one before it had given up."""
        files, gone = _Files(spark, self.path), manifest.pop("leaving", [])
        manifest["version"] += 1
        files.replace("manifest.json", json.dumps(manifest))
        for change in gone:
            files.delete(change)

    # -- for readers

    def current(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame | None:
        """One row per key, of all buckets or some; None while nothing has been written."""
        manifest = self._manifest(spark)
        return None if manifest is None else self._one_per_key(self._rows(spark, manifest, buckets))

    def of_keys(self, wanted: DataFrame) -> DataFrame | None:
        """The rows of the keys in ``wanted``; only their buckets are read."""
        spark, manifest = wanted.sparkSession, self._manifest(wanted.sparkSession)
        if manifest is None:
            return None
        touched = [r[0] for r in wanted.select(self._bucket(manifest["buckets"]).alias("b")).distinct().collect()]
        return self._one_per_key(self._rows(spark, manifest, touched)).join(wanted.select(*self.keys).distinct(), list(self.keys), "left_semi")

    # -- for the one writer

    def merge(self, rows: DataFrame) -> None:
        """Adds a batch: newer rows replace older ones, or without an order rows of known keys are ignored."""
        spark = rows.sparkSession
        manifest = self._manifest(spark) or {
            "version": 0, "schema": json.loads(rows.schema.json()), "buckets": self.buckets, "changes": {}, "unused": []}
        rows = self._one_per_key(rows.select(*StructType.fromJson(manifest["schema"]).names))
        if not self.order and manifest["changes"]:
            rows = rows.persist()
            try:
                known = self.of_keys(rows)
                change, touched = self._write(rows.join(known.select(*self.keys), list(self.keys), "left_anti"), manifest["buckets"])
            finally:
                rows.unpersist()
        else:
            change, touched = self._write(rows, manifest["buckets"])
        manifest["leaving"], manifest["unused"] = manifest["unused"], []
        for bucket in touched:
            manifest["changes"].setdefault(str(bucket), []).append(change)
        if not touched:
            manifest["unused"].append(change)
        self._compact(spark, manifest)
        self._commit(spark, manifest)

    def _compact(self, spark: SparkSession, manifest: dict) -> None:
        full = [int(b) for b, changes in manifest["changes"].items() if len(changes) > self.max_changes]
        if not full:
            return
        change, _ = self._write(self._one_per_key(self._rows(spark, manifest, full)), manifest["buckets"])
        before = {c for b in full for c in manifest["changes"][str(b)]}
        for bucket in full:
            manifest["changes"][str(bucket)] = [change]
        # A change folder goes when no bucket names it; readers of the version before still may, so one version later.
        used = {c for changes in manifest["changes"].values() for c in changes}
        manifest["unused"] += sorted(before - used)

    def vacuum(self, spark: SparkSession) -> None:
        """Removes change folders that no manifest names: what failed batches left behind. Not while a batch is written."""
        manifest = self._manifest(spark) or {"changes": {}, "unused": []}
        named = {c for changes in manifest["changes"].values() for c in changes} | set(manifest["unused"])
        files = _Files(spark, self.path)
        for name in files.names():
            if name.startswith("change-") and name not in named:
                files.delete(name)

    def upsert(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function; batches may come again, also under another number."""
        return lambda rows, batch_id: self.merge(rows)
