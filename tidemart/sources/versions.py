"""Keyed tables with versions, and which version a micro-batch has read.

A version is one set of changes, written once as a folder of its own; a version without `_SUCCESS` was
never finished and isn't seen. Every few versions the rows in force are folded into a snapshot, so reading
any version costs one snapshot and a few changes. `Pins` notes, before a batch does its work, which
version the batch reads: a batch repeated after a failure reads the same one, whatever came since.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

VERSION = "version"


class Folder:
    """Names below a path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._jvm_path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jvm_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        at = self._jvm_path(f"{self.path}/{below}" if below else self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def has(self, name: str) -> bool:
        return self._fs.exists(self._jvm_path(f"{self.path}/{name}"))

    def is_folder(self, name: str) -> bool:
        return self._fs.getFileStatus(self._jvm_path(f"{self.path}/{name}")).isDirectory()

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._jvm_path(f"{self.path}/{name}"))

    def drop(self, name: str) -> None:
        self._fs.delete(self._jvm_path(f"{self.path}/{name}"), True)

    def read(self, name: str) -> str:
        """Text of a small file."""
        stream = self._fs.open(self._jvm_path(f"{self.path}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a small file unless there is one of that name; says whether it did."""
        target = self._jvm_path(f"{self.path}/{name}")
        if self._fs.exists(target):
            return False
        try:
            stream = self._fs.create(target, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._jvm_path(f"{self.path}/{old}"), self._jvm_path(f"{self.path}/{new}"))


class VersionedTable:
    """Rows by key whose state at every version can be read. `op` is 'd' where a change removes its key; the rows of
    one version that share a key are ordered by `order`, then by what they hold."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: str | None = None,
                 fold_every: int = 16):
        self.spark, self.path, self.keys, self.order, self.fold_every = spark, path.rstrip("/"), list(keys), order, fold_every
        self.schema = T.StructType([f for f in schema.fields if f.name != "op"])
        self.stored = T.StructType([*self.schema.fields, T.StructField("op", T.StringType()), T.StructField(VERSION, T.LongType())])
        self.folder = Folder(spark, path)

    def _finished(self, kind: str) -> list[int]:
        return sorted(int(n) for n in self.folder.names(kind) if self.folder.has(f"{kind}/{n}/_SUCCESS"))

    def newest(self) -> int:
        """The last finished version, -1 for none."""
        return max(self._finished("changes"), default=-1)

    def apply(self, changes: DataFrame, version: int) -> None:
        """One version's changes; the same version written again replaces itself. Versions rise, gaps are fine."""
        first = [F.col(c) for c in ([self.order] if self.order else [])]
        rest = [F.col(c) for c in self.schema.names if c not in (*self.keys, self.order)]
        last = changes.groupBy(*self.keys).agg(F.max(F.struct(*first, *rest, F.coalesce("op", F.lit("u")).alias("op"))).alias("_c"))
        rows = last.select(*self.keys, *[F.col(f"_c.{c}").alias(c) for c in (*[c for c in self.schema.names if c not in self.keys], "op")],
                           F.lit(version).cast("long").alias(VERSION))
        rows.select(*self.stored.names).write.mode("overwrite").parquet(f"{self.path}/changes/{version}")
        snapshots = self._finished("snapshots")
        open_ = [v for v in self._finished("changes") if v > max(snapshots, default=-1)]
        if len(open_) >= self.fold_every:
            self._rows(version).write.mode("overwrite").parquet(f"{self.path}/snapshots/{version}")

    def _rows(self, version: int) -> DataFrame:
        """The last change of each key up to `version`; removals of keys that a snapshot has left behind are gone."""
        base = max((v for v in self._finished("snapshots") if v <= version), default=None)
        paths = [f"{self.path}/changes/{v}" for v in self._finished("changes") if v <= version and (base is None or v > base)]
        if base is not None:
            paths.append(f"{self.path}/snapshots/{base}")
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(*paths)
        others = [c for c in self.stored.names if c not in (*self.keys, VERSION)]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(VERSION, *others), VERSION).alias("_c"))
        return last.select(*self.keys, "_c.*").filter(F.col("op") != "d").select(*self.stored.names)

    def at(self, version: int) -> DataFrame:
        """Rows in force after `version`, with the version that set each."""
        return self._rows(version).drop("op")


class Pins:
    """Versions that the batches of one stream have read, noted as empty folders `<batch>/<version>-<fresh>-<millis>`.

    With `expire_ms` a version serves the batches that start within that time of its reading; `fresh` is the
    version in force when the batch started, for keys that the older one doesn't have.
    """

    def __init__(self, spark: SparkSession, path: str, expire_ms: int | None = None, clock: Callable[[], int] | None = None):
        self.folder, self.expire_ms = Folder(spark, path), expire_ms
        self.clock = clock or (lambda: int(time.time() * 1000))

    def _of(self, batch_id: int) -> tuple[int, int, int] | None:
        names = self.folder.names(str(batch_id))
        if not names:
            return None
        version, fresh, millis = names[0].lstrip("v").split("_")
        return int(version), int(fresh), int(millis)

    def pin(self, batch_id: int, newest: Callable[[], int]) -> tuple[int, int]:
        """(version, fresh) of a batch, the same however often it is asked."""
        known = self._of(batch_id)
        if known is None:
            now, fresh = self.clock(), newest()
            before = self._of(batch_id - 1) if self.expire_ms is not None else None
            if before is not None and now - before[2] < self.expire_ms:
                known = before[0], fresh, before[2]
            else:
                known = fresh, fresh, now
            self.folder.make(f"{batch_id}/v{known[0]}_{known[1]}_{known[2]}")
        return known[:2]
