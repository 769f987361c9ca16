"""Partitioned tables whose partitions are switched together.

A load writes its partitions into a folder of its own; then one small file, the manifest, names the folder
of every partition. A reader takes the newest complete manifest and sees a load whole or not at all; the
folders it reads stay until `vacuum`. A load that failed before its manifest was complete is never seen
and can simply run again. Of two loads that start from the same manifest the second one fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from .versions import Folder

MANIFESTS, LAST_LINE = "_manifests", "complete"


class LoadConflict(RuntimeError):
    """Another load was finished since this one began."""


class SwitchedTable:
    """`schema` has the partition column too; its values are dates or other plain text."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, column: str = "dt"):
        self.spark, self.path, self.schema, self.column = spark, path.rstrip("/"), schema, column
        self.folder = Folder(spark, self.path)

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in self.folder.names(MANIFESTS) if n.isdigit())

    def _manifest(self, number: int) -> dict[str, str] | None:
        lines = self.folder.read(f"{MANIFESTS}/{number}").split("\n")
        return dict(line.split("\t") for line in lines[:-1]) if lines[-1] == LAST_LINE else None

    def _newest(self) -> dict[str, str]:
        for number in reversed(self._numbers()):
            found = self._manifest(number)
            if found is not None:
                return found
        return {}

    def _commit(self, number: int, folders: dict[str, str]) -> None:
        text = "\n".join([*(f"{value}\t{load}" for value, load in sorted(folders.items())), LAST_LINE])
        if not self.folder.write_new(f"{MANIFESTS}/{number}", text):
            raise LoadConflict(f"{self.path} has a newer load than the one this load began with")

    def partitions(self) -> dict[str, str]:
        """Folder of every partition that a reader sees now."""
        return self._newest()

    def read(self, values: Iterable[str] | None = None) -> DataFrame:
        """The table, or the named partitions only; others are neither listed nor read."""
        folders = self._newest()
        chosen = folders if values is None else [v for v in dict.fromkeys(values) if v in folders]
        paths = [f"{self.path}/{folders[v]}/{self.column}={v}" for v in chosen]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*[f"`{name}`" for name in self.schema.names])

    def replace(self, rows: DataFrame, values: Iterable[str] | None = None) -> None:
        """Switch to `rows` in the partitions they have. With `values` exactly those partitions are replaced: one
        without rows disappears, and rows for any other are an error. Repeating a load gives the same table."""
        number, before = max(self._numbers(), default=0) + 1, self._newest()
        load = f"load=l{uuid.uuid4().hex}"
        (rows.select(*[f"`{name}`" for name in self.schema.names]).hint("rebalance", self.column)
         .write.partitionBy(self.column).parquet(f"{self.path}/{load}"))
        prefix = f"{self.column}="
        written = [n[len(prefix):] for n in self.folder.names(load) if n.startswith(prefix)]
        replaced = set(written if values is None else values)
        if not replaced.issuperset(written):
            self.folder.drop(load)
            raise ValueError(f"rows for partitions that the load doesn't replace: {sorted(set(written) - replaced)[:5]}")
        kept = {value: folder for value, folder in before.items() if value not in replaced}
        self._commit(number, {**kept, **{value: load for value in written}})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop the folders that none of the last `keep` manifests names, and the manifests before. Call it when no
        load is running and no reader is older than those manifests; returns what was dropped."""
        complete = [n for n in self._numbers() if self._manifest(n) is not None]
        recent = complete[-keep:]
        named = {load for n in recent for load in self._manifest(n).values()}
        old = [f"{MANIFESTS}/{n}" for n in self._numbers() if n not in recent and n < max(recent, default=0)]
        old += [name for name in self.folder.names() if name.startswith("load=") and name not in named]
        for name in old:
            self.folder.drop(name)
        return [name for name in old if name.startswith("load=")]
