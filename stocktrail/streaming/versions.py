"""A table kept as a base and the parts added since, in versions that are published whole."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MARK = re.compile(r"version=(\d+),base=(-?\d+)$")


class Versions:
    """Below ``path``: ``part=n`` and ``base=n``, Parquet folders that never change, and empty files
    ``marks/version=n,base=b``, each of which publishes a version: base b (none if -1) and the parts
    after it up to n. A mark is made in one step and only when all it names is written, so a reader
    sees a whole version or the one before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._of = jvm.org.apache.hadoop.fs.Path
        self._files = self._of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._of(folder)
        if not self._files.exists(where):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(where)]

    def marks(self) -> list[tuple[int, int]]:
        """(version, base) of all published versions, the latest last."""
        found = (_MARK.match(name) for name in self._names(f"{self.path}/marks"))
        return sorted((int(m[1]), int(m[2])) for m in found if m)

    def _folders(self, version: int, base: int) -> list[str]:
        parts = {f"part={n}" for n in range(base + 1, version + 1)}
        there = [name for name in self._names(self.path) if name in parts]
        return [f"{self.path}/{name}" for name in ([f"base={base}"] if base >= 0 else []) + sorted(there)]

    def read(self, mark: tuple[int, int] | None = None) -> DataFrame:
        """All rows of a version, by default of the latest; they are yet to be merged."""
        marks = self.marks()
        if not marks:
            raise FileNotFoundError(f"nothing published in {self.path}")
        return self.spark.read.parquet(*self._folders(*(mark or marks[-1])))

    def add(
        self, number: int, rows: DataFrame, merge: Callable[[DataFrame], DataFrame], merge_every: int
    ) -> None:
        """Publish version ``number``: the one before and ``rows``. Numbers go up by one; a number
        that is published already is left as it is."""
        marks = self.marks()
        before, base = marks[-1] if marks else (-1, -1)
        if number <= before:
            return
        rows.write.mode("overwrite").parquet(f"{self.path}/part={number}")
        if number - base >= merge_every:
            whole = self.spark.read.parquet(*self._folders(number, base))
            merge(whole).write.mode("overwrite").parquet(f"{self.path}/base={number}")
            base = number
        self._files.create(self._of(f"{self.path}/marks/version={number},base={base}"), False).close()
        self._forget()

    def _forget(self) -> None:
        """Remove what neither the latest version nor the one before it needs: readers of that one
        may not have ended."""
        marks = self.marks()
        kept = marks[-2:]
        for version, base in marks[:-2]:
            self._files.delete(self._of(f"{self.path}/marks/version={version},base={base}"), False)
        needed = {folder.rsplit("/", 1)[1] for mark in kept for folder in self._folders(*mark)}
        for name in self._names(self.path):
            if re.match(r"(part|base)=", name) and name not in needed:
                self._files.delete(self._of(f"{self.path}/{name}"), True)
