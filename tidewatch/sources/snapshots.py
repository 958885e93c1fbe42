"""Sets of tables that are replaced as a whole.

Each version of a set is a folder of its own. A pointer file names the versions, the present one first, and is
replaced by one rename after all tables of a new version are written. So readers see the old set or the
new one, never parts of both; a writer that dies leaves the old one; and a reader that has opened a version
keeps it as long as it is kept.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidewatch.staging import drop_folder, together

POINTER = "CURRENT"
_PREFIX = "version-"
#: Versions that no pointer names were left by a writer that died, once they are this old.
LEFT_AFTER_HOURS = 24


class Snapshots:
    """Versions of a set of tables under ``folder``; the newest ``keep`` of them stay."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        if keep < 1:
            raise ValueError("the present version must be kept")
        self.spark, self.folder, self.keep = spark, folder.rstrip("/"), keep
        self._jvm = spark._jvm
        self._pointer = self._path(f"{self.folder}/{POINTER}")
        self._fs = self._pointer.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def versions(self) -> list[str]:
        """Names of the versions that are kept, the present one first."""
        if not self._fs.exists(self._pointer):
            return []
        stream = self._fs.open(self._pointer)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
        finally:
            stream.close()

    def current(self) -> str:
        """The folder of the present version; it does not change under a reader."""
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"nothing has been published in {self.folder}")
        return f"{self.folder}/{versions[0]}"

    def read(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Tables of the present version, all of the same one."""
        folder = self.current()
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in names}

    def write(self, tables: Mapping[str, DataFrame], written: Callable[[str], object] | None = None) -> str:
        """Write a new version and then make it the present one; its folder. ``written`` is called with the
        name of each table whose rows are on disk, before the version is the present one."""
        version = f"{_PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

        def put(name: str, table: DataFrame) -> None:
            table.write.mode("errorifexists").parquet(f"{self.folder}/{version}/{name}")
            if written:
                written(name)

        together(*[partial(put, name, table) for name, table in tables.items()])
        before = self.versions()
        self._point([version, *before][: self.keep])
        self._prune(before)
        return f"{self.folder}/{version}"

    def _point(self, versions: list[str]) -> None:
        new = self._path(f"{self.folder}/.{POINTER}-{uuid.uuid4().hex}")
        stream = self._fs.create(new, False)
        try:
            stream.write(bytearray("\n".join(versions), "utf-8"))
        finally:
            stream.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(new, self._pointer, options)

    def _prune(self, before: list[str]) -> None:
        """Drop versions that the pointer no longer names, and old ones that it never named."""
        kept = set(self.versions())
        stale = time.time() - 3600 * LEFT_AFTER_HOURS
        for entry in self._fs.listStatus(self._path(self.folder)):
            name = entry.getPath().getName()
            if not name.startswith(_PREFIX) or name in kept:
                continue
            if name in before or entry.getModificationTime() / 1000 < stale:
                drop_folder(self.spark, f"{self.folder}/{name}")
