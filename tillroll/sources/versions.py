"""Versioned tables with one atomic pointer.

A store is a folder.  Data goes to fresh folders under ``data``; what a version is made of
stands in one small manifest, ``manifests/<number>.json``, which names the folder, format and
schema of every table.  A commit writes all its data first and then moves its manifest
into place in one step that fails if the number is taken.  So readers see all tables of a
commit or none, a writer that dies leaves the version before, of two writers that
started from one version the later gets an error, and an old version can be read or made
the newest again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Versions:
    """Tables of one store folder, on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------- reading
    def versions(self) -> list[int]:
        """Committed numbers, oldest first."""
        folder = self._path("manifests")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of ``version``; an empty store has version 0 without tables."""
        known = self.versions()
        if version is None:
            if not known:
                return {"version": 0, "tables": {}}
            version = known[-1]
        if version not in known:
            raise KeyError(f"no version {version} in {self.root}")
        return json.loads(self.spark.read.text(f"{self.root}/manifests/{version}.json", wholetext=True).first()[0])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        told = self.manifest(version)["tables"][name]
        reader = self.spark.read.format(told["format"]).schema(StructType.fromJson(told["schema"]))
        return (reader.option("header", True) if told["format"] == "csv" else reader).load(f"{self.root}/{told['path']}")

    # ------------------------------------------------------------- writing
    def commit(self, tables: dict[str, DataFrame], fmt: str = "parquet", base: int | None = None) -> int:
        """S9 write ``tables`` and make them, with all others as they are, the next version.
        ``base`` is the version the caller has read (the newest): if another commit came
        since, this one is an error and changes nothing."""
        before = self.manifest(base)
        parts = dict(before["tables"])
        for name, df in tables.items():
            path = f"data/{name}/{uuid.uuid4().hex}"
            writer = df.write.format(fmt)
            (writer.option("header", True) if fmt == "csv" else writer).save(f"{self.root}/{path}")
            parts[name] = {"path": path, "format": fmt, "schema": json.loads(df.schema.json())}
        return self._publish(before["version"] + 1, parts)

    def update(self, name: str, fn: Callable[[DataFrame], DataFrame]) -> int:
        """S7 a table becomes what ``fn`` makes of it, in its own format; its readers go on undisturbed."""
        now = self.manifest()
        return self.commit({name: fn(self.read(name, now["version"]))}, now["tables"][name]["format"], now["version"])

    def rollback(self, version: int) -> int:
        """Make an old version the newest one; its data is not copied."""
        return self._publish(self.manifest()["version"] + 1, self.manifest(version)["tables"])

    def vacuum(self, keep: int = 2) -> int:
        """Delete manifests older than the last ``keep`` and data that no kept one names, while no
        commit is under way.  Returns the number of data folders that went."""
        known = self.versions()
        named = {t["path"] for v in known[-keep:] for t in self.manifest(v)["tables"].values()}
        fs = self._path("").getFileSystem(self._conf)
        for v in known[:-keep]:
            fs.delete(self._path(f"manifests/{v}.json"), False)
        gone = 0
        for table in fs.listStatus(self._path("data")) if fs.exists(self._path("data")) else []:
            for part in fs.listStatus(table.getPath()):
                if f"data/{table.getPath().getName()}/{part.getPath().getName()}" not in named:
                    fs.delete(part.getPath(), True)
                    gone += 1
        return gone

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _publish(self, version: int, tables: dict) -> int:
        """Put the manifest in place: written aside, then renamed without overwriting."""
        target, aside = self._path(f"manifests/{version}.json"), self._path(f"manifests/.{uuid.uuid4().hex}")
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(self._conf).getUri(), self._conf)
        fs = target.getFileSystem(self._conf)
        fs.mkdirs(target.getParent())
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps({"version": version, "tables": tables}).encode()))
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            files.rename(aside, target, options)
        except Exception as error:
            fs.delete(aside, False)
            if fs.exists(target):
                raise RuntimeError(f"version {version} of {self.root} was committed meanwhile") from error
            raise
        return version
