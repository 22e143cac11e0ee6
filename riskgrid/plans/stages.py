"""Hand-over tables of a run, named by their content.

A stage's key is a hash of its name, its parameters and the keys of what it reads; an
input file's key holds its length and its time of change.  A table lies below
``tables/<stage>-<key>`` and counts once its write has committed, so a run that
died is continued by running it again: finished stages are read, the one that
broke is written anew, and a changed parameter rebuilds only what depends on it.
``finish`` writes the manifest and deletes every table that it does not name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


class Stages:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.keys: dict[str, str] = {}
        self.built: list[str] = []

    def _key(self, *parts) -> str:
        return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]

    def source(self, name: str, path: str) -> None:
        """Make ``path``, a file or folder, known as an input."""
        found, todo = [], [self.path(path)]
        while todo:
            for s in self.path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(todo.pop()):
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    found.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
        self.keys[name] = self._key("source", sorted(found))

    def table_path(self, name: str) -> str:
        return f"{self.folder}/tables/{name}-{self.keys[name]}"

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def write(self, name: str, params, reads: Sequence[str], put: Callable[[str], None]) -> str:
        """Run ``put(path)`` unless the stage's output is there; a mark beside the output says that it is whole."""
        self.keys[name] = self._key(name, params, [self.keys[r] for r in reads])
        path = self.table_path(name)
        if not self.exists(f"{path}/_DONE"):
            self.fs.delete(self.path(path), True)
            put(path)
            self._text(f"{path}/_DONE", "")
            self.built.append(name)
        return path

    def table(self, name: str, params, reads: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
        """A DataFrame stage, read back from its files."""
        path = self.write(name, params, reads, lambda p: build().write.option("compression", "zstd").parquet(f"{p}/data"))
        return self.spark.read.parquet(f"{path}/data")

    def _text(self, path: str, text: str) -> None:
        out = self.fs.create(self.path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def manifest(self) -> dict[str, str]:
        path = f"{self.folder}/manifest.json"
        return json.loads("".join(r.value for r in self.spark.read.text(path, wholetext=True).collect())) if self.exists(path) else {}

    def finish(self) -> None:
        """Write the manifest; then drop tables it does not name and what failed writes left."""
        named = {n: self.table_path(n) for n in self.keys if self.exists(self.table_path(n))}
        part, whole = f"{self.folder}/_manifest.json", f"{self.folder}/manifest.json"
        self._text(part, json.dumps(named, indent=1))
        self.fs.delete(self.path(whole), False)
        self.fs.rename(self.path(part), self.path(whole))
        keep = {p.rsplit("/", 1)[1] for p in named.values()}
        for s in self.fs.listStatus(self.path(f"{self.folder}/tables")):
            if s.getPath().getName() not in keep:
                self.fs.delete(s.getPath(), True)
