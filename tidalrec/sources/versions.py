"""Versions of a set of tables that become visible together or not at all.

The tables of a version are written first, into a folder of their own; then one
commit file naming them is renamed into place.  A reader looks only at commit
files, so a version that was left half-written is never read, and two writers
can't take the same number: the second rename fails and tries the next one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    tables: tuple[str, ...]
    meta: dict


class VersionedStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self):
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return fs, fs.Path(self.path).getFileSystem(conf), conf

    def versions(self) -> list[int]:
        fs, files, _ = self._hadoop()
        top = fs.Path(f"{self.path}/commits")
        if not files.exists(top):
            return []
        names = [str(s.getPath().getName()) for s in files.listStatus(top)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def publish(self, tables: dict[str, DataFrame], meta: dict, partition_by: dict[str, str] | None = None) -> int:
        """Writes the tables, then the commit; the number of the new version."""
        folder = f"data/{uuid.uuid4().hex}"
        for name, df in tables.items():
            writer = df.write
            if partition_by and name in partition_by:
                writer = writer.partitionBy(partition_by[name])
            writer.parquet(f"{self.path}/{folder}/{name}")
        return self._commit({"folder": folder, "tables": sorted(tables), "meta": meta})

    def _commit(self, content: dict) -> int:
        fs, files, conf = self._hadoop()
        draft = fs.Path(f"{self.path}/commits/.draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        context = fs.FileContext.getFileContext(files.makeQualified(draft).toUri(), conf)
        plain = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        number = max(self.versions(), default=0) + 1
        while True:
            try:
                context.rename(files.makeQualified(draft), files.makeQualified(fs.Path(f"{self.path}/commits/{number}.json")), plain)
                return number
            except Exception:
                if number not in self.versions():  # not taken by another writer: a real failure
                    raise
                number += 1

    def version(self, number: int | None = None) -> Version | None:
        """A version, the newest one unless told; None if there is none."""
        known = self.versions()
        if number is None:
            if not known:
                return None
            number = known[-1]
        if number not in known:
            raise ValueError(f"version {number} is not among {known}")
        text = self.spark.read.option("wholetext", "true").text(f"{self.path}/commits/{number}.json").first()[0]
        told = json.loads(text)
        return Version(number, told["folder"], tuple(told["tables"]), told["meta"])

    def table(self, version: Version, name: str) -> DataFrame:
        if name not in version.tables:
            raise ValueError(f"version {version.number} has no table {name}")
        return self.spark.read.parquet(f"{self.path}/{version.folder}/{name}")
