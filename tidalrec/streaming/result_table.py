"""The result of a stream as a table whose size is bounded by its keys.

Every micro-batch adds ``delta/batch=<n>``; a retry overwrites its own.  After
``every`` deltas they are folded into ``folded/through=<n>``, one row per key.
A reader takes the newest folded table that is complete and the deltas behind it,
so a half-written fold is never read and a delta never counts twice.  What a fold
replaces is deleted once the fold after it is complete, so that a reader of the
table before it can finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ResultTable:
    """``fold(rows)`` must give one row per key, with the same columns, and not mind being applied to folded rows."""

    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], every: int = 8):
        self.spark, self.path, self.fold, self.every = spark, path.rstrip("/"), fold, every

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _complete(self, kind: str, name: str) -> list[int]:
        """Numbers of the complete tables ``<kind>/<name>=<number>``."""
        path, fs = self._files()
        top = path(f"{self.path}/{kind}")
        if not fs.exists(top):
            return []
        found = [str(s.getPath().getName()) for s in fs.listStatus(top)]
        return sorted(int(f.split("=")[1]) for f in found
                      if f.startswith(f"{name}=") and fs.exists(path(f"{self.path}/{kind}/{f}/_SUCCESS")))

    def folded(self) -> int:
        """The last batch that the newest complete fold holds; -1 before the first."""
        return max(self._complete("folded", "through"), default=-1)

    def deltas(self) -> list[int]:
        through = self.folded()
        return [n for n in self._complete("delta", "batch") if n > through]

    def _rows(self) -> DataFrame | None:
        through = self.folded()
        paths = [f"{self.path}/folded/through={through}"] * (through >= 0)
        paths += [f"{self.path}/delta/batch={n}" for n in self._complete("delta", "batch") if n > through]
        parts = [self.spark.read.parquet(p) for p in paths]
        out = parts[0] if parts else None
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def add(self, rows: DataFrame, batch: int) -> None:
        """Writes a micro-batch's rows; a batch that a fold already holds is left alone."""
        if batch <= self.folded():
            return
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch}")
        if len(self.deltas()) >= self.every:
            self.compact()

    def compact(self) -> None:
        """Folds what there is into one table and deletes what the fold before it had replaced."""
        open_deltas = self.deltas()
        if not open_deltas:
            return
        before, through = self.folded(), open_deltas[-1]
        self.fold(self._rows()).write.mode("overwrite").parquet(f"{self.path}/folded/through={through}")
        path, fs = self._files()
        for n in self._complete("delta", "batch"):
            if n <= before:
                fs.delete(path(f"{self.path}/delta/batch={n}"), True)
        for n in self._complete("folded", "through"):
            if n < before:
                fs.delete(path(f"{self.path}/folded/through={n}"), True)

    def read(self) -> DataFrame:
        """One row per key, as of the last complete batch."""
        rows = self._rows()
        if rows is None:
            raise ValueError(f"no batch has been written to {self.path}")
        return self.fold(rows)
