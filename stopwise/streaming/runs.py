"""Versioned folders that make a foreachBatch step repeatable.

Batch ``n`` reads the state written by the batch before it and writes its output
and state under its own number, in overwrite mode. Running it again after a
failure replaces what the first attempt left.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from stopwise.sources.tables import exists


class StateFolder:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _at(self, batch_id: int, name: str) -> str:
        return f"{self.path}/batch={batch_id}/{name}"

    def write(self, batch_id: int, tables: dict[str, DataFrame], meta: dict) -> None:
        """Store the tables; the meta text goes last and marks the state as complete."""
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(self._at(batch_id, name))
        line = self.spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1)
        line.write.mode("overwrite").text(self._at(batch_id, "meta"))

    def _numbers(self) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))

    def before(self, batch_id: int) -> int | None:
        """Number of the latest complete state before ``batch_id``."""
        done = (
            n
            for n in reversed(self._numbers())
            if n < batch_id and exists(self.spark, f"{self._at(n, 'meta')}/_SUCCESS")
        )
        return next(done, None)

    def latest(self) -> int | None:
        return self.before(1 << 62)

    def table(self, batch_id: int, name: str) -> DataFrame:
        return self.spark.read.parquet(self._at(batch_id, name))

    def meta(self, batch_id: int) -> dict:
        return json.loads(self.spark.read.text(self._at(batch_id, "meta")).first()[0])

    def forget(self, batch_id: int, keep: int = 2) -> None:
        """Drop all states but the ``keep`` before ``batch_id`` and later ones."""
        jvm = self.spark._jvm
        for n in [n for n in self._numbers() if n < batch_id][:-keep]:
            old = jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={n}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
