"""A message buffer as a table of batch folders, with a manifest that says which of them were cleared."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Buffer:
    """Appended batches, of which exactly those of a snapshot can be cleared while others arrive.

    Every append writes one folder, which counts once Spark has marked it as complete. The manifest is a numbered series of small files, each
    with the names of all cleared batches whose folders are still there; a new one is created under the next number,
    which fails if somebody else has just done so, and then is tried again. So clearing is one atomic step, a reader sees all of it or nothing, and
    batches that arrive meanwhile are in no snapshot and stay. Folders of cleared batches are removed one clearing later, when
    readers that still use them have had their time; what a manifest names is bounded by that.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.schema, self.root = spark, schema, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def append(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/batches/{name}")
        return name

    def _cleared(self) -> tuple[int, list[str]]:
        """Number and content of the newest manifest."""
        found = [n for n in self._names("manifest") if n.isdigit()]
        if not found:
            return 0, []
        text = self.spark.read.text(f"{self.root}/manifest/{max(found, key=int)}", wholetext=True).first()
        return int(max(found, key=int)), json.loads(text.value)

    def snapshot(self) -> list[str]:
        """The complete batches that are not cleared: a mark for :meth:`read` and :meth:`clear`."""
        gone = set(self._cleared()[1])
        done = lambda n: self._fs.exists(self._path(f"{self.root}/batches/{n}/_SUCCESS"))
        return [n for n in self._names("batches") if n not in gone and done(n)]

    def read(self, mark: list[str] | None = None) -> DataFrame:
        mark = self.snapshot() if mark is None else mark
        if not mark:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/batches/{n}" for n in mark])

    def clear(self, mark: list[str]) -> None:
        """Take the batches of ``mark`` out of the buffer, and only those."""
        while True:
            number, before = self._cleared()
            there = set(self._names("batches"))
            text = json.dumps(sorted(there.intersection([*before, *mark])))
            target = self._path(f"{self.root}/manifest/{number + 1}")
            part = self._path(f"{self.root}/manifest/.{uuid.uuid4().hex}")
            out = self._fs.create(part)
            out.write(bytearray(text.encode()))
            out.close()
            if not self._fs.exists(target) and self._fs.rename(part, target):
                break
            self._fs.delete(part, False)
        for name in before:
            self._fs.delete(self._path(f"{self.root}/batches/{name}"), True)

    def count(self) -> int:
        return self.read().agg(F.count("*")).first()[0]
