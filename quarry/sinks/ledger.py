"""A ledger of numbered entries, each one small JSON file, written once.

A job writes its files first and its ledger entry last: the entry is the commit. What
a died job left behind has no entry, is read by nobody, and is written over by the
next job of that number. An entry appears whole or not at all (a file of another name
is renamed); one writer at a time is assumed, a number that is taken is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A folder of the session's file system, asked through Hadoop without a Spark job."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}") if name else self._root

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._root))

    def size(self) -> int:
        """Bytes of all files below the folder."""
        return self._fs.getContentSummary(self._root).getLength() if self.exists() else 0

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write the file whole, under another name first."""
        draft = f".{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self.exists(name) or not self._fs.rename(self._at(draft), self._at(name)):
            self.delete(draft)
            raise FileExistsError(f"{self.path}/{name} is there already")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    @staticmethod
    def _name(number: int) -> str:
        return f"entry-{number:012d}.json"

    def numbers(self) -> list[int]:
        return [int(n[6:18]) for n in self.folder.names() if n.startswith("entry-") and n.endswith(".json")]

    def last_number(self) -> int:
        """The newest entry's number, -1 if there is none."""
        return max(self.numbers(), default=-1)

    def get(self, number: int) -> dict:
        return json.loads(self.folder.read(self._name(number)))

    def last(self) -> dict | None:
        number = self.last_number()
        return None if number < 0 else self.get(number)

    def append(self, number: int, entry: dict) -> None:
        self.folder.write(self._name(number), json.dumps({"number": number, **entry}))

    def rows(self, schema: str) -> DataFrame:
        """All entries as a table."""
        spark = self.folder.spark
        if not self.numbers():
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(f"{self.folder.path}/entry-*.json")
