"""Tables that change in place, as versions of Parquet folders.

A table is cut into parts, by hash of a key or by day. A change writes new folders for the
parts that it touches, and then one small version file that names the folders of all parts
of all tables: readers see all of a change or nothing, and so does a job that starts again
after a crash. Marks, such as the last batch that is in the tables, belong to the version,
so a batch is never applied twice. Folders that a change does not touch stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
#: Parts of a table that is cut by hash.
PARTS = 64


class Conflict(RuntimeError):
    """Another writer committed first; read again and repeat the change."""


class Snapshots:
    """The tables under a folder, on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self._root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Versions.

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self._root}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(place)] if self._fs.exists(place) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("_versions") if n.endswith(".json"))

    def _version(self, number: int | None = None) -> dict:
        number = max(self.versions(), default=0) if number is None else number
        if not number:
            return {"version": 0, "tables": {}, "marks": {}}
        stream = self._fs.open(self._path(f"{self._root}/_versions/{number:012d}.json"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: dict) -> int:
        """Make the version the current one, unless another writer was faster."""
        target = self._path(f"{self._root}/_versions/{version['version']:012d}.json")
        draft = self._path(f"{self._root}/_versions/_{uuid.uuid4().hex}.draft")
        self._fs.mkdirs(draft.getParent())
        stream = self._fs.create(draft, False)
        stream.write(json.dumps(version).encode())
        stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise Conflict(str(target))
        return version["version"]

    def mark(self, name: str, default: int = -1) -> int:
        return self._version()["marks"].get(name, default)

    # Reading.

    def tables(self) -> list[str]:
        return sorted(self._version()["tables"])

    def parts(self, name: str) -> dict[str, str]:
        """Part to folder of the current version."""
        return dict(self._version()["tables"][name]["parts"])

    def read(self, name: str, parts: list[str] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some of its parts; what is read stays as it is when later changes come."""
        table = self._version(version)["tables"][name]
        schema = T.StructType.fromJson(table["schema"])
        folders = [f"{self._root}/{f}" for p, f in sorted(table["parts"].items()) if parts is None or p in parts]
        return self._spark.read.schema(schema).parquet(*folders) if folders else self._spark.createDataFrame([], schema)

    def read_days(self, name: str, first: str, last: str) -> DataFrame:
        """The parts of a table cut by day from one day to another; other folders are not listed."""
        return self.read(name, [p for p in self.parts(name) if first <= p <= last])

    # Changing.

    def _part(self, table: dict) -> Column:
        if table["count"] is None:
            return F.coalesce(F.to_date(table["key"]).cast("string"), F.lit("none"))
        return F.pmod(F.xxhash64(F.col(table["key"]).cast("string")), F.lit(table["count"])).cast("string")

    def touched(self, name: str, rows: DataFrame) -> list[str]:
        """The parts that hold the keys of ``rows``: no more values than the table has parts."""
        table = self._version()["tables"][name]
        return sorted(r[0] for r in rows.select(self._part(table).alias(PART)).distinct().collect())

    def _written(self, table: dict, rows: DataFrame, sort: list[str]) -> dict[str, str]:
        folder = f"files/{uuid.uuid4().hex}"
        # A part's rows come together in few files; one that holds most of the rows is still split.
        laid = rows.withColumn(PART, self._part(table)).hint("rebalance", F.col(PART)).sortWithinPartitions(PART, *sort)
        laid.write.partitionBy(PART).parquet(f"{self._root}/{folder}")
        return {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in self._names(folder) if n.startswith(f"{PART}=")}

    def commit(
        self, tables: dict[str, DataFrame], parts: dict[str, list[str]], marks: dict[str, int] | None = None,
        sort: dict[str, list[str]] | None = None,
    ) -> int:
        """Replace the given parts of the given tables and set marks, all in one step; the new version's number."""
        version = self._version()
        for name, rows in tables.items():
            table = version["tables"][name]
            written = self._written(table, rows.select(*T.StructType.fromJson(table["schema"]).names), (sort or {}).get(name, [table["key"]]))
            stray = set(written) - set(parts[name])
            if stray:
                raise ValueError(f"rows of {name} belong to parts that are not replaced: {sorted(stray)[:5]}")
            kept = {p: f for p, f in table["parts"].items() if p not in set(parts[name])}
            table["parts"] = kept | written
        version["marks"] |= marks or {}
        version["version"] += 1
        return self._publish(version)

    def create(self, name: str, rows: DataFrame, key: str, parts: int | None = PARTS) -> int:
        """Write a new table, cut by hash of ``key`` into so many parts, or by its day if ``parts`` is None."""
        version = self._version()
        if name in version["tables"]:
            raise ValueError(f"{name} is there already")
        table = {"key": key, "count": parts, "schema": rows.schema.jsonValue(), "parts": {}}
        table["parts"] = self._written(table, rows, [key])
        version["tables"][name] = table
        version["version"] += 1
        return self._publish(version)

    def change(
        self, name: str, changes: DataFrame, operator: Callable[[DataFrame, DataFrame], DataFrame],
        marks: dict[str, int] | None = None,
    ) -> int:
        """Apply an operator that works key by key: ``operator(rows, changes)`` gives the new rows.

        Only the parts that hold keys of ``changes`` are read and written.
        """
        parts = self.touched(name, changes)
        return self.commit({name: operator(self.read(name, parts), changes)}, {name: parts}, marks)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the newest versions and the folders that only they, or no version, name.

        Run it while no change is being written; readers of older versions have to be done.
        """
        versions = self.versions()
        for number in versions[:-keep]:
            self._fs.delete(self._path(f"{self._root}/_versions/{number:012d}.json"), False)
        named = {f for v in versions[-keep:] for t in self._version(v)["tables"].values() for f in t["parts"].values()}
        gone = [f"files/{f}/{p}" for f in self._names("files") for p in self._names(f"files/{f}")
                if p.startswith(f"{PART}=") and f"files/{f}/{p}" not in named]
        for folder in gone:
            self._fs.delete(self._path(f"{self._root}/{folder}"), True)
        for f in self._names("files"):
            if not any(p.startswith(f"{PART}=") for p in self._names(f"files/{f}")):
                self._fs.delete(self._path(f"{self._root}/files/{f}"), True)
        return gone
