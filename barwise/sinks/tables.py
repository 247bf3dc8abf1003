"""Partitioned Parquet tables that are staged, checked and then published (K2, K3, M1-M3).

Rows are first written to a staging folder that no reader sees. Only when the
job and its checks are over is the staged data published, so a job that is
lost or refused leaves the table as it was. Two kinds of table do this:

``PlainTable``: ``path/month=.../*.parquet``, read by anything that reads
Parquet folders. Each partition is swapped by renames; a reader between two of
them may see some months old and some new.

``VersionedTable``: a version is a small file that lists the folders of each
partition; readers follow the highest version. One rename publishes all
partitions of a load at once, a reader keeps the files it started with, and a
second writer that started from the same version is refused. Needs a file
system whose rename is atomic (HDFS, a local disk). Old folders stay until
``vacuum``.

What comes to the driver is one name per partition of the table (months).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

MODES = ("overwrite", "truncate", "append")


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read again: what it takes to derive it is done once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class StaleVersion(ValueError):
    """Another writer published a version in between."""


class Files:
    """The few file operations needed, through the file system of the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)
        self.new_array = spark.sparkContext._gateway.new_array

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, p: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(p))) if self.exists(p) else []

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def make(self, p: str) -> None:
        self.fs.mkdirs(self.path(p))

    def move(self, a: str, b: str) -> None:
        """Rename; fails if ``b`` is there."""
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.new_array(rename, 1)
        how[0] = rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(a).toUri(), self.conf)
        context.rename(self.path(a), self.path(b), how)

    def write(self, p: str, text: str) -> None:
        out = self.fs.create(self.path(p), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


@dataclass
class Staged:
    """Rows written but not published: their folder, schema and partition values."""

    folder: str
    schema: StructType
    parts: list[str]


class PlainTable:
    """Partition folders right under ``path``."""

    def __init__(self, spark: SparkSession, path: str, part: str = "month"):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.files = Files(spark, self.path)

    def _staging(self) -> str:
        return f"{self.path}/_staged/{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, parts: Iterable[str] | None = None, max_records_per_file: int = 5_000_000) -> Staged:
        """Write ``df`` by ``parts`` (the table's partition column first) to a folder of its own."""
        folder, cols = self._staging(), list(parts or [self.part])
        df.write.option("maxRecordsPerFile", max_records_per_file).partitionBy(*cols).parquet(folder)
        mark = f"{self.part}="
        found = [n[len(mark):] for n in self.files.names(folder) if n.startswith(mark)]
        return Staged(folder, df.schema, found)

    def staged_rows(self, staged: Staged) -> DataFrame:
        return self.spark.read.schema(staged.schema).parquet(staged.folder)

    def discard(self, staged: Staged) -> None:
        self.files.delete(staged.folder)

    def exists(self) -> bool:
        return any(n.startswith(f"{self.part}=") for n in self.files.names(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def publish(self, staged: Staged, mode: str = "overwrite", drop: Iterable[str] = ()) -> None:
        """``overwrite`` replaces the staged partitions, ``truncate`` the table, ``append`` adds files.

        Partitions in ``drop`` that were not staged are removed.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        had = {n for n in self.files.names(self.path) if n.startswith(f"{self.part}=")}
        new = {f"{self.part}={v}" for v in staged.parts}
        for name in sorted(new):
            source, target = f"{staged.folder}/{name}", f"{self.path}/{name}"
            if mode == "append" and name in had:
                self._merge(source, target)
                continue
            if name in had:
                self.files.move(target, f"{staged.folder}/_old-{name}")
            self.files.move(source, target)
        gone = had - new if mode == "truncate" else {f"{self.part}={v}" for v in drop} & had - new
        for name in sorted(gone):
            self.files.delete(f"{self.path}/{name}")
        self.discard(staged)

    def _merge(self, source: str, target: str) -> None:
        for name in self.files.names(source):
            if "=" in name and self.files.exists(f"{target}/{name}"):
                self._merge(f"{source}/{name}", f"{target}/{name}")
            else:
                self.files.move(f"{source}/{name}", f"{target}/{name}")


class VersionedTable(PlainTable):
    """Partition folders under ``path/data/load=...``, listed by ``path/_versions/<number>.json``."""

    LOAD = "load"

    def _staging(self) -> str:
        return f"{self.path}/data/{self.LOAD}={uuid.uuid4().hex}"

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max((int(n[:-5]) for n in self.files.names(f"{self.path}/_versions") if n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``schema`` and ``folders`` (partition value to folders) of a version."""
        v = self.version() if version is None else version
        return json.loads(self.files.read(self._file(v))) if v else {"schema": None, "folders": {}}

    def _file(self, version: int) -> str:
        return f"{self.path}/_versions/{version:010d}.json"

    def exists(self) -> bool:
        return self.version() > 0

    def read(self, version: int | None = None) -> DataFrame:
        """The table of the newest (or the given) version; later versions do not change the result."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.path}: no version is published")
        schema = StructType.fromJson(m["schema"])
        paths = [f"{self.path}/data/{f}" for fs in m["folders"].values() for f in fs]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(StructType(schema.fields).add(self.LOAD, StringType()))
        return read.option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    def staged_rows(self, staged: Staged) -> DataFrame:
        return self.spark.read.schema(staged.schema).option("basePath", staged.folder).parquet(staged.folder)

    def publish(self, staged: Staged, mode: str = "overwrite", drop: Iterable[str] = (), base: int | None = None,
                note: dict | None = None) -> int:
        """Make the staged partitions part of the next version, by one rename; returns its number.

        ``note`` is kept with the version (``manifest()["note"]``), such as the number of a batch.

        ``base``: the version the rows were computed from (default: the newest
        now). If another writer has published since, nothing changes and
        ``StaleVersion`` is raised.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        base = self.version() if base is None else base
        folders = {} if mode == "truncate" else dict(self.manifest(base)["folders"])
        if mode != "append":
            for v in [*drop, *staged.parts]:
                folders.pop(v, None)
        load = staged.folder.rsplit("/", 1)[1]
        for v in staged.parts:
            folders[v] = [*folders.get(v, []), f"{load}/{self.part}={v}"]
        body = json.dumps({"schema": staged.schema.jsonValue(), "folders": folders, "note": note}, sort_keys=True)
        draft = f"{self.path}/_versions/.draft-{uuid.uuid4().hex}"
        self.files.make(f"{self.path}/_versions")
        self.files.write(draft, body)
        try:
            self.files.move(draft, self._file(base + 1))
        except Exception as e:  # noqa: BLE001 - told apart by what is there now
            self.files.delete(draft)
            if self.version() > base:
                raise StaleVersion(f"{self.path}: version {base + 1} was published by another writer") from e
            raise
        return base + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the load folders that none of the last ``keep`` versions lists; returns their names.

        Run it when no load is under way: staged folders are not listed yet.
        """
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        used = {f.split("/", 1)[0] for v in kept for fs in self.manifest(v)["folders"].values() for f in fs}
        gone = [n for n in self.files.names(f"{self.path}/data") if n.startswith(f"{self.LOAD}=") and n not in used]
        for n in gone:
            self.files.delete(f"{self.path}/data/{n}")
        for v in range(1, last):
            if v not in kept and self.files.exists(self._file(v)):
                self.files.delete(self._file(v))
        return gone


Table = PlainTable


def open_table(spark: SparkSession, path: str | PlainTable, part: str = "month") -> PlainTable:
    """``path`` as a table: a given table as it is; a folder with versions as a versioned one; else a plain one."""
    if isinstance(path, PlainTable):
        return path
    versioned = VersionedTable(spark, path, part)
    return versioned if versioned.exists() else PlainTable(spark, path, part)


def read_table_at(spark: SparkSession, path: str | PlainTable) -> DataFrame:
    return open_table(spark, path).read()
