"""State tables as Parquet folders, published together by one small pointer file.

A run writes folders of its own and never touches the ones a reader may be using. The pointer of
the new version, created last and once, names the folders of every table; a run that fails before
that leaves the state as it was and may simply start over.

A table with a key takes changed rows as a folder of their own, so a run writes what changed and
not the whole table. These rows carry the number of their version; all change folders are read as
one table, of which the latest row of a key counts. `compact` puts a table back into one folder; it
is a step of its own, due when `folders` has reached COMPACT_AT.
"""

from __future__ import annotations

import json
from typing import NamedTuple
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncloom.operators.skew import latest
from syncloom.operators.upserts import upsert
from syncloom.schemas import STATE, STATE_KEYS, conform
from syncloom.session import no_rows, together

#: Folders of a table from which on it should be compacted: a day of runs, one each quarter hour.
COMPACT_AT = 96
#: Runs that a pointer remembers as published; over a month of them.
REMEMBERED_RUNS = 4096

_VERSION = "_version"


class StateConflict(RuntimeError):
    """Another run has published since this one began."""


class Version(NamedTuple):
    number: int
    runs: tuple[str, ...]
    folders: dict[str, list[str]]


class StateStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, str] | None = None,
        keys: dict[str, list[str]] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = STATE if tables is None else tables
        self.keys = STATE_KEYS if keys is None else keys

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def newest(self) -> Version:
        """The version that counts: one listing of names, one small file."""
        folder, files = self._path("_versions")
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n[:1].isdigit()]
        if not numbers:
            return Version(0, (), {})
        path, files = self._path(f"_versions/{max(numbers):09d}.json")
        stream = files.open(path)
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(max(numbers), tuple(found["runs"]), found["folders"])

    def _create_once(self, name: str, text: str) -> bool:
        """Whether the file came to be, whole and by this call; never replaces one.

        The text is written aside and linked or renamed to its name. Renaming is what decides between
        two runs where the file system renames at once and not over a file, as HDFS does; on a local
        file system a hard link does the same.
        """
        path, files = self._path(name)
        aside, _ = self._path(f"{name.rpartition('/')[0]}/_{uuid4().hex}")
        jvm = self.spark._jvm
        out = files.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if files.getScheme() == "file":
                paths = [jvm.java.nio.file.Path.of(p.toUri().getPath(), self._array("java.lang.String")) for p in (path, aside)]
                jvm.java.nio.file.Files.createLink(*paths)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    path.toUri(), self.spark._jsc.hadoopConfiguration()
                )
                context.rename(aside, path, self._array("org.apache.hadoop.fs.Options$Rename"))
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        finally:
            files.delete(aside, False)
        stream = files.open(path)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") == text
        finally:
            stream.close()

    def _array(self, kind: str):
        """An empty array of a Java class."""
        found = self.spark._jvm.java.lang.Class.forName(kind)
        return self.spark._jvm.java.lang.reflect.Array.newInstance(found, 0)

    def published(self, run_id: str) -> bool:
        return run_id in self.newest().runs

    def folders(self, table: str) -> int:
        return len(self.newest().folders.get(table, ()))

    def _read(self, table: str, folders: dict[str, list[str]]) -> DataFrame:
        ddl = self.tables[table]
        paths = folders.get(table)
        if not paths:
            return no_rows(self.spark, ddl)
        reader = self.spark.read
        if table not in self.keys or len(paths) == 1:
            return reader.schema(ddl).parquet(*paths)
        base = reader.schema(ddl).parquet(paths[0])
        changes = reader.schema(f"{ddl}, {_VERSION} long").parquet(*paths[1:])
        keys = self.keys[table]
        newest = changes if len(paths) == 2 else latest(changes, keys, [_VERSION])
        return upsert(base, newest, keys)

    def read(self, table: str) -> DataFrame:
        """A table as last published."""
        return self._read(table, self.newest().folders)

    def begin(self, run_id: str) -> "Commit":
        return Commit(self, run_id)

    def compact(self, table: str, run_id: str) -> None:
        """Put a table of many folders back into one, as a version of its own.

        The table is read and written whole, so this is called now and then and not by a run.
        """
        commit = self.begin(run_id)
        if len(commit.before.get(table, [])) > 1:
            commit.overwrite(table, commit.read(table))
            commit.publish()


class Commit:
    """The tables one run writes; they become the state when it publishes."""

    def __init__(self, store: StateStore, run_id: str):
        self.store = store
        self.run_id = run_id
        self.base = store.newest()
        self.done = run_id in self.base.runs
        self.version = self.base.number + 1
        self.before = self.base.folders
        self.folders = dict(self.before)
        self.writes: dict[str, DataFrame] = {}
        # What an attempt leaves that comes to nothing is in no other one's way.
        self.attempt = f"{self.version:09d}-{quote(run_id, safe='')}-{uuid4().hex[:8]}"

    def read(self, table: str) -> DataFrame:
        """A table as it was when the run began."""
        return self.store._read(table, self.before)

    def _add(self, table: str, df: DataFrame, kept: list[str]) -> None:
        path = f"{self.store.root}/{table}/{self.attempt}"
        rows = conform(df, self.store.tables[table])
        if table in self.store.keys:
            rows = rows.withColumn(_VERSION, F.lit(self.version).cast("long"))
        self.writes[path] = rows
        self.folders[table] = [*kept, path]

    def overwrite(self, table: str, df: DataFrame) -> None:
        """The table is these rows."""
        self._add(table, df, [])

    def append(self, table: str, df: DataFrame) -> None:
        """The table has these rows too."""
        self._add(table, df, self.before.get(table, []))

    def change(self, table: str, df: DataFrame) -> None:
        """The table has these rows in place of those it held under their keys."""
        self._add(table, df, self.before.get(table, []))

    def publish(self) -> None:
        """Write the tables, all at once, and then the pointer.

        The pointer is named by its number alone, so of runs that began on one version one creates
        it and the others fail.
        """
        together(*[lambda df=df, path=path: df.write.parquet(path) for path, df in self.writes.items()])
        runs = [*self.base.runs, self.run_id][-REMEMBERED_RUNS:]
        text = json.dumps({"run": self.attempt, "runs": runs, "folders": self.folders})
        if not self.store._create_once(f"_versions/{self.version:09d}.json", text):
            raise StateConflict(f"version {self.version} was published since this run began")
