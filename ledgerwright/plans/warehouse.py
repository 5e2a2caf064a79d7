"""Tables that a batch publishes all at once, or not at all.

A batch writes every table it changes to a folder of its own version and then adds one small manifest
with the next number, which only one of two runs can do. Readers follow the last manifest, so an
interrupted batch leaves nothing visible, and what is being read is never overwritten. A table is one
part, or several (days, batches, runs), each with its folder, so that a batch writes the parts it
changes and the manifest keeps the others. Audit rows live beside the versions.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "manifests"


class ConflictError(RuntimeError):
    """Another run has published since this one began to read."""


class Warehouse:
    """A folder on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version = uuid.uuid4().hex
        self.staged: dict[str, dict[str, str]] = {}
        self._seen: tuple[int, dict[str, dict[str, str]]] | None = None

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def size(self, path: str) -> int:
        p, fs = self._fs(path)
        return fs.getFileStatus(p).getLen()

    def numbers(self) -> list[int]:
        """The numbers of all manifests, in order."""
        folder, fs = self._fs(f"{self.root}/{MANIFESTS}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))

    def manifest(self, number: int) -> dict[str, dict[str, str]]:
        path, fs = self._fs(f"{self.root}/{MANIFESTS}/{number:012d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def tables(self) -> dict[str, dict[str, str]]:
        """The published tables: the folder of each of their parts. They stay as they were when first looked at."""
        if self._seen is None:
            last = max(self.numbers(), default=0)
            self._seen = last, self.manifest(last) if last else {}
        return self._seen[1]

    def latest(self) -> dict[str, dict[str, str]]:
        """The published tables as they are now."""
        self._seen = None
        return self.tables()

    def parts(self, name: str) -> dict[str, str]:
        """A table's parts as this batch sees them: staged if it has written any, else published."""
        return self.staged[name] if name in self.staged else self.tables().get(name, {})

    def read(self, name: str, schema: str, only: set[str] | None = None) -> DataFrame:
        """A table, or only some of its parts, as this batch sees it; empty where there are none."""
        paths = [path for part, path in self.parts(name).items() if only is None or part in only]
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def stage(self, name: str, df: DataFrame, keep: bool = True, part: str = "") -> DataFrame:
        """Write a table of this batch, or one part of it, and read that; unless it is to be kept, clear() deletes it."""
        path = f"{self.root}/{'v' if keep else 'scratch'}={self.version}/{name}" + (f"/part={part}" if part else "")
        df.write.mode("errorifexists").parquet(path)
        if keep:
            self.staged[name] = {**self.parts(name), part: path} if part else {"": path}
        return self.spark.read.parquet(path)

    def stage_parts(self, name: str, df: DataFrame, part: Column, instead: set[str]) -> list[str]:
        """Write rows by their part in place of some parts of a table, whose other parts stay; the names of those written.

        A large part becomes several files, small ones aren't scattered over many.
        """
        path = f"{self.root}/v={self.version}/{name}"
        placed = df.withColumn("part", part)
        placed.hint("rebalance", F.col("part")).write.mode("errorifexists").partitionBy("part").parquet(path)
        folder, fs = self._fs(path)
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        made = {n.removeprefix("part="): f"{path}/{n}" for n in names if n.startswith("part=")}
        self.staged[name] = {k: p for k, p in self.parts(name).items() if k not in instead} | made
        return list(made)

    def publish(self) -> int:
        """Make all staged tables visible with the next manifest; its number.

        A run that read older tables than are published now gets a ConflictError: what it merged into
        is no longer what holds.
        """
        whole = json.dumps({**self.tables(), **self.staged}, sort_keys=True)
        number = self._seen[0] + 1
        path, fs = self._fs(f"{self.root}/{MANIFESTS}/{number:012d}.json")
        fresh, _ = self._fs(f"{self.root}/{MANIFESTS}/.{self.version}")
        out = fs.create(fresh, True)
        try:
            out.write(bytearray(whole.encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(fresh, path, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as error:
            fs.delete(fresh, False)
            if not fs.exists(path):
                raise
            raise ConflictError(f"manifest {number} of {self.root} is another run's") from error
        self._seen, self.staged = (number, json.loads(whole)), {}
        return number

    def clear(self, published: bool) -> None:
        """Delete this run's scratch tables, and all it wrote if it wasn't published."""
        for kind in ("scratch",) if published else ("scratch", "v"):
            p, fs = self._fs(f"{self.root}/{kind}={self.version}")
            fs.delete(p, True)

    def sweep(self, keep: int = 2, idle_seconds: float = 86_400) -> list[str]:
        """Delete manifests but the last `keep`, and the folders that none of these names; what was deleted.

        A version's folder in which something was written in the last idle_seconds may be that of a run
        that goes on, and stays. Readers of older manifests must be done.
        """
        numbers = self.numbers()
        named = {path.removeprefix(f"{self.root}/") for n in numbers[-keep:] for parts in self.manifest(n).values() for path in parts.values()}
        root, fs = self._fs(self.root)
        gone: list[str] = []

        def delete(status) -> None:
            gone.append(status.getPath().getName())
            fs.delete(status.getPath(), True)

        for version in fs.listStatus(root) if fs.exists(root) else []:
            name = version.getPath().getName()
            if not re.match("(v|scratch)=", name):
                continue
            tables = list(fs.listStatus(version.getPath()))
            parts = {t.getPath().getName(): list(fs.listStatus(t.getPath())) for t in tables}
            latest = max(s.getModificationTime() for s in (version, *tables, *(p for some in parts.values() for p in some)))
            if time.time() - latest / 1000 < idle_seconds:
                continue
            for table in tables:
                own = f"{name}/{table.getPath().getName()}"
                if own in named:
                    continue
                kept = [p for p in parts[table.getPath().getName()] if f"{own}/{p.getPath().getName()}" in named]
                for p in (p for p in parts[table.getPath().getName()] if p not in kept and p.isDirectory()) if kept else ():
                    delete(p)
                if not kept:
                    delete(table)
            if not fs.listStatus(version.getPath()):
                delete(version)
        for n in numbers[:-keep]:
            fs.delete(self._fs(f"{self.root}/{MANIFESTS}/{n:012d}.json")[0], False)
            gone.append(str(n))
        return gone

    def drop(self, yes: bool = False) -> None:
        """Remove everything; only with a clear yes."""
        if not yes:
            raise ValueError("this removes all tables; say yes")
        p, fs = self._fs(self.root)
        fs.delete(p, True)


class ConstraintError(ValueError):
    """Rows that no version may hold."""


def require(name: str, offending: DataFrame) -> None:
    """Raise if a frame of offending rows has any."""
    some = offending.limit(3).collect()
    if some:
        raise ConstraintError(f"{name}: {re.sub(r'Row', '', str(some))}")


def require_unique(name: str, df: DataFrame, *keys: str) -> None:
    require(f"{name} is not unique by {', '.join(keys)}", df.groupBy(*keys).count().where("count > 1"))


def require_not_null(name: str, df: DataFrame, *columns: str) -> None:
    require(f"{name} has nulls", df.where(" OR ".join(f"{c} IS NULL" for c in columns)))


def require_reference(name: str, df: DataFrame, key: str, target: DataFrame) -> None:
    require(f"{name} refers to nothing by {key}", df.join(target.select(key), key, "left_anti").select(key))
