"""Drills: runs that must fail, and a replay that must change nothing, against the published tables as they are.

Broken inputs are copies of a batch's files in a folder beside the versions, which goes afterwards.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..operators.cleaners import ENTITIES
from ..sources import readers
from . import batch
from .warehouse import Warehouse

WATCHED = ("fact_transaction", "dim_customer", "dim_product", "dim_branch", "fact_correction_log", "dq_quarantine", "dq_scorecard")


@dataclasses.dataclass(frozen=True)
class Outcome:
    drill: str
    passed: bool
    detail: str


class Crash(RuntimeError):
    pass


class CrashingWarehouse(Warehouse):
    """Fails when everything is written and nothing is visible yet."""

    def publish(self) -> int:
        raise Crash("crash before publication")


def counts(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of the tables that a failed run may not change."""
    store, schemas = Warehouse(spark, root), batch.schemas()
    return {name: store.read(name, schemas[name]).count() for name in WATCHED}


class Drills:
    def __init__(self, spark: SparkSession, calendar: batch.Calendar, root: str, batch_id: str):
        self.spark, self.calendar, self.root, self.batch_id = spark, calendar, root.rstrip("/"), batch_id
        self.folder = f"{self.root}/drill={uuid.uuid4().hex}"
        self.before = counts(spark, root)

    def _copied(self, name: str) -> batch.Calendar:
        """A calendar over a copy of the batch's files."""
        store, jvm = Warehouse(self.spark, self.root), self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        copied = dataclasses.replace(self.calendar, raw=f"{self.folder}/{name}")
        for entity in ENTITIES:
            source, fs = store._fs(self.calendar.path(self.batch_id, entity))
            target, there = store._fs(copied.path(self.batch_id, entity))
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, there, target, False, True, conf)
        return copied

    def _write(self, path: str, content: bytes) -> None:
        at, fs = Warehouse(self.spark, self.root)._fs(path)
        out = fs.create(at, True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()

    def _fails(self, drill: str, calendar: batch.Calendar, error: type[Exception], audited: bool = True, batch_id: str | None = None, warehouse: type[Warehouse] = Warehouse) -> Outcome:
        """Whether a run fails as it should, leaves the tables as they were, and says so in the audit."""
        try:
            batch.run_batch(self.spark, batch_id or self.batch_id, calendar, self.root, warehouse=warehouse)
        except Exception as raised:
            same = counts(self.spark, self.root) == self.before
            status = batch.last_run(self.spark, self.root).first()["status"] if audited else "none"
            right = isinstance(raised, error) and same and status in ("FAILED", "none")
            return Outcome(drill, right, f"{type(raised).__name__}: {str(raised)[:80]}; tables unchanged: {same}; audit: {status}")
        return Outcome(drill, False, "the run did not fail")

    def missing_file(self) -> Outcome:
        calendar = self._copied("missing")
        at, fs = Warehouse(self.spark, self.root)._fs(calendar.path(self.batch_id, "customers"))
        fs.delete(at, False)
        return self._fails("a file is missing", calendar, FileNotFoundError)

    def empty_file(self) -> Outcome:
        calendar = self._copied("empty")
        self._write(calendar.path(self.batch_id, "transactions"), b"")
        return self._fails("a file is empty", calendar, FileNotFoundError)

    def crash(self) -> Outcome:
        return self._fails("a crash when all is written", self.calendar, Crash, warehouse=CrashingWarehouse)

    def unknown_batch(self) -> Outcome:
        return self._fails("an unknown batch", self.calendar, ValueError, audited=False, batch_id=f"no-{uuid.uuid4().hex}")

    def cut_file(self) -> Outcome:
        """A JSON file that ends inside an object gives the others, and the rest of that one."""
        whole = readers.open_source(self.spark, self.calendar.path(self.batch_id, "products"), list(ENTITIES["products"].columns)).rows
        records = [r["_raw"] for r in whole.where("_raw IS NOT NULL").orderBy("_pos").limit(2).collect()]
        path = f"{self.folder}/cut.json"
        self._write(path, ("[" + ", ".join(records) + ', {"product_id": "cu').encode())
        source = readers.open_source(self.spark, path, list(ENTITIES["products"].columns))
        found = {"records": source.rows.where("_raw IS NOT NULL").count(), "lost": source.rows.where("_lost IS NOT NULL").count()}
        return Outcome("a JSON file is cut off", source.broken and found == {"records": len(records), "lost": 1}, str(found))

    def replay(self) -> Outcome:
        """The batch once more: what it brought is there already, or newer."""
        run = batch.run_batch(self.spark, self.batch_id, self.calendar, self.root)
        same = counts(self.spark, self.root) == self.before
        actions = {a for found in run.actions.values() for a in found}
        return Outcome("a batch is run again", same and actions <= {"unchanged", "skipped_newer_exists"}, f"actions: {sorted(actions)}; tables unchanged: {same}")

    def run(self) -> list[Outcome]:
        drills: list[Callable[[], Outcome]] = [self.missing_file, self.empty_file, self.crash, self.unknown_batch, self.cut_file, self.replay]
        try:
            return [drill() for drill in drills]
        finally:
            at, fs = Warehouse(self.spark, self.root)._fs(self.folder)
            fs.delete(at, True)
