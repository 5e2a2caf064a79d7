"""Command line: run a batch, check the tables, report, profile, reset."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from . import session
from .operators.cleaners import ENTITIES
from .plans import batch, report, serving
from .plans.drills import Drills
from .plans.warehouse import Warehouse
from .sources import readers


def calendar(path: str) -> batch.Calendar:
    """From JSON: {"raw": folder, "batches": {id: {"date": ISO date, "files": {entity: name}}}}, in order."""
    with open(path) as f:
        config = json.load(f)
    found = config["batches"]
    return batch.Calendar(config["raw"], {k: dt.date.fromisoformat(v["date"]) for k, v in found.items()}, {k: v["files"] for k, v in found.items()})


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerwright")
    # settings come from the environment as it is when the command runs; arguments override them
    for name, needed in (("calendar", True), ("warehouse", True), ("landing-zone", False)):
        value = os.environ.get("LEDGERWRIGHT_" + name.upper().replace("-", "_"))
        parser.add_argument(f"--{name}", default=value, required=needed and not value)
    actions = parser.add_subparsers(dest="action", required=True)
    actions.add_parser("run").add_argument("--batch-id", required=True)
    actions.add_parser("profile").add_argument("--batch-id", required=True)
    actions.add_parser("drill").add_argument("--batch-id", required=True)
    actions.add_parser("report")
    actions.add_parser("check")
    sweep = actions.add_parser("sweep")
    sweep.add_argument("--keep", type=int, default=2)
    sweep.add_argument("--idle-seconds", type=float, default=86_400)
    actions.add_parser("reset").add_argument("--yes", action="store_true")
    args = parser.parse_args(argv)
    spark, batches = session.build(), calendar(args.calendar)
    store = Warehouse(spark, args.warehouse)
    try:
        if args.action == "run":
            print(batch.run_batch(spark, args.batch_id, batches, args.warehouse, args.landing_zone))
        elif args.action == "profile":
            for name, entity in ENTITIES.items():
                rows = readers.read_source(spark, batches.path(args.batch_id, name), list(entity.columns))
                raw = rows.select(*entity.columns)
                serving.duplicates(raw, entity.key).show()
                serving.profile(raw).orderBy("column_name", "shape_rank").show(1000, truncate=False)
        elif args.action == "report":
            batch.register_views(spark, args.warehouse, batches)
            print(report.quality_report(spark.table("kpi10_dq_scorecard"), spark.table("dq_issue_counts")))
        elif args.action == "check":
            if wrong := batch.check(spark, args.warehouse):
                raise ValueError("; ".join(wrong))
            print("all tables are as they should be")
        elif args.action == "drill":
            outcomes = Drills(spark, batches, args.warehouse, args.batch_id).run()
            for o in outcomes:
                print(f"{'pass' if o.passed else 'FAIL'}  {o.drill}: {o.detail}")
            return int(not all(o.passed for o in outcomes))
        elif args.action == "sweep":
            print(f"deleted {len(store.sweep(args.keep, args.idle_seconds))} manifests and folders")
        else:
            store.drop(args.yes)
    except (ValueError, FileNotFoundError) as error:
        print(f"error: {error}")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
