"""One batch of files, from raw to published tables."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedupe, history, keys
from ..operators.cleaners import ENTITIES
from ..sources import landing, readers
from . import kpi
from .warehouse import ConflictError, ConstraintError, Warehouse, require, require_not_null, require_reference, require_unique

LOG_TO = logging.getLogger(__name__)
#: Parts of a dimension, by a hash of its key. A batch rewrites those that its records are in.
BUCKETS = 64
#: How often a batch is worked out if other runs publish meanwhile.
TRIES = 3
SCD = "valid_from date, valid_to date, is_current int, row_hash string, batch_id string"
DIMENSIONS = {
    "customers": ("dim_customer", "customer_sk", "customer_id string, customer_name string, email string, email_valid int, phone string, phone_valid int, account_id string, gender string, dob date, address string, kyc_status string, registration_date date"),
    "products": ("dim_product", "product_sk", "product_id string, product_name string, product_type string, category string, price decimal(15,2), launch_date date, is_active int, vendor_name string"),
    "branches": ("dim_branch", "branch_sk", "branch_id string, branch_name string, location string, manager_name string, opened_date date, region string, branch_type string, contact_number string"),
}
HASHED = ["account_id", "customer_id", "product_id", "branch_id", "txn_ts", "txn_date", "amount", "currency", "amount_inr", "payment_method", "status", "is_refund", "remarks", "date_mismatch", "needs_review"]
KEYS = ["customer_sk", "product_sk", "branch_sk"]
FACT = (
    "transaction_id string, account_id string, customer_id string, product_id string, branch_id string, txn_ts timestamp_ntz, txn_date date, amount decimal(15,2), currency string, amount_inr decimal(15,2), payment_method string, "
    "status string, is_refund int, remarks string, date_mismatch int, needs_review int, customer_sk bigint, product_sk bigint, branch_sk bigint, row_hash string, source_batch_id string, last_updated_batch_id string"
)
#: Facts are kept by day.
DAY = "date_format(txn_date, 'yyyy-MM-dd')"
#: Summaries of each day's keys, from which a batch tells the days that its records may be in.
KEY_INDEX = "fact_key_index"
LOG = "transaction_id string, batch_id string, old_values map<string,string>, new_values map<string,string>, run_id string"
OUTPUTS = {
    "dq_quarantine": "batch_id string, entity string, source_file string, record_key string, reason_codes string, raw_record string, run_id string",
    "dq_scorecard": "batch_id string, entity string, source_file string, records_received bigint, records_passed bigint, records_rejected bigint, duplicates_removed bigint, run_id string",
    "dq_issue_counts": "batch_id string, entity string, source_file string, severity string, reason_code string, record_count bigint, run_id string",
    "ingestion_log": "batch_id string, entity string, source_file string, file_name string, size_bytes bigint, sha256 string, row_count bigint, run_id string",
}
#: Sums of the facts by day, from which metrics are added up.
PARTIALS = {
    "day_by_customer": (kpi.by_customer, "txn_date date, customer_id string, txn_count bigint, net_value_inr decimal(18,2)"),
    "day_by_product_and_branch": (kpi.by_product_and_branch, "txn_date date, product_id string, product_sk bigint, branch_id string, branch_sk bigint, txn_count bigint, net_value_inr decimal(18,2), refund_count bigint, refund_value_inr decimal(18,2), gross_inr decimal(18,2)"),
}
SNAPSHOT = "kpi_name string, rank_no bigint, item_key string, item_label string, metric_value decimal(18,2), batch_id string"
RUNS = "run_id string, batch_id string, status string, received bigint, passed bigint, rejected bigint, error string, at timestamp_ntz"


@dataclass(frozen=True)
class Calendar:
    """Batches in order: their business date and the file of each entity, below `raw`."""

    raw: str
    dates: dict[str, dt.date]
    files: dict[str, dict[str, str]]

    def path(self, batch_id: str, entity: str) -> str:
        return f"{self.raw}/{batch_id}/{self.files[batch_id][entity]}"


@dataclass
class Summary:
    run_id: str
    batch_id: str
    status: str = "RUNNING"
    actions: dict[str, dict[str, int]] = field(default_factory=dict)
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def run_batch(spark: SparkSession, batch_id: str, calendar: Calendar, root: str, landing_zone: str | None = None, warehouse: type[Warehouse] = Warehouse) -> Summary:
    """Read, settle, merge and publish one batch; running it again changes nothing.

    Fails with ValueError for an unknown batch, FileNotFoundError for a missing or empty file, and
    whatever else goes wrong is audited as FAILED and leaves the published tables as they were.
    With a landing zone the raw files are kept there first, and after publication the quarantine
    is exported as CSV; an export that fails is logged and does not undo a published run. If another
    run publishes first, the batch is worked out again from what that left, up to TRIES times.
    """
    if batch_id not in calendar.dates:
        raise ValueError(f"unknown batch {batch_id}")
    for left in range(TRIES - 1, -1, -1):
        try:
            return _attempt(spark, batch_id, calendar, root, landing_zone, warehouse)
        except ConflictError:
            # another run was published meanwhile; what this one does is to be worked out anew from its tables
            if not left:
                raise
            LOG_TO.warning("%s: another run has published, trying again", batch_id)
    raise AssertionError


def _attempt(spark: SparkSession, batch_id: str, calendar: Calendar, root: str, landing_zone: str | None, warehouse: type[Warehouse]) -> Summary:
    summary = Summary(uuid.uuid4().hex, batch_id)
    store = warehouse(spark, root)
    _audit(spark, root, summary, {})
    try:
        settled = _run(spark, batch_id, calendar, store, summary, landing_zone)
    except Exception as error:
        summary.status = "FAILED"
        _audit(spark, root, summary, {}, str(error)[:2000])
        store.clear(published=False)
        raise
    summary.status = "SUCCESS"
    totals = {k: sum(c[f"records_{k}"] for c in summary.counts.values()) for k in ("received", "passed", "rejected")}
    _audit(spark, root, summary, totals)
    if landing_zone:
        for name, rows in settled.items():
            try:
                landing.write_quarantine(dedupe.quarantine(rows), f"{landing_zone}/quarantine/batch={batch_id}/{name}")
            except Exception:
                LOG_TO.exception("quarantine of %s was not exported", name)
    store.clear(published=True)
    return summary


def _run(spark: SparkSession, batch_id: str, calendar: Calendar, store: Warehouse, summary: Summary, landing_zone: str | None) -> dict[str, DataFrame]:
    day, batches = calendar.dates[batch_id], list(calendar.dates)
    settled: dict[str, DataFrame] = {}
    broken: dict[str, bool] = {}
    for name, entity in ENTITIES.items():
        path = calendar.path(batch_id, name)
        if not store.exists(path) or not store.size(path):
            raise FileNotFoundError(path)
        landing.land(spark, path, landing_zone and f"{landing_zone}/bronze", batch_id)
        source = readers.open_source(spark, path, list(entity.columns))
        broken[name] = source.broken
        # read once, then settled from short rows; the clean rows, the quarantine and all counts are taken from what is settled
        rows = store.stage(f"read_{name}", source.rows, keep=False)
        settled[name] = store.stage(f"settled_{name}", dedupe.settle(rows, entity, day), keep=False)

    dims: dict[str, DataFrame] = {}
    for name, (table, sk, _) in DIMENSIONS.items():
        entity = ENTITIES[name]
        schema, bucket = schemas()[table], F.expr(f"pmod(xxhash64({entity.key}), {BUCKETS})")
        records = dedupe.clean_records(settled[name])
        touched = {str(r["part"]) for r in records.select(bucket.alias("part")).distinct().collect()}
        old = store.read(table, schema, touched).drop(sk)
        new, actions = history.merge_versions(old, records, entity.key, list(entity.tracked), batch_id, day, batches, lambda df, name=name: store.stage(f"joined_{name}", df, keep=False))
        store.stage_parts(table, history.with_surrogate(new, entity.key, sk), bucket, touched)
        summary.actions[name] = {r["action"]: r["n"] for r in actions.collect()}
        # a key is in one bucket, so what holds in those that are written holds in the whole dimension
        changed = store.read(table, schema, touched)
        require_unique(table, changed, entity.key, "valid_from")
        require_unique(f"current {table}", changed.where("is_current = 1"), entity.key)
        require_not_null(table, changed, entity.key, "valid_from", "valid_to", "row_hash")
        dims[name] = store.read(table, schema)

    references = {"ORPHAN_ACCOUNT": ("account_id", dims["customers"].select("account_id")), "ORPHAN_PRODUCT": ("product_id", dims["products"].select("product_id")), "ORPHAN_BRANCH": ("branch_id", dims["branches"].select("branch_id"))}
    judged = dedupe.check_references(settled["transactions"], references)
    settled["transactions"] = store.stage("judged_transactions", judged, keep=False)
    records = dedupe.clean_records(settled["transactions"])
    records = history.as_of(records, dims["customers"], "account_id", "account_id", "txn_date", {"customer_sk": "customer_sk", "customer_id": "customer_id"}, "_c")
    records = history.as_of(records, dims["products"], "product_id", "product_id", "txn_date", {"product_sk": "product_sk"}, "_p")
    records = history.as_of(records, dims["branches"], "branch_id", "branch_id", "txn_date", {"branch_sk": "branch_sk"}, "_b")
    records = store.stage("resolved_transactions", records, keep=False)
    require("transactions without a version of their day", records.where("_c = 0 OR _p = 0 OR _b = 0").select("transaction_id", "txn_date"))
    # the days that the records or the facts they correct are of; all others stay as they are
    near = _days_with_keys_of(store, records)
    days = {r["part"] for r in history.touched_parts(store.read("fact_transaction", FACT, near), records, "transaction_id", F.expr(DAY)).collect()}
    old = store.read("fact_transaction", FACT, days)
    new, actions, log = history.upsert_facts(old, records, "transaction_id", HASHED, KEYS, batch_id, batches, lambda df: store.stage("joined_transactions", df, keep=False))
    summary.actions["transactions"] = {r["action"]: r["n"] for r in actions.collect()}
    if summary.actions["transactions"].get("corrected") or not store.parts("fact_correction_log"):
        store.stage("fact_correction_log", log.withColumn("run_id", F.lit(summary.run_id)), part=summary.run_id)
    written = store.stage_parts("fact_transaction", new, F.expr(DAY), days)
    # a key of another day would have made that day one of these, so what holds here holds for all facts
    changed = store.read("fact_transaction", FACT, set(written))
    require_unique("fact_transaction", changed, "transaction_id")
    require("fact_transaction has amounts of zero or less", changed.where("amount <= 0"))
    for name, (_, sk, _) in DIMENSIONS.items():
        require_reference("fact_transaction", changed, sk, dims[name])
    for table, (made, _) in PARTIALS.items():
        store.stage_parts(table, made(changed), F.expr(DAY), days)
    store.stage_parts(KEY_INDEX, keys.summaries(changed, "transaction_id", F.expr(DAY)), F.col("held_in"), days)

    _quality(spark, batch_id, calendar, store, summary, settled, broken)
    _snapshot(batch_id, batches, store, dims)
    store.publish()
    return settled


def _days_with_keys_of(store: Warehouse, records: DataFrame) -> set[str]:
    """The days whose facts may have keys of the records, by the index; days that it lacks count as such."""
    index = store.read(KEY_INDEX, keys.schema("string"))
    found = {r["held_in"] for r in keys.may_hold(index, records, "transaction_id").collect()}
    return found | (store.parts("fact_transaction").keys() - store.parts(KEY_INDEX).keys())


def _quality(spark, batch_id, calendar, store, summary, settled, broken) -> None:
    """The batch's rows of the quality tables, in place of those it had."""
    outputs = {name: spark.createDataFrame([], schema) for name, schema in OUTPUTS.items()}
    for name, rows in settled.items():
        file = calendar.files[batch_id][name]
        made = {"dq_quarantine": dedupe.quarantine(rows), "dq_scorecard": dedupe.scorecard(rows), "dq_issue_counts": _with_file_flag(dedupe.issue_counts(rows), broken[name]), "ingestion_log": readers.file_metadata(spark, calendar.path(batch_id, name))}
        summary.counts[name] = made["dq_scorecard"].first().asDict()
        c = summary.counts[name]
        if c["records_received"] != c["records_passed"] + c["records_rejected"] + c["duplicates_removed"]:
            raise ValueError(f"{file}: records do not balance: {c}")
        # rows are the records that could be read; what is lost was received, but is none
        made["ingestion_log"] = made["ingestion_log"].withColumn("row_count", F.lit(c["records_received"] - rows.where(F.array_contains("_rejects", "MALFORMED_JSON")).count()).cast("long"))
        for table, df in made.items():
            tags = {"batch_id": batch_id, "entity": name, "source_file": file, "run_id": summary.run_id}
            outputs[table] = outputs[table].unionByName(df.withColumns({k: F.lit(v) for k, v in tags.items()}))
    for table, df in outputs.items():
        store.stage(table, df, part=batch_id)


def _with_file_flag(issues: DataFrame, broken: bool) -> DataFrame:
    """The issues, and one flag for a file whose structure is broken, whether or not anything of it is lost."""
    if not broken:
        return issues
    flag = issues.sparkSession.createDataFrame([("FLAG", "MALFORMED_JSON_SALVAGED", 1)], "severity string, reason_code string, record_count long")
    return issues.unionByName(flag)


def _snapshot(batch_id, batches, store, dims) -> None:
    """The metrics as this batch leaves them, unless a later batch has been published. The facts themselves aren't read."""
    later = batches[batches.index(batch_id) + 1 :]
    if store.parts("kpi_snapshot").keys() & set(later):
        return
    days, segments = (store.read(table, schema) for table, (_, schema) in PARTIALS.items())
    new = kpi.snapshot(days, kpi.point_in_time(segments, branches=dims["branches"]), dims["customers"], batch_id)
    columns = [c.split()[0] for c in SNAPSHOT.split(", ")]
    store.stage("kpi_snapshot", new.select(*columns), part=batch_id)


def _audit(spark: SparkSession, root: str, summary: Summary, totals: dict[str, int], error: str | None = None) -> None:
    """One appended row for each change of a run's status; the last one holds."""
    row = [(summary.run_id, summary.batch_id, summary.status, *(totals.get(k) for k in ("received", "passed", "rejected")), error, dt.datetime.now(dt.UTC).replace(tzinfo=None))]
    spark.createDataFrame(row, RUNS).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/pipeline_runs")


def last_run(spark: SparkSession, root: str) -> DataFrame:
    """The latest row of the audit."""
    return spark.read.parquet(f"{root.rstrip('/')}/pipeline_runs").orderBy(F.desc("at")).limit(1)


def schemas() -> dict[str, str]:
    """Every published table of a batch's results, and its columns."""
    dims = {table: f"{columns}, {SCD}, {sk} bigint" for table, sk, columns in DIMENSIONS.values()}
    return {**dims, "fact_transaction": FACT, "fact_correction_log": LOG, KEY_INDEX: keys.schema("string"), **{table: schema for table, (_, schema) in PARTIALS.items()}, **OUTPUTS, "kpi_snapshot": SNAPSHOT}


def check(spark: SparkSession, root: str) -> list[str]:
    """What is wrong with the published tables: missing ones, columns that are missing or of another type, and broken constraints."""
    store, wrong = Warehouse(spark, root), []
    published = store.tables()
    for name, schema in schemas().items():
        if name not in published:
            wrong.append(f"{name} is missing")
            continue
        want = dict(spark.createDataFrame([], schema).dtypes)
        found = dict(store.read(name, schema).dtypes)
        wrong += [f"{name}.{c} is {found.get(c, 'missing')}, not {kind}" for c, kind in want.items() if found.get(c) != kind]
    if wrong:
        return wrong
    tables = {name: store.read(name, schema) for name, schema in schemas().items()}
    facts = tables["fact_transaction"]
    rules = [lambda: require_unique("fact_transaction", facts, "transaction_id"), lambda: require("fact_transaction has amounts of zero or less", facts.where("amount <= 0"))]
    for entity, (table, sk, _) in DIMENSIONS.items():
        rules += [lambda t=table, k=ENTITIES[entity].key: require_unique(f"current {t}", tables[t].where("is_current = 1"), k), lambda t=table, k=sk: require_reference("fact_transaction", facts, k, tables[t])]
    for rule in rules:
        try:
            rule()
        except ConstraintError as error:
            wrong.append(str(error))
    return wrong


def register_views(spark: SparkSession, root: str, calendar: Calendar | None = None) -> list[str]:
    """Temporary views of the published tables and of the metrics over them.

    With a calendar also the metrics that compare its last batch with the one before.
    """
    store = Warehouse(spark, root)
    tables = {name: store.read(name, schema) for name, schema in schemas().items()}
    facts, c, p, b = (tables[n] for n in ("fact_transaction", "dim_customer", "dim_product", "dim_branch"))
    txn = kpi.point_in_time(facts, c, p, b)
    bare, segments = (tables[name] for name in PARTIALS)
    of_product, of_branch = kpi.point_in_time(segments, products=p), kpi.point_in_time(segments, branches=b)
    of_customer = kpi.point_in_time(facts, customers=c)
    views = {
        **tables, "v_txn": txn, "v_txn_value": kpi.valued(txn), "kpi01_top_customers": kpi.top_customers(bare, c), "kpi02_branch_monthly": kpi.branch_monthly(of_branch), "kpi02_region_monthly": kpi.region_monthly(of_branch), "kpi02_monthly_levels": kpi.monthly_levels(of_branch),
        "kpi03_product_revenue": kpi.product_revenue(of_product), "kpi03_product_share": kpi.product_share(of_product), "kpi04_dormant_accounts": kpi.dormant_accounts(facts, c, p), "kpi05_suspicious_transactions": kpi.suspicious(of_customer),
        "kpi06_customer_segments": kpi.segments(bare, facts, c), "kpi07_branch_ranking": kpi.branch_ranking(of_branch), "kpi08_kyc_exposure": kpi.kyc_exposure(of_customer), "kpi09_refund_by_product": kpi.refunds_by_product(of_product),
        "kpi09_refund_by_branch": kpi.refunds_by_branch(of_branch), "kpi10_dq_scorecard": kpi.dq_scorecard(tables["dq_scorecard"], tables["dq_issue_counts"]), "kpi12_kyc_transitions": kpi.kyc_transitions(c),
    }
    if calendar and len(calendar.dates) > 1:
        before, after = list(calendar.dates)[-2:]
        dims = {"customers": c, "products": p, "branches": b}
        views |= {
            "kpi11_incremental_counts": kpi.incremental_counts(facts, tables["fact_correction_log"], dims, after, calendar.dates[after]),
            "kpi11_kpi_deltas": kpi.snapshot_deltas(tables["kpi_snapshot"], before, after), "kpi13_new_activations": kpi.new_activations(facts, c, after),
        }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
