"""A report of data quality in Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What becomes of a record with a code.
HANDLING = {
    "AMBIGUOUS_DATE": "kept; read with the day first",
    "CONFLICTING_DUPLICATE": "quarantined, all versions of the key",
    "DATE_MISMATCH": "kept; the timestamp's day is the date",
    "EXACT_DUPLICATE": "dropped; the first copy stays",
    "FUTURE_DATED": "quarantined; later than the batch's day",
    "INVALID_AMOUNT": "quarantined; no finite number",
    "INVALID_CONTACT": "kept; number marked as invalid",
    "INVALID_DOB": "kept without a date of birth that can be true",
    "INVALID_EMAIL": "kept; address marked as invalid",
    "INVALID_PHONE": "kept; number marked as invalid",
    "INVALID_REFUND_FLAG": "quarantined; neither yes nor no",
    "MALFORMED_JSON": "quarantined; a fragment that is no object",
    "MALFORMED_JSON_SALVAGED": "file read object by object",
    "MISSING_ACCOUNT_ID": "quarantined; nobody owns the record",
    "MISSING_AMOUNT": "quarantined",
    "MISSING_DOB": "kept without date of birth",
    "MISSING_EMAIL": "kept without address",
    "MISSING_GENDER": "kept as unknown",
    "MISSING_IS_ACTIVE": "kept; taken as not active",
    "MISSING_MANAGER": "kept as unknown",
    "MISSING_PRODUCT_NAME": "kept without name",
    "MISSING_REFUND_FLAG": "kept; taken as no refund",
    "NEAR_DUPLICATE_RESOLVED": "dropped; the copy with the fewest flags stays",
    "NEGATIVE_AMOUNT": "quarantined; not marked as a refund",
    "NEGATIVE_PRICE_CORRECTED": "kept with the sign removed",
    "NON_INR_CURRENCY": "kept for review, outside rupee metrics",
    "ORPHAN_ACCOUNT": "quarantined; no customer has the account",
    "ORPHAN_BRANCH": "quarantined; no such branch",
    "ORPHAN_PRODUCT": "quarantined; no such product",
    "SHARED_ACCOUNT_ID": "quarantined; the first registered customer keeps the account",
    "ZERO_AMOUNT": "quarantined",
}


def quality_report(scorecard: DataFrame, issues: DataFrame) -> str:
    """scorecard: K10's rows; issues: (batch_id, severity, reason_code, record_count). Both are small."""
    columns = ["batch_id", "source_file", "records_received", "records_passed", "records_rejected", "duplicates_removed", "pass_rate_pct", "top_3_reject_reasons"]
    out = ["# Data quality", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    out += ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in columns) + " |" for r in scorecard.orderBy("batch_id", "source_file").collect()]
    out += ["", "| batch | severity | code | records | handling |", "|---|---|---|---|---|"]
    totals = issues.groupBy("batch_id", "severity", "reason_code").sum("record_count").orderBy("batch_id", "severity", "reason_code")
    for r in totals.collect():
        handling = HANDLING.get(r["reason_code"], "quarantined" if r["severity"] == "REJECT" else "kept and flagged")
        out.append(f"| {r['batch_id']} | {r['severity']} | {r['reason_code']} | {r[3]} | {handling} |")
    return "\n".join(out) + "\n"
