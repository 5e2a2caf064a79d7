"""Per-record standardisation: clean columns, every reason to reject, every flag, in one projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import text as tx
from ..sources.readers import LOST, POSITION, RAW

REJECTS, FLAGS = "_rejects", "_flags"
MAX_AGE = 120


def _codes(*named: tuple[str, Column]) -> Column:
    """The codes whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(F.coalesce(condition, F.lit(False)), F.lit(code)) for code, condition in named]))


def _blank(c: Column) -> Column:
    return c == ""


def customer(batch_date: dt.date) -> tuple[dict[str, Column], Column, Column]:
    raw = F.col
    customer_id, account = tx.clean_text(raw("customer_id")), F.upper(tx.clean_text(raw("account_id")))
    kyc, gender = tx.lookup(raw("kyc_status"), codes.KYC), tx.lookup(raw("gender"), codes.GENDER)
    email, phone = tx.clean_email(raw("email")), tx.clean_phone(raw("phone"))
    dob, registered = tx.parse_date(raw("dob")), tx.parse_date(raw("registration_date"))
    implausible = (dob > F.lit(batch_date)) | (F.lit(batch_date.year) - F.year(dob) > MAX_AGE)
    clean = {
        "customer_id": customer_id,
        "customer_name": tx.clean_text(raw("customer_name")),
        "email": email.value,
        "email_valid": F.coalesce(email.valid, F.lit(False)).cast("int"),
        "phone": phone.value,
        "phone_valid": phone.valid.cast("int"),
        "account_id": account,
        "gender": F.coalesce(gender, F.lit("Unknown")),
        "dob": F.when(~implausible, dob),
        "address": tx.blank_to_null(tx.title_case(raw("address"))),
        "kyc_status": kyc,
        "registration_date": registered,
    }
    rejects = _codes(("MISSING_CUSTOMER_ID", _blank(customer_id)), ("MISSING_ACCOUNT_ID", _blank(account)), ("INVALID_KYC_STATUS", kyc.isNull()))
    flags = _codes(
        ("MISSING_EMAIL", email.value.isNull()),
        ("INVALID_EMAIL", email.value.isNotNull() & ~email.valid),
        ("INVALID_PHONE", ~phone.valid),
        ("MISSING_GENDER", gender.isNull()),
        ("MISSING_DOB", dob.isNull()),
        ("INVALID_DOB", implausible),
        ("AMBIGUOUS_DATE", tx.is_ambiguous_date(raw("registration_date"))),
        ("INVALID_REGISTRATION_DATE", registered.isNull()),
    )
    return clean, rejects, flags


def product(batch_date: dt.date) -> tuple[dict[str, Column], Column, Column]:
    raw = F.col
    product_id, name = tx.clean_text(raw("product_id")), tx.clean_text(raw("product_name"))
    kind, category = tx.lookup(raw("product_type"), codes.PRODUCT_TYPE), tx.lookup(raw("category"), codes.CATEGORY)
    price, active = tx.parse_amount(raw("price")), tx.parse_bool(raw("is_active"))
    clean = {
        "product_id": product_id,
        "product_name": tx.blank_to_null(name),
        "product_type": kind,
        "category": category,
        "price": F.abs(price).cast("decimal(15,2)"),
        "launch_date": tx.parse_date(raw("launch_date")),
        "is_active": F.coalesce(active, F.lit(False)).cast("int"),
        "vendor_name": tx.blank_to_null(tx.clean_text(raw("vendor_name"))),
    }
    rejects = _codes(
        ("MISSING_PRODUCT_ID", _blank(product_id)), ("INVALID_PRODUCT_TYPE", kind.isNull()), ("INVALID_CATEGORY", category.isNull()), ("INVALID_PRICE", price.isNull())
    )
    flags = _codes(("NEGATIVE_PRICE_CORRECTED", price < 0), ("MISSING_IS_ACTIVE", active.isNull()), ("MISSING_PRODUCT_NAME", _blank(name)))
    return clean, rejects, flags


def branch(batch_date: dt.date) -> tuple[dict[str, Column], Column, Column]:
    raw = F.col
    branch_id, manager = tx.clean_text(raw("branch_id")), tx.clean_text(raw("manager_name"))
    region, kind = tx.lookup(raw("region"), codes.REGION), tx.lookup(raw("branch_type"), codes.BRANCH_TYPE)
    contact = tx.clean_phone(raw("contact_number"))
    clean = {
        "branch_id": branch_id,
        "branch_name": tx.clean_text(raw("branch_name")),
        "location": tx.title_case(raw("location")),
        "manager_name": F.when(_blank(manager), "UNKNOWN").otherwise(manager),
        "opened_date": tx.parse_date(raw("opened_date")),
        "region": region,
        "branch_type": kind,
        "contact_number": contact.value,
    }
    rejects = _codes(("MISSING_BRANCH_ID", _blank(branch_id)), ("INVALID_REGION", region.isNull()), ("INVALID_BRANCH_TYPE", kind.isNull()))
    flags = _codes(("MISSING_MANAGER", _blank(manager)), ("INVALID_CONTACT", ~contact.valid), ("AMBIGUOUS_DATE", tx.is_ambiguous_date(raw("opened_date"))))
    return clean, rejects, flags


def transaction(batch_date: dt.date) -> tuple[dict[str, Column], Column, Column]:
    """The timestamp gives the date; a date column that has no reading equal to it is only flagged."""
    raw = F.col
    transaction_id = tx.clean_text(raw("transaction_id"))
    keys = {k: F.upper(tx.clean_text(raw(k))) for k in ("account_id", "product_id", "branch_id")}
    ts = tx.parse_timestamp(raw("timestamp"))
    day = ts.cast("date")
    mismatch = ts.isNotNull() & ~F.coalesce(F.array_contains(tx.date_candidates(raw("date")), day), F.lit(False))
    refund, refund_text = tx.lookup(raw("is_refund"), codes.REFUND), tx.clean_text(raw("is_refund"))
    amount, amount_text = tx.parse_amount(raw("amount")), tx.clean_text(raw("amount"))
    status, payment = tx.lookup(raw("status"), codes.STATUS), tx.lookup(raw("payment_method"), codes.PAYMENT)
    currency = F.upper(tx.clean_text(raw("currency")))
    foreign = currency != "INR"
    clean = {
        "transaction_id": transaction_id,
        **keys,
        "txn_ts": ts,
        "txn_date": day,
        "amount": amount,
        "currency": currency,
        "amount_inr": F.when(~foreign, amount),
        "payment_method": payment,
        "status": status,
        "is_refund": F.coalesce(refund, F.lit(False)).cast("int"),
        "remarks": tx.clean_remarks(raw("remarks")),
        "date_mismatch": mismatch.cast("int"),
        "needs_review": foreign.cast("int"),
    }
    missing_key = _blank(transaction_id) | _blank(keys["account_id"]) | _blank(keys["product_id"]) | _blank(keys["branch_id"])
    rejects = _codes(
        ("MISSING_KEY", missing_key),
        ("INVALID_TIMESTAMP", ts.isNull()),
        ("FUTURE_DATED", day > F.lit(batch_date)),
        ("INVALID_REFUND_FLAG", refund.isNull() & ~_blank(refund_text)),
        ("MISSING_AMOUNT", _blank(amount_text)),
        ("INVALID_AMOUNT", ~_blank(amount_text) & amount.isNull()),
        ("ZERO_AMOUNT", amount == 0),
        ("NEGATIVE_AMOUNT", amount < 0),
        ("INVALID_STATUS", status.isNull()),
        ("INVALID_PAYMENT_METHOD", payment.isNull()),
        ("INVALID_CURRENCY", F.length(currency) != 3),
    )
    flags = _codes(("DATE_MISMATCH", mismatch), ("MISSING_REFUND_FLAG", refund.isNull() & _blank(refund_text)), ("NON_INR_CURRENCY", foreign))
    return clean, rejects, flags


@dataclass(frozen=True)
class Entity:
    """What the engine needs to know of one kind of record; new kinds are added to ENTITIES."""

    name: str
    key: str
    columns: tuple[str, ...]
    cleaner: Callable[[dt.date], tuple[dict[str, Column], Column, Column]]
    tracked: tuple[str, ...] = ()


ENTITIES = {
    "branches": Entity(
        "branches", "branch_id", ("branch_id", "branch_name", "location", "manager_name", "opened_date", "region", "branch_type", "contact_number"), branch,
        ("manager_name", "region", "branch_type"),
    ),
    "customers": Entity(
        "customers", "customer_id",
        ("customer_id", "customer_name", "email", "phone", "account_id", "gender", "dob", "address", "kyc_status", "registration_date", "transaction_id"),
        customer, ("kyc_status", "address", "email", "phone", "account_id"),
    ),
    "products": Entity(
        "products", "product_id", ("product_id", "product_name", "product_type", "price", "launch_date", "is_active", "category", "vendor_name"), product,
        ("price", "is_active", "product_type", "category"),
    ),
    "transactions": Entity(
        "transactions", "transaction_id",
        ("transaction_id", "account_id", "product_id", "branch_id", "date", "timestamp", "amount", "payment_method", "status", "currency", "remarks", "is_refund"),
        transaction,
    ),
}


def clean(rows: DataFrame, entity: Entity, batch_date: dt.date) -> DataFrame:
    """rows with the clean columns in a struct `clean`, and the codes in _rejects and _flags."""
    columns, rejects, flags = entity.cleaner(batch_date)
    # the struct is built from the raw columns at once, as several clean ones take the raw names
    return rows.select(POSITION, RAW, LOST, tx.clean_text(F.col(entity.key)).alias("_key"), F.struct(*[c.alias(n) for n, c in columns.items()]).alias("clean"), rejects.alias(REJECTS), flags.alias(FLAGS))
