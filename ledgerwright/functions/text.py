"""Standardisation of raw text, as column expressions that stay in the JVM."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import BOOL_TEXT

# What a valid address of electronic mail looks like.
EMAIL = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"


class Checked(NamedTuple):
    """A standardised value and whether it is valid."""

    value: Column
    valid: Column


def clean_text(c: Column) -> Column:
    """Blanks (Unicode ones too) collapsed to one space and trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_case(c: Column) -> Column:
    """Each run of letters capitalised, so after digits, hyphens and apostrophes as well."""
    runs = F.regexp_extract_all(clean_text(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def lookup(c: Column, codes: dict) -> Column:
    """A coded value by its spelling, whatever case and blanks; null if unknown."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.lower(clean_text(c)))


def parse_amount(c: Column) -> Column:
    """A decimal of two places from text that may have a rupee mark and commas; null if it isn't a number.

    Halves go to the even neighbour. Text that isn't a finite number is null.
    """
    bare = F.replace(F.regexp_replace(clean_text(c), r"(?i)^(rs\.?|inr|₹)\s*", ""), F.lit(","), F.lit(""))
    return F.bround(bare.try_cast("decimal(38,10)"), 2).try_cast("decimal(15,2)")


def parse_bool(c: Column) -> Column:
    """A Boolean, or its English word in any case; else null."""
    return lookup(c, BOOL_TEXT)




def parse_timestamp(c: Column) -> Column:
    """Year-month-day hour:minute:second, with or without leading zeros; else null."""
    text = clean_text(c)
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$")
    return F.when(shaped, F.try_to_timestamp(text, F.lit("y-M-d H:m:s")).cast("timestamp_ntz"))


def date_candidates(c: Column) -> Column:
    """Every valid reading of a date: year first, else day first and then month first."""
    text = clean_text(c)

    def reading(pattern: str, y: int, m: int, d: int) -> Column:
        part = lambda k: F.lpad(F.regexp_extract(text, pattern, k), 2, "0")
        year = F.regexp_extract(text, pattern, y)
        return F.when(text.rlike(pattern), F.concat_ws("-", year, part(m), part(d)).try_cast("date"))

    year_first = r"^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})$"
    year_last = r"^([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})$"
    return F.array_distinct(F.array_compact(F.array(reading(year_first, 1, 2, 3), reading(year_last, 3, 2, 1), reading(year_last, 3, 1, 2))))


def parse_date(c: Column) -> Column:
    """The first reading of a date."""
    return F.get(date_candidates(c), 0)


def is_ambiguous_date(c: Column) -> Column:
    return F.size(date_candidates(c)) > 1


def clean_email(c: Column) -> Checked:
    """Lower-cased, null if blank; invalid text stays."""
    text = F.lower(clean_text(c))
    return Checked(blank_to_null(text), text.rlike(EMAIL))


def clean_phone(c: Column) -> Checked:
    """+91- and ten digits if that many remain after the country code, else the text as it is."""
    text = clean_text(c)
    digits = F.regexp_replace(text, r"(?U)\D", "")
    coded = text.startswith("+91") | ((F.length(digits) == 12) & digits.startswith("91"))
    local = F.when(coded, F.substring(digits, 3, 1000)).otherwise(digits)
    valid = F.length(local) == 10
    return Checked(F.when(valid, F.concat(F.lit("+91-"), local)).otherwise(blank_to_null(text)), valid)


def clean_remarks(c: Column) -> Column:
    """Without the mark of a late correction; null if nothing remains."""
    return blank_to_null(clean_text(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("[late correction]"), F.lit(""))))


def canonical(c: Column, kind: str) -> Column:
    """A value as the text that is hashed and logged: dates and times in ISO form, money with two places."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else c.cast("string")


def row_hash(columns: list[tuple[str, str]]) -> Column:
    """SHA-256 over the columns (name, type); null and '' differ."""
    values = F.array(*[canonical(F.col(name), kind) for name, kind in columns])
    return F.sha2(F.to_json(F.struct(values.alias("v"))), 256)


def shape(c: Column) -> Column:
    """A value's form: digits as 9, letters as A, blank named."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    form = F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Za-z]", "A")
    return F.when(F.trim(text) == "", "<blank>").otherwise(form)


def rupees(c: Column) -> Column:
    """For display: a rupee sign and thousands, or a dash for null."""
    return F.coalesce(F.concat(F.lit("₹"), F.format_number(c, 0)), F.lit("–"))


def safe_cell(c: Column) -> Column:
    """A cell that no spreadsheet takes for a formula."""
    text = c.cast("string")
    return F.when(F.substring(text, 1, 1).isin("=", "+", "-", "@"), F.concat(F.lit("'"), text)).otherwise(text)
