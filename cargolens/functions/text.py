"""Text rules, as driver-side helpers for names and as Columns for data."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

# Plain decimal notation with optional exponent; keeps "1d", "inf" and "nan",
# which a cast to DOUBLE would accept, out of the numbers.
# Possessive (the second +), as there is nothing to go back for.
NUMBER_PATTERN = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"

# Digits with a sign and a point only where they are needed, as most numbers are written; not a negative zero.
PLAIN_PATTERN = r"^(?!-0\.?0*+$)-?+(?:0|[1-9]\d*+)(?:\.\d++\z|$)"


def standard_name(name: str) -> str:
    """``Order Id`` -> ``order_id``: trim, join words by _, drop symbols, lower."""
    return re.sub(r"[^\w]", "", re.sub(r"\s+", "_", name.strip())).lower()


def standardized(c: Column) -> Column:
    """``standard_name`` on data; (?U) gives Java the Unicode meaning of \\s and \\w."""
    words = F.regexp_replace(stripped(c), r"(?U)\s+", "_")
    return F.lower(F.regexp_replace(words, r"(?U)[^\w]", ""))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_description(c: Column) -> Column:
    return stripped(F.regexp_replace(stripped(c), r"^:+", ""))


def to_float(c: Column) -> Column:
    """Text to DOUBLE, anything unreadable or missing becomes 0.0."""
    return F.coalesce(F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double")), F.lit(0.0))


def to_int(c: Column) -> Column:
    """Text to BIGINT, truncating decimals; anything unreadable becomes 0.

    The direct cast keeps ids above 2**53 exact, the second one reads "3.0". A cast that fails costs an
    exception, and a text with a point can't be read by the first.
    """
    whole = F.when(~c.contains("."), c.try_cast("bigint"))
    number = F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double").try_cast("bigint"))
    return F.coalesce(whole, number, F.lit(0).cast("bigint"))


def to_timestamp(c: Column, formats: list[str]) -> Column:
    """First format that reads the text; NULL when none does.

    A format that fails costs an exception, far more than one that reads the text. So it is only tried
    on texts that hold all of its separators.
    """
    parsed = []
    for fmt in formats:
        read = F.try_to_timestamp(c, F.lit(fmt))
        has = [c.contains(s) for s in separators(fmt)]
        parsed.append(F.when(reduce(and_, has), read) if has else read)
    return F.coalesce(*parsed).cast("timestamp_ntz")


def separators(fmt: str) -> list[str]:
    """Characters that any text of this date format holds; none for those with quotes or optional parts."""
    if re.search(r"['\[\]{}#]", fmt):
        return []
    return sorted(set(re.findall(r"[^A-Za-z]", fmt)))


def canonical_number(text: Column) -> Column:
    """One spelling for equal numbers: whole ones without sign, zeros or point in excess, others, and
    those with an exponent from 9e15 on, as DOUBLE prints them. What isn't a number stays as it is, a
    number beyond DOUBLE too. Casts come after the patterns: one that fails costs an exception.
    """
    plain = F.trim(text)
    whole = F.regexp_replace(F.regexp_replace(plain, r"\.0*$", ""), r"^\+?(-?)0+(?=\d)|^\+", "$1")
    number = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"
    value = plain.try_cast("double")
    printed = (F.when(F.abs(value) == float("inf"), text)
               .when((value == F.floor(value)) & (F.abs(value) < 9e15), value.cast("bigint").cast("string"))
               .otherwise(value.cast("string")))
    # Most texts are read here by one pattern and one cast; what they give is what the rules below give.
    # With at most 15 digits a DOUBLE is whole only if the text is; below 1e7 a whole one is printed as 7.0.
    short, double = F.octet_length(text) <= 16, text.try_cast("double").cast("string")
    quick = F.when(text.rlike(PLAIN_PATTERN), F.when(~text.contains("."), text)
                   .when(short & text.endswith(".0"), F.substring_index(text, ".", 1))
                   .when(short & ~text.endswith("00"), double)
                   .when((F.octet_length(text) <= 24) & (F.instr(text, ".") <= 8),
                         F.regexp_replace(double, r"\.0$", "")))
    return F.coalesce(quick, F.when(plain.rlike(r"^[+-]?0+(\.0*)?$"), "0")
                      .when(plain.rlike(r"^[+-]?\d+(\.0*)?$"), whole)
                      .when(plain.rlike(number), printed).otherwise(text))
