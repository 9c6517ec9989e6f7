"""Text expressions: date slices, labels, digit checks.

All are built-in Column expressions; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions import coerce

# Fixed value: separator of "code — name" picker labels.
LABEL_SEP = " — "


def year4(text: Column, strict: bool = True) -> Column:
    """First four characters as an integer year (P5), by the rule the flatten uses.

    ``strict`` raises on text that is not a year, whatever the session's ANSI
    setting; otherwise it gives NULL (quarantine mode). NULL text stays NULL.
    """
    year, reason = coerce.year_of(text)
    if not strict:
        return year
    bad = text.isNotNull() & reason.isNotNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a year: "), text)).cast("bigint")).otherwise(year)


def date10(text: Column) -> Column:
    """First ten characters (P6); shorter text comes back whole, like a slice."""
    return F.substring(text, 1, 10)


def label(code: Column, name: Column, *more: Column) -> Column:
    """``code — name`` picker label."""
    return F.concat_ws(LABEL_SEP, code, name, *more)


def label_code(lbl: Column) -> Column:
    return F.split(lbl, LABEL_SEP).getItem(0)


def label_name(lbl: Column) -> Column:
    """Second part only: a name that itself contains the separator loses its tail."""
    return F.split(lbl, LABEL_SEP).getItem(1)


def is_digits(s: Column) -> Column:
    """ASCII digits only, non-empty (F7). NULL input stays NULL."""
    return s.rlike("^[0-9]+$")
