"""Lax coercion of JSON values (seen through VARIANT) into LONG / STRING.

Everything here is a native Column expression (whole-stage codegen, no Python
per row). Helpers take the value's VARIANT type name ``t`` (from
``schema_of_variant``; NULL when the key is missing, ``VOID`` for JSON null)
and its text rendering ``s`` (``try_variant_get(v, '$', 'string')``), so each
field is extracted from the record once.

Integer acceptance rule, keyed on the VARIANT type:
  BIGINT            as is
  BOOLEAN           false -> 0, true -> 1
  DECIMAL(p,s)      when it has no fraction and fits in 64 bits
  DOUBLE            when integral and |x| < 9.2e18
  STRING            when it matches INT_TEXT; edge spaces, underscores and a
                    ``.0`` tail are dropped, then it must fit in 64 bits
  anything else     rejected (arrays, objects, fractions, '5.', '5e0', '')
A plain ``try_variant_get(v, '$', 'bigint')`` is not enough: it truncates 5.5
to 5 and accepts booleans silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms of integers, years and integral decimals.
INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*(\.0+)?\s*$"
YEAR_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
INTEGRAL_DECIMAL = r"^-?[0-9]+(\.0*)?$"


def text_to_long(s: Column, pattern: str = INT_TEXT) -> Column:
    """Integer text -> LONG; NULL when the text is not an accepted integer form."""
    return F.when(s.rlike(pattern), F.regexp_replace(s, r"[\s_]|\.0+\s*$", "").try_cast("bigint"))


def lax_long(t: Column, s: Column, i: Column | None = None) -> tuple[Column, Column]:
    """(LONG value, reason) for a present, non-null value of type ``t`` and text ``s``.

    ``i`` is the value read directly as BIGINT: the common, well-typed case
    then needs no text at all. Otherwise one normalised text per value and a
    single ``try_cast`` (which rejects fractions and values beyond 64 bits);
    doubles are checked numerically because their text may be in exponent form.
    """
    normal = (
        F.when(t == "BOOLEAN", F.when(s == "true", F.lit("1")).otherwise(F.lit("0")))
        .when(t == "STRING", F.when(s.rlike(INT_TEXT), F.regexp_replace(s, r"[\s_]|\.0+\s*$", "")))
        .when((t == "BIGINT") | t.startswith("DECIMAL"), F.regexp_replace(s, r"\.0*$", ""))
    )
    dbl = s.try_cast("double")
    value = F.when(t == "DOUBLE", F.when((dbl == F.floor(dbl)) & (dbl >= F.lit(-(2.0**63))) & (dbl < F.lit(2.0**63)),
                                         dbl.cast("bigint"))).otherwise(normal.try_cast("bigint"))
    if i is not None:
        value = F.when(t == "BIGINT", i).otherwise(value)
    return value, F.when(value.isNull(), F.lit("type"))


def lax_string(t: Column, s: Column) -> tuple[Column, Column]:
    """Only JSON strings are strings (numbers and booleans are rejected)."""
    ok = t == "STRING"
    return F.when(ok, s), F.when(~ok, F.lit("type"))


def year_of(text: Column) -> tuple[Column, Column]:
    """First four characters as an integer year; ``bad_year`` when they are not one."""
    head = F.substring(text, 1, 4)
    value = text_to_long(head, YEAR_TEXT)
    return value, F.when(value.isNull(), F.lit("bad_year"))


def parent_reason(t: Column) -> Column:
    """Reason a parent object on a path cannot be subscripted (NULL when it can)."""
    return (
        F.when(t.isNull(), F.lit("missing"))
        .when(t == "VOID", F.lit("null_parent"))
        .when(~t.startswith("OBJECT"), F.lit("type"))
    )


def int_div(x: Column, n: Column | int) -> Column:
    """Integer division toward zero on LONGs (exact, unlike ``floor(x / n)``, which goes through DOUBLE)."""
    n = n if isinstance(n, Column) else F.lit(n).cast("bigint")
    return F.call_function("div", x.cast("bigint"), n)
