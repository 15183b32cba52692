"""Locale-number and percentage expressions.

Cells arrive as text such as ``Rp1.234,56``: ``.`` groups thousands and ``,``
is the decimal mark. Parsing is a chain of native expressions ending in a
``try_cast`` so dirty cells become NULL instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from alloy.constants import NUMERIC_ALLOWED, PERCENT_ALLOWED, WHITESPACE, WS_CLASS
from alloy.functions.text import _c, has_content, ustrip  # noqa: F401

MONEY = "decimal(38,9)"
NUMERIC_CORRUPT_RE = f"(?s)[^{NUMERIC_ALLOWED}{WS_CLASS}]|^[^0-9]*$|,.*,"


# The usual good cell, in ASCII: tried first, since most cells are one and the
# whole classes (all of Unicode's white space) are several times slower.
_FINE_NUMBER = r"\A(?=[^0-9]*+[0-9])[0-9.Rp# -]*+(?:,[0-9.Rp# -]*+)?\z"
_FINE_PERCENT = r"\A[0-9.,%# -]*+\z"


def locale_number_text(col: Column | str) -> Column:
    """Keep digits , . ; delete '.' (thousands); turn ',' into '.'.

    ``Rp1.234,56`` -> ``1234.56``; ``1.5`` -> ``15``; ``-5`` -> ``5`` (the sign
    is not kept); ``1,2,3`` -> ``1.2.3`` (not a number).
    """
    kept = F.regexp_replace(_c(col), r"[^0-9,.]", "")
    # translate works per character: each ',' becomes '.', each original '.' goes.
    return F.translate(kept, ",.", ".")


def locale_number(col: Column | str, dtype: str = MONEY) -> Column:
    """Parse a locale-formatted number; NULL when it is not a number."""
    return locale_number_text(col).try_cast(dtype)


def locale_number_fill(col: Column | str, fill: int = 0, dtype: str = MONEY) -> Column:
    """Cleaned value with missing / unparsable cells replaced by ``fill``."""
    return F.coalesce(locale_number_text(col).try_cast(dtype), F.lit(fill).cast(dtype))


def checked_number_fill(col: Column | str, fill: int = 0, dtype: str = MONEY) -> Column:
    """``locale_number_fill`` of a cell that is not corrupt: it has no other characters
    than a number's, or no content, so one pass of ``translate`` cleans it."""
    return F.coalesce(F.translate(_c(col), ",.Rp#-" + WHITESPACE, ".").try_cast(dtype), F.lit(fill).cast(dtype))


def numeric_corrupt(col: Column | str) -> Column:
    """A numeric cell holds content and either has a forbidden character or
    does not coerce to a number after cleaning (``######`` strips to nothing)."""
    c = _c(col)
    # Cleaning keeps digits and separators, deletes '.', turns ',' into '.';
    # that text is a number exactly when the cell has a digit and at most one
    # ','. So "forbidden character, or no digit, or two commas" is one regex.
    return c.isNotNull() & ~c.rlike(_FINE_NUMBER) & c.rlike(NUMERIC_CORRUPT_RE) & has_content(c)


def percent_corrupt(col: Column | str) -> Column:
    """A percentage cell holds content and a character outside digits . , % # - and whitespace."""
    c = _c(col)
    return c.isNotNull() & ~c.rlike(_FINE_PERCENT) & c.rlike(f"[^{PERCENT_ALLOWED}{WS_CLASS}]") & has_content(c)


# A plain decimal literal, optionally signed; what a FLOAT64 cast accepts from
# the characters a valid percentage cell can hold.
_FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def percent_ratio(col: Column | str, decimal_comma: bool = False) -> Column:
    """Percentage text -> ratio (``12.5%`` -> 0.125).

    Default is the literal warehouse rule: remove ``%``, backslash and the
    letter ``s`` (the source's ``[%\\\\s]`` class), cast to double, divide by
    100; ``12,5%`` therefore becomes NULL. ``decimal_comma=True`` reads the
    comma as a decimal mark instead.
    """
    txt = F.regexp_replace(_c(col), r"[%\\s]", "")
    if decimal_comma:
        txt = F.translate(ustrip(txt), ",", ".")
    return F.when(txt.rlike(_FLOAT_TEXT), txt.try_cast("double") / F.lit(100.0))


def round_to_long(col: Column | str) -> Column:
    """SAFE_CAST(x AS INT64) for a fractional number: round half away from zero,
    NULL on overflow (a plain cast would truncate 2.7 to 2)."""
    return F.round(_c(col), 0).try_cast("bigint")


def is_integral(col: Column | str) -> Column:
    """x % 1 == 0 (NULL stays NULL)."""
    return (_c(col) % F.lit(1)) == F.lit(0)


def canonical_number_text(col: Column | str) -> Column:
    """Plain text of a number without trailing fractional zeros: 12 -> '12', 1.5 -> '1.5'.

    Used where the source hashed a value whose text depended on whether the
    whole column happened to be integral; a fixed canonical form replaces it.
    """
    s = _c(col).cast(MONEY).cast("string")
    return F.when(s.contains("."), F.rtrim(F.rtrim(s, F.lit("0")), F.lit("."))).otherwise(s)
