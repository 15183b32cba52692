"""String expressions (Column -> Column). All run JVM-side, inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from alloy.constants import (
    BLANK_TOKENS,
    EMPTY_TOKENS,
    SNAKE_DELETE_CHARS,
    WHITESPACE,
    WS_CLASS,
)


def _token_regex(tokens: list[str]) -> str:
    """Whole-cell match of one token (case-insensitive) between whitespace.

    Equivalent to ``lower(strip(x)) in tokens`` for ASCII tokens, as one regex
    instead of trim + lower + IN (much smaller generated code per column).
    """
    alts = "|".join(t.replace("-", "\\-") for t in tokens if t)
    return f"(?i)^[{WS_CLASS}]*({alts})?[{WS_CLASS}]*$"


BLANK_RE = _token_regex(BLANK_TOKENS)
EMPTY_RE = _token_regex(EMPTY_TOKENS)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ustrip(col: Column | str) -> Column:
    """Strip Unicode whitespace on both ends (Spark's ``trim`` only strips spaces)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def canon(col: Column | str) -> Column:
    """NULL -> '', strip, upper: the canonical text used by the raw row hash."""
    return F.upper(ustrip(F.coalesce(_c(col).cast("string"), F.lit(""))))


def upper_trim(col: Column | str) -> Column:
    """UPPER(TRIM(x)) with NULL kept NULL (silver text columns, session keys)."""
    return F.upper(ustrip(_c(col)))


def not_blank_or_null(col: Column | str) -> Column:
    """Row filter "stripped text is not empty" where a NULL cell is kept.

    The source stringifies a missing value to ``nan`` before the test, so a
    NULL never equals the empty string and the row survives.
    """
    c = _c(col)
    return c.isNull() | (ustrip(c) != F.lit(""))


def is_blank_cell(col: Column | str) -> Column:
    """NULL, or stripped lower-cased text in the blank-token set."""
    c = _c(col)
    return c.isNull() | c.rlike(BLANK_RE)


def has_content(col: Column | str) -> Column:
    """Not NULL and the stripped text (lower-cased) is not an empty token."""
    c = _c(col)
    return c.isNotNull() & ~c.rlike(EMPTY_RE)


def snake_case(name: str) -> str:
    """Column-name rename: lower, strip, space -> '_', delete ``. ( ) % / -``."""
    out = name.lower().strip().replace(" ", "_")
    for ch in SNAKE_DELETE_CHARS:
        out = out.replace(ch, "")
    return out


def snake_case_col(col: Column | str) -> Column:
    """``snake_case`` as a Column expression (for header cells held as data)."""
    c = F.regexp_replace(ustrip(F.lower(_c(col))), " ", "_")
    return F.translate(c, SNAKE_DELETE_CHARS, "")


def snake_case_columns(names: list[str]) -> dict[str, str]:
    """Map each name to its snake-case form; two names may not collide."""
    mapping: dict[str, str] = {}
    seen: dict[str, str] = {}
    for n in names:
        s = snake_case(n)
        if s in seen and seen[s] != n:
            raise ValueError(f"columns {seen[s]!r} and {n!r} both rename to {s!r}")
        seen[s] = n
        mapping[n] = s
    return mapping
