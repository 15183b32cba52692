"""Row hashes: SHA-256 hex of ``||``-joined canonical text, computed JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from alloy.constants import HASH_SEP
from alloy.functions.numbers import canonical_number_text
from alloy.functions.text import canon


def raw_row_hash(df: DataFrame, cols: list[str]) -> Column:
    """Positional hash of raw bronze values: NULL -> '', strip, upper, join.

    Numbers are hashed by their canonical text (``12``, ``1.5``) so the hash of
    a count does not depend on the type the column happened to get.
    """
    parts = []
    types = dict(df.dtypes)
    for c in cols:
        if c not in types:
            parts.append(F.lit(""))
        elif types[c].startswith(("decimal", "double", "float", "int", "bigint", "smallint", "tinyint")):
            parts.append(F.coalesce(canonical_number_text(F.col(c)), F.lit("")))
        else:
            parts.append(canon(c))
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def clean_row_hash(parts: list[Column]) -> Column:
    """Hash of typed silver values: NULL parts are skipped (ARRAY_TO_STRING)."""
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def hash_text(col: Column, kind: str) -> Column:
    """Canonical text of a typed value for ``clean_row_hash``.

    ``date`` -> yyyy-MM-dd; ``timestamp`` -> yyyy-MM-dd HH:mm:ss; ``double`` ->
    text of a decimal (engines print doubles differently): 12 places below 1000,
    2 places from there, ``huge`` beyond any decimal; others -> cast.
    """
    if kind == "date":
        return F.date_format(col, "yyyy-MM-dd")
    if kind == "timestamp":
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if kind == "double":
        fine, coarse = (col.try_cast(t).cast("string") for t in ("decimal(38,12)", "decimal(38,2)"))
        return F.when(F.abs(col) < 1000, fine).when(col.isNotNull(), F.coalesce(coarse, F.lit("huge")))
    return col.cast("string")
