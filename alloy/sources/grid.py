"""Landed raw grids -> raw frame (every cell text, tagged with its source).

A landed worksheet is stored as rows ``(sheet_name, creds, row_no, cells)``:
the header sits on grid row 2 and data starts on row 3. The headers are a small
table of their own, one row per sheet, from the same landing or from an earlier
one; each data row finds its sheet's column positions by a join with it, a
broadcast join behind the size check. Only the distinct column names come to the
driver: they are the schema of the result.

Semantics kept from the source system:
* a repeated header name keeps its first column;
* a column with an empty header is not loaded;
* sheets are unioned by name, a column absent from a sheet is NULL;
* ``sheet_name`` / ``creds`` tag every row; ``row_no`` is kept for ordering.

A data row whose sheet has no header, or a sheet with two different headers in
one landing, fails the job when its cells are read; ``split_headerless`` sets
such rows aside before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from alloy.constants import FIRST_DATA_ROW, HEADER_ROW
from alloy.operators.common import measured, small

GRID_SCHEMA = "sheet_name string, creds string, row_no bigint, cells array<string>"
HEADER_SCHEMA = "sheet_name string, header array<string>, n_headers bigint"


def read_grid(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a landed grid table (Parquet or JSON lines) with a fixed schema."""
    reader = spark.read.schema(GRID_SCHEMA)
    return reader.parquet(path) if fmt == "parquet" else reader.format(fmt).load(path)


def headers_of(grid: DataFrame) -> DataFrame:
    """``(sheet_name, header, n_headers)``: the header cells of every sheet and how
    many different header rows it has."""
    rows = grid.filter(F.col("row_no") == HEADER_ROW).select(
        "sheet_name", F.transform(F.coalesce("cells", F.array().cast("array<string>")),
                                  lambda c: F.coalesce(c, F.lit(""))).alias("header"))
    return rows.distinct().groupBy("sheet_name").agg(F.min("header").alias("header"), F.count(F.lit(1)).alias("n_headers"))


def known_headers(earlier: DataFrame, grid: DataFrame) -> DataFrame:
    """The headers of a landing, and ``earlier`` ones of sheets that it does not bring again."""
    here = headers_of(grid)
    return here.unionByName(earlier.join(small(here.select("sheet_name")), "sheet_name", "left_anti"))


def split_headerless(grid: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose sheet has a header, data rows whose sheet has none)."""
    names = small(measured(headers.select("sheet_name").distinct(), "header-sheets"))
    data = grid.filter(F.col("row_no") >= FIRST_DATA_ROW)
    return grid.join(names, "sheet_name", "left_semi"), data.join(names, "sheet_name", "left_anti")


def column_names(headers: DataFrame, column_order: list[str] | None = None) -> list[str]:
    """The distinct header names: those of ``column_order`` first, in its order,
    then the others by the first sheet and position that has them."""
    cells = headers.select("sheet_name", F.posexplode("header").alias("position", "name")).filter("name <> ''")
    seen = cells.groupBy("name").agg(F.min(F.struct("sheet_name", "position")).alias("at")).orderBy("at").select("name").collect()
    names = [r["name"] for r in seen]  # one row per column of the result
    wanted = [c for c in column_order or [] if c in names]
    return wanted + [c for c in names if c not in wanted]


def grid_to_frame(grid: DataFrame, headers: DataFrame | None = None,
                  column_order: list[str] | None = None) -> DataFrame:
    """Promote headers and project every data row to named text columns."""
    headers = measured(headers_of(grid) if headers is None else headers, "headers")
    names = column_names(headers, column_order)
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    # Where each name stands first in the sheet's header; NULL where it does not.
    found = F.transform(wanted, lambda n: F.nullif(F.array_position("header", n), F.lit(0).cast("long")))
    places = headers.select("sheet_name", F.when(F.col("n_headers") > 1, F.raise_error(F.concat(
        F.lit("two different header rows in sheet "), "sheet_name"))).otherwise(found).alias("_pos"))
    data = grid.filter(F.col("row_no") >= FIRST_DATA_ROW).join(small(places), "sheet_name", "left")
    pos = F.coalesce("_pos", F.raise_error(F.concat(F.lit("no header row for sheet "), F.coalesce("sheet_name", F.lit("NULL")))))
    data = data.withColumn("_pos", pos.cast("array<bigint>"))
    cells = [F.get(F.col("cells"), (F.get(F.col("_pos"), i) - 1).cast("int")).alias(n) for i, n in enumerate(names)]
    return data.select("sheet_name", "creds", "row_no", *cells)
