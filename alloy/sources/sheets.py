"""Landed worksheets as a Spark data source: ``spark.read.format("sheets").load(path)``.

A worksheet is a folder ``sheet_name=NAME/creds=KEY`` of JSON lines files
(``{"row_no": 5, "cells": [...]}``) or of CSV files (a line a row, the rows of a
worksheet counted through its files by name). The header stands on row 2, data begins
on row 3; the frame has ``sheet_name``, ``creds``, ``row_no`` and a text column for every
header name, as ``grid.grid_to_frame`` gives it.

Each worksheet is one partition, and partitions are listed from the folders, without
reading data; the schema takes the worksheets' header rows only. Files are opened by
Arrow's file systems, on executors too. A worksheet without a header row fails.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from alloy.constants import FIRST_DATA_ROW, HEADER_ROW

_ROWS = 4096
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Worksheet(InputPartition):
    """One worksheet: its tags and its folder."""

    def __init__(self, sheet_name: str | None, creds: str | None, folder: str):
        super().__init__(folder)
        self.sheet_name, self.creds, self.folder = sheet_name, creds, folder


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _value(folder: str) -> str | None:
    text = unquote(folder.split("=", 1)[1])
    return None if text == NULL_FOLDER else text


def worksheets(path: str) -> list[Worksheet]:
    """The worksheets under ``path``, in order of their folders; no file is opened."""
    files, root = _open(path)
    found = []
    for sheet in sorted(files.get_file_info(pafs.FileSelector(root)), key=lambda i: i.path):
        if sheet.base_name.startswith("sheet_name="):
            for source in sorted(files.get_file_info(pafs.FileSelector(sheet.path)), key=lambda i: i.path):
                if source.base_name.startswith("creds="):
                    found.append(Worksheet(_value(sheet.base_name), _value(source.base_name), source.path))
    return found


def rows_of(path: str, sheet: Worksheet) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of a worksheet, as its files give them."""
    files, _ = _open(path)
    count = 0
    for info in sorted(files.get_file_info(pafs.FileSelector(sheet.folder)), key=lambda i: i.path):
        if info.base_name.startswith(("_", ".")) or not info.is_file:
            continue
        with files.open_input_stream(info.path) as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="") as lines:
            if info.base_name.endswith((".json", ".jsonl")):
                for line in lines:
                    if line.strip():
                        row = json.loads(line)
                        yield row["row_no"], row.get("cells") or []
            else:
                for cells in csv.reader(lines):
                    yield count, cells
                    count += 1


def header_of(path: str, sheet: Worksheet) -> list[str]:
    for row_no, cells in rows_of(path, sheet):
        if row_no == HEADER_ROW:
            return [c or "" for c in cells]
    raise ValueError(f"no header row for sheet {sheet.sheet_name}")


class SheetReader(DataSourceReader):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self) -> list[Worksheet]:
        return worksheets(self.path)

    def read(self, partition: Worksheet) -> Iterator[pa.RecordBatch]:
        header = header_of(self.path, partition)
        places = [header.index(n) if n in header else None for n in self.names]  # a repeated name: its first column
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held)) or [()] * (len(self.names) + 3)
            types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * len(self.names)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["sheet_name", "creds", "row_no", *self.names])

        for row_no, cells in rows_of(self.path, partition):
            if row_no >= FIRST_DATA_ROW:
                held.append((partition.sheet_name, partition.creds, row_no, *[cells[p] if p is not None and p < len(cells) else None for p in places]))
                if len(held) >= _ROWS:
                    yield batch()
                    held.clear()
        yield batch()


class SheetSource(DataSource):
    """Options: ``path``; ``columns``, a JSON list of names that come first, in its order."""

    @classmethod
    def name(cls) -> str:
        return "sheets"

    def _names(self) -> list[str]:
        path, wanted = self.options["path"], json.loads(self.options.get("columns", "[]"))
        seen = dict.fromkeys(n for sheet in worksheets(path) for n in header_of(path, sheet) if n)
        return [n for n in wanted if n in seen] + [n for n in seen if n not in wanted]

    def schema(self) -> StructType:
        tags = [StructField("sheet_name", StringType()), StructField("creds", StringType()), StructField("row_no", LongType())]
        return StructType(tags + [StructField(n, StringType()) for n in self._names()])

    def reader(self, schema: StructType) -> SheetReader:
        return SheetReader(self.options["path"], schema.names[3:])


def read_sheets(spark: SparkSession, path: str, column_order: list[str] | None = None) -> DataFrame:
    """The raw frame of the worksheets landed under ``path``."""
    spark.dataSource.register(SheetSource)
    return spark.read.format("sheets").option("columns", json.dumps(column_order or [])).load(path)
