"""The worksheet data source."""

import json

import pytest

from alloy.sources import sheets


def _land(root, name, creds, rows, kind="json"):
    folder = root / f"sheet_name={name}" / f"creds={creds}"
    folder.mkdir(parents=True)
    if kind == "json":
        (folder / "part-0.json").write_text("".join(json.dumps({"row_no": i, "cells": cells}) + "\n" for i, cells in enumerate(rows)))
    else:
        (folder / "part-0.csv").write_text("\n".join(",".join(c if c is not None else "" for c in cells) for cells in rows) + "\n")
    (folder / "_SUCCESS").write_text("")


def test_sheets_of_both_kinds(spark, tmp_path):
    _land(tmp_path, "a", "k1", [["title"], [], ["Tanggal", "X", "X", ""], ["1", "2", "3", "4"], ["5"], []])
    _land(tmp_path, "b", "k%2F2", [["t"], [""], ["X", "Y"], ["7", "8"]], "csv")
    df = sheets.read_sheets(spark, str(tmp_path), ["X"])
    assert df.columns == ["sheet_name", "creds", "row_no", "X", "Tanggal", "Y"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        ("a", "k1", 3, "2", "1", None), ("a", "k1", 4, None, "5", None), ("a", "k1", 5, None, None, None), ("b", "k/2", 3, "7", None, "8")], key=str)
    assert df.rdd.getNumPartitions() == 2  # one a worksheet


def test_partitions_are_listed_without_reading(tmp_path, monkeypatch):
    _land(tmp_path, "a", "k1", [["title"], [], ["X"], ["1"]])
    monkeypatch.setattr(sheets, "rows_of", None)
    assert [(w.sheet_name, w.creds) for w in sheets.SheetReader(str(tmp_path), ["X"]).partitions()] == [("a", "k1")]


def test_sheet_without_header_fails(spark, tmp_path):
    _land(tmp_path, "a", "k1", [["title"], []])
    with pytest.raises(Exception, match="no header row"):
        sheets.read_sheets(spark, str(tmp_path)).collect()
