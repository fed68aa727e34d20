"""Ledger of unreadable fields, files whose headers differ, and the raw data sets read with both."""

import gzip

import pytest
from pyspark.sql import functions as F

from daygrain.sources import (
    COLLISIONS,
    RIDERSHIP,
    WEATHER,
    check_raw,
    conform,
    conform_checked,
    input_files,
    ledger_counts,
    read_collisions,
    read_csv_by_header,
)

NAMES = {"Day": "day", "Amount": "amount", "At": "at", "Note": "note", "Lost": "lost"}
TYPES = dict(types={"amount": "int"}, date_patterns={"day": "MM/dd/yyyy"}, timestamp_patterns={"at": "yyyy-MM-dd HH:mm"})
GOOD = 'Day,Amount,At,Note\n01/31/2022,5,2022-01-31 10:00,"a, b"\n02/30/2022,x,2022-01-31 25:00,\n,,,\n'
SHORT = "Day,Amount,At,Note\n01/01/2022,7\n01/02/2022,8,2022-01-02 00:00,fine\n1,2,3,4,5,6\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(folder, **texts):
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_every_given_field_is_typed_or_in_the_ledger(spark, tmp_path):
    path = files(tmp_path, good=GOOD, short=SHORT)
    raw = read_csv_by_header(spark, path, checked=True)
    checked = conform_checked(raw, NAMES, **TYPES)
    assert checked.rows.columns == list(NAMES.values()) and checked.rows.count() == 4
    counts = {r.column: (r.given, r.typed, r.rejected) for r in checked.counts.collect()}
    assert counts == {None: (6, 4, 2), "day": (3, 2, 1), "amount": (3, 2, 1), "at": (3, 2, 1), "note": (2, 2, 0), "lost": (0, 0, 0)}
    ledger = rows(checked.ledger.select(F.regexp_extract("file", "[^/]*$", 0), "column", "raw", "expected"))
    assert ledger == sorted([
        ("good.csv", "day", "02/30/2022", "date MM/dd/yyyy"), ("good.csv", "amount", "x", "int"),
        ("good.csv", "at", "2022-01-31 25:00", "timestamp yyyy-MM-dd HH:mm"),
        ("short.csv", None, "01/01/2022,7", "a record with the fields of its header"),
        ("short.csv", None, "1,2,3,4,5,6", "a record with the fields of its header"),
    ], key=repr)
    by_kind = ledger_counts(checked.ledger).collect()
    assert sum(r.n for r in by_kind) == 5 and {r.n for r in by_kind if r.column is None} == {2}
    for column in ("day", "amount"):  # alone, so that column pruning has its way
        assert checked.rows.select(column).filter(F.col(column).isNotNull()).count() == counts[column][1]


def test_a_checked_read_of_sound_files_equals_the_plain_one(spark, tmp_path):
    path = files(tmp_path, a="Day,Amount\n01/31/2022,5\n02/01/2022,6\n")
    checked = conform_checked(read_csv_by_header(spark, path, checked=True), NAMES, **TYPES)
    assert rows(checked.rows) == rows(conform(read_csv_by_header(spark, path), NAMES, **TYPES))
    assert checked.ledger.count() == 0


def test_columns_moved_added_and_renamed_by_case(spark, tmp_path):
    path = files(tmp_path, a="id,Name,v\n1,x,10\n2,y,20\n", b="NAME,ID\nz,3\n", c="v,extra col,id,name\n40,e,4,w\n", d="", e="id,Name,v\n")
    got = read_csv_by_header(spark, path)
    assert got.columns == ["id", "Name", "v", "extra col"]
    assert rows(got) == [("1", "x", "10", None), ("2", "y", "20", None), ("3", "z", None, None), ("4", "w", "40", "e")]
    with pytest.raises(ValueError, match="b.csv has no column 'V'"):
        read_csv_by_header(spark, path, required=["V"])
    assert read_csv_by_header(spark, path, required=["ID", "name"]).count() == 4


def test_marks_compression_and_empty_folders(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,v\n1,2\n".encode())
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("v,id\n4,3\n")
    (tmp_path / "_SUCCESS").write_text("")
    assert rows(read_csv_by_header(spark, str(tmp_path))) == [("1", "2"), ("3", "4")]
    assert input_files(spark, str(tmp_path)).filter("length > 0").count() == 2
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError, match="no file with a header"):
        read_csv_by_header(spark, str(empty))
    files(empty, twice="id,ID\n1,2\n")
    with pytest.raises(ValueError, match="names a column twice"):
        read_csv_by_header(spark, str(empty))


def test_files_of_one_header_share_a_scan(spark, tmp_path):
    path = files(tmp_path, **{f"f{i}": "id,v\n1,2\n" for i in range(5)}, other="v,id,w\n1,2,3\n")
    plan = read_csv_by_header(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_raw_data_sets_report_their_faults(spark, tmp_path):
    path = files(
        tmp_path,
        y1="CRASH DATE,CRASH TIME,BOROUGH,NUMBER OF PERSONS INJURED,COLLISION_ID\n2021-05-01,0:05,QUEENS,1,7\nMay 1,1:00,BRONX,two,8\n",
        y2="COLLISION_ID,crash date,crash time,borough\n9,2022-05-01,13:10,\n",
    )
    needed = {n: n for n in ("crash_date",)}
    how = {**COLLISIONS, "required": list(needed)}
    checked = check_raw(spark, path, how)
    assert {(r.column, r.raw) for r in checked.ledger.collect()} == {("crash_date", "May 1"), ("ppl_i", "two")}
    assert checked.rows.count() == 3
    for other in (WEATHER, RIDERSHIP):
        with pytest.raises(ValueError, match="no column"):
            check_raw(spark, path, other)
    with pytest.raises(ValueError, match="has no column"):
        read_collisions(spark, path)
