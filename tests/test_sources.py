import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daygrain.session import scratch_folder
from daygrain.sources import (
    conform,
    read_correlations,
    read_csv,
    read_csv_text,
    read_table,
    write_table,
    write_to_all,
    written,
)

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def data_files(path, suffix):
    return sorted(p for p in Path(path).rglob(f"*{suffix}") if not p.name.startswith("_"))


@pytest.fixture
def days(spark):
    data = [(D(2022, 1, d), d * 10, d / 4) for d in (3, 1, 2, 5, 4)]
    return spark.createDataFrame(data, "date date, n int, v double").repartition(3)


def test_single_csv_file_is_sorted_and_has_a_header(spark, days, tmp_path):
    path = write_table(days, str(tmp_path / "t"), "csv", order_by=["date"], single_file=True)
    (file,) = data_files(path, ".csv")
    lines = file.read_text().splitlines()
    assert lines[0] == "date,n,v" and [x[:10] for x in lines[1:]] == [f"2022-01-0{d}" for d in range(1, 6)]
    assert rows(read_csv(spark, path, days.schema)) == rows(days)


def test_parallel_files_are_all_read_back(spark, days, tmp_path):
    path = write_table(days, str(tmp_path / "t"), "csv")
    assert len(data_files(path, ".csv")) > 1
    assert rows(read_csv(spark, path, days.schema)) == rows(days)


def test_modes(spark, days, tmp_path):
    path = write_table(days, str(tmp_path / "t"), "csv")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_table(days, path, "csv")
    write_table(days.filter("n = 10"), path, "csv", mode="overwrite")
    assert read_csv(spark, path, days.schema).count() == 1


def test_write_to_all_gives_equal_targets(spark, days, tmp_path):
    targets = [str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "c")]
    assert write_to_all(days, targets) == targets
    for t in targets:
        assert rows(read_csv(spark, t, days.schema)) == rows(days)


def test_inferred_types_and_text(spark, days, tmp_path):
    path = write_table(days, str(tmp_path / "t"), "csv")
    assert dict(read_csv(spark, path).dtypes) == {"date": "date", "n": "int", "v": "double"}
    assert {t for _, t in read_csv_text(spark, path).dtypes} == {"string"}


def test_reader_types_dates_and_nulls_what_does_not_fit(spark, tmp_path):
    file = tmp_path / "d.csv"
    file.write_text("day,n\n01/31/2022,1\n2022-02-01,x\n")
    got = read_csv(spark, str(file), "day date, n int", date_pattern="MM/dd/yyyy").collect()
    assert [tuple(r) for r in got] == [(D(2022, 1, 31), 1), (None, None)]


def test_written_rows_do_not_depend_on_their_source(spark, tmp_path):
    path = write_table(spark.range(10), str(tmp_path / "source"))
    copy = written(read_table(spark, path), "copy")
    write_table(spark.range(3), path, mode="overwrite")
    assert copy.count() == 10


def test_conform_matches_names_in_any_case_and_order(spark, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text("extra,N,CRASH DATE\nz,5,2022-01-02\nz,bad,never\n")
    typed = conform(
        read_csv_text(spark, str(file)),
        {"Crash Date": "day", "n": "n", "gone": "gone"},
        types={"n": "int"},
        date_patterns={"day": "yyyy-MM-dd"},
    )
    assert typed.dtypes == [("day", "date"), ("n", "int"), ("gone", "string")]
    assert rows(typed) == rows(spark.createDataFrame([(D(2022, 1, 2), 5, None), (None, None, None)], typed.schema))


def test_correlation_lines(spark, tmp_path):
    file = tmp_path / "r.txt"
    file.write_text("min t | crash | 0.5\nSunrise | metro-north | -0.25\n")
    assert rows(read_correlations(spark, str(file))) == [("Sunrise", "metro-north", -0.25), ("min t", "crash", 0.5)]


def test_partitioned_table_has_few_files_and_prunes(spark, tmp_path):
    df = spark.range(0, 2000, 1, 8).select("id", (F.col("id") % 4).cast("int").alias("part"))
    path = write_table(df, str(tmp_path / "p"), partition_by=["part"], order_by=["id"])
    assert len(data_files(path, ".parquet")) == 4
    kept = read_table(spark, path).filter("part = 3")
    assert kept.count() == 500
    assert "PartitionFilters: [isnotnull(part" in kept._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_is_never_local_to_a_machine_on_a_cluster():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, master):
            self.conf = Conf({"spark.master": master})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session("yarn"), "x")
    local = Session("local[2]")
    assert scratch_folder(local, "x") != scratch_folder(local, "x")
    assert list(local.conf) == ["spark.master"]  # the caller's settings stay as they are


def test_scratch_folder_lies_in_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)
