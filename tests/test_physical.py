"""The physical plans are the intended ones: few scans and shuffles, filters in the reader."""

import re

import pytest

from daygrain.queries import queries
from daygrain.operators import date_range, join_on

QUERIES = queries()


def planned(df):
    """The plan as first made, before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    """The plan that ran, without the initial one."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def count(plan, node):
    return len(re.findall(rf"[+:*]-? *(?:\*\(\d+\) )?{node}\b", plan))


@pytest.fixture(autouse=True)
def full_text(spark):
    """Plans name all pushed filters and columns."""
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "5000")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def no_broadcast(spark):
    """As if no side were small enough."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = planned(QUERIES[name](spark, sf_dir))
    for node in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_join_of_day_tables_needs_no_further_shuffle(spark, sf_dir, no_broadcast):
    plan = planned(QUERIES["condition_impact"](spark, sf_dir))
    assert count(plan, "FileScan parquet") == 2
    # one per fact table and one for the result
    assert count(plan, "Exchange") == 3
    assert count(plan, "SortMergeJoin") == 1


def test_four_day_tables_are_joined_in_place(spark, sf_dir, no_broadcast):
    plan = planned(QUERIES["daily_feature_join"](spark, sf_dir))
    assert count(plan, "SortMergeJoin") == 3 and count(plan, "Exchange") == 4


def test_counts_and_sums_read_the_table_once(spark, sf_dir):
    one = planned(QUERIES["daily_counts_and_sums"](spark, sf_dir))
    two = planned(QUERIES["daily_counts_join_sums"](spark, sf_dir))
    assert (count(one, "FileScan parquet"), count(two, "FileScan parquet")) == (1, 2)


@pytest.mark.parametrize("name", ["corr_long", "flag_mean_stddev"])
def test_many_pairs_or_flags_are_one_pass(name, spark, sf_dir, no_broadcast):
    plan = planned(QUERIES[name](spark, sf_dir))
    assert count(plan, "FileScan parquet") == 2 and count(plan, "Exchange") == 3


def test_top_k_with_others_shuffles_the_counts_once(spark, sf_dir):
    plan = final(QUERIES["topk_with_others"](spark, sf_dir))
    assert count(plan, "FileScan parquet") == 1
    assert "ReusedExchange" in plan and "Join" not in plan


def test_wide_counts_need_one_shuffle(spark, sf_dir):
    plan = planned(QUERIES["daily_by_group_wide"](spark, sf_dir))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1


def test_code_grid_needs_no_join(spark, sf_dir):
    plan = planned(QUERIES["code_day_grid"](spark, sf_dir))
    assert "Join" not in plan and count(plan, "Exchange") == 1


def test_times_are_parsed_after_they_are_counted(spark, sf_dir):
    plan = planned(QUERIES["counts_by_hour"](spark, sf_dir))
    assert "gettimestamp" in plan
    assert "gettimestamp" not in plan.split("Exchange hashpartitioning")[-1]


def test_reductions_combine_before_the_shuffle(spark, sf_dir):
    for name in ("daily_counts_and_sums", "value_counts", "total_by_season", "top_days"):
        below = planned(QUERIES[name](spark, sf_dir)).split("Exchange hashpartitioning")[1]
        assert "partial_" in below


def test_series_filters_reach_the_reader(spark, sf_dir):
    for name in ("station_series_day", "station_series_week", "station_series_month"):
        plan = planned(QUERIES[name](spark, sf_dir))
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
        assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
        assert "EqualTo(event_type,view)" in pushed


def test_date_ranges_reach_the_reader_for_date_columns_too(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.sql("SELECT DATE'2022-01-01' AS d, 1 AS v").write.parquet(path)
    plan = planned(date_range(spark.read.parquet(path), "d", "2022-01-01", "2022-01-31"))
    assert "GreaterThanOrEqual(d,2022-01-01), LessThan(d,2022-02-01)" in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    def columns(name):
        schemas = re.findall(r"ReadSchema: struct<(.*?)>", planned(QUERIES[name](spark, sf_dir)))
        return [{c.split(":")[0] for c in s.split(",")} for s in schemas]

    assert columns("top_days") == [{"l_shipdate"}]
    assert columns("total_by_weekday") == [{"l_shipdate"}]
    assert columns("party_counts") == [
        {"l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice"}
    ]
    assert columns("value_counts") == [{"event_type"}]


def test_top_days_sorts_no_more_than_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=20" in planned(QUERIES["top_days"](spark, sf_dir))


def test_join_on_three_frames_uses_the_shared_key(spark, no_broadcast):
    frames = [
        spark.range(100).selectExpr("id % 10 AS date", f"id AS v{i}").groupBy("date").count()
        .withColumnRenamed("count", f"n{i}")
        for i in range(3)
    ]
    assert count(planned(join_on(frames)), "Exchange") == 3
