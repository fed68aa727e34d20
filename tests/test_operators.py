import datetime as dt
import hashlib
import math
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrain import operators as op
from daygrain.functions import rate
from daygrain.operators import regression

D = dt.date


def rows(df):
    return [tuple(r) for r in df.collect()]


def days(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_daily_min_max_avg_compares_numbers_and_skips_rows_without_day(spark):
    data = [(dt.datetime(2022, 1, 1, h), v) for h, v in enumerate(["9", "10", "100", "33s"])]
    df = spark.createDataFrame([*data, (None, "5")], "ts timestamp_ntz, v string")
    got = rows(op.daily_min_max_avg(df, "ts", F.col("v").try_cast("double")))
    assert got == [(D(2022, 1, 1), 9.0, 100.0, pytest.approx(119 / 3))]


def test_daily_flags_join_rows_of_a_day(spark):
    df = spark.createDataFrame(
        [(D(2022, 1, 1), "RA"), (D(2022, 1, 1), None), (D(2022, 1, 2), None), (D(2022, 1, 3), "FZRA")],
        "d date, w string",
    )
    got = rows(op.daily_flags(df, "d", "w", {"rain": "RA", "snow": "SN"}).orderBy("date"))
    assert got == [
        (D(2022, 1, 1), True, False), (D(2022, 1, 2), False, False), (D(2022, 1, 3), True, False),
    ]
    token = op.daily_flags(df, "d", "w", {"rain": "RA"}, match="token").orderBy("date")
    assert [r.rain for r in token.collect()] == [True, False, False]


def test_counts_and_sums_in_one_pass_equal_the_join(spark):
    df = spark.createDataFrame(
        [(D(2022, 1, 1), 1), (D(2022, 1, 1), None), (D(2022, 1, 2), 4), (None, 9)], "d date, v int"
    )
    one = rows(op.daily_counts_and_sums(df, "d", ["v"]).orderBy("date"))
    assert one == [(D(2022, 1, 1), 2, 1), (D(2022, 1, 2), 1, 4)]
    assert one == rows(op.counts_join_sums(df, "d", ["v"]).orderBy("date"))


def test_join_on_keeps_one_key_and_common_days(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "date int, x string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "date int, y string")
    c = spark.createDataFrame([(2, "e")], "date int, z string")
    joined = op.join_on([a, b, c])
    assert joined.columns == ["date", "x", "y", "z"] and rows(joined) == [(2, "b", "c", "e")]


def test_complete_domain_keeps_missing_values_in_order(spark):
    df = spark.createDataFrame([("b", 2)], "key string, n int")
    assert rows(op.complete_domain(df, "key", ["c", "b", "a"])) == [("c", 1, None), ("b", 2, 2), ("a", 3, None)]


def test_code_day_grid_is_complete_and_loses_no_code(spark):
    df = spark.createDataFrame(
        [
            (dt.datetime(2022, 1, 1, 5), "RA  SN"), (dt.datetime(2022, 1, 1, 6), "RA"),
            (dt.datetime(2022, 1, 2), None), (dt.datetime(2022, 1, 3), "ZZ"),
            (dt.datetime(2022, 1, 4), "RA"),
        ],
        "ts timestamp_ntz, w string",
    )
    got = set(rows(op.code_day_grid(df, "ts", "w", ["RA", "SN"], "2022-01-01", "2022-01-03")))
    a, b, c = D(2022, 1, 1), D(2022, 1, 2), D(2022, 1, 3)
    assert got == {
        ("RA", a, 1), ("SN", a, 1), ("RA", b, 0), ("SN", b, 0), ("RA", c, 0), ("SN", c, 0), ("ZZ", c, 1),
    }


def test_day_spine(spark):
    assert op.day_spine(spark, "2022-01-01", "2022-12-31").count() == 365


def test_value_counts_leaves_out_nulls_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "v string")
    assert rows(op.value_counts(df, "v")) == [("c", 2), ("a", 1), ("b", 1)]


def test_top_k_with_others_counts_every_value(spark):
    data = [("x", "y", None)] * 3 + [("x", "z", "w"), ("q", None, None)]
    df = spark.createDataFrame(data, "a string, b string, c string")
    assert rows(op.top_k_with_others(df, ["a", "b", "c"], 2)) == [("x", 4), ("y", 3), ("Others", 3)]
    # fewer values than k: the rest is there and empty
    assert rows(op.top_k_with_others(df, ["c"], 5)) == [("w", 1), ("Others", 0)]
    # a value that is called like the rest is part of it
    named = spark.createDataFrame([("Others",), ("Others",), ("a",), ("b",), ("b",)], "v string")
    assert rows(op.top_k_with_others(named, ["v"], 1)) == [("b", 2), ("Others", 3)]


def test_wide_counts_uses_null_for_none(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (None, "a")], "k int, v string")
    got = rows(op.wide_counts(df, "k", "k", "v", ["a", "b"], others=None).orderBy("k"))
    assert rows(op.wide_counts(df, "k", "k", "v", ["b"]).orderBy("k")) == [(1, None, 2), (2, 1, None)]
    with pytest.raises(ValueError, match="Others"):
        op.wide_counts(df, "k", "k", "v", ["Others"])
    assert got == [(1, 2, None), (2, None, 1)]
    whole = rows(op.wide_counts(df, "k", "k", "v", ["a"], others="rest").orderBy("k"))
    assert whole == [(1, 2, None), (2, None, 1)]


def test_count_flags_and_rows_without_any(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (0, 0), (None, None)], "a int, b int")
    got = dict(rows(op.count_flags(df, {"A": [F.col("a") > 0], "B": [F.col("b") > 0]}, "none")))
    assert got == {"A": 2, "B": 1, "none": 2}


def test_impact_by_condition(spark):
    df = spark.createDataFrame(
        [(True, False, 10, 1), (True, True, 5, 2), (False, True, None, 4)],
        "rain boolean, snow boolean, crash int, hurt int",
    )
    got = op.impact_by_condition(
        df, ["rain", "snow"], "crash", {"crash": "total", "hurt": "hurt_total"}, {"per_day": ("total", 0)}
    )
    assert {tuple(r) for r in got.collect()} == {
        ("rain", True, 2, 15, 3, 8.0), ("rain", False, 0, None, 4, None),
        ("snow", True, 1, 5, 6, 5.0), ("snow", False, 1, 10, 1, 10.0),
    }


def test_mean_std_by_flag(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 3.0), (False, 5.0), (False, None)], "f boolean, m double")
    got = {(r.condition, r.value): (r["mean"], r.stddev) for r in op.mean_std_by_flag(df, ["f"], ["m"]).collect()}
    assert got == {("f", True): (2.0, pytest.approx(math.sqrt(2))), ("f", False): (5.0, None)}
    assert rows(op.mean_std(df, ["m"])) == [("m", 3.0, 2.0)]


def test_calendar_counts(spark):
    df = spark.createDataFrame([(D(2022, 1, 3),), (D(2022, 1, 3),), (D(2022, 7, 3),), (None,)], "d date")
    assert rows(op.by_weekday(df, "d"))[0] == ("Monday", 1, 2)
    assert rows(op.by_weekday(df, "d"))[1] == ("Tuesday", 2, None)
    assert rows(op.by_season(df, "d")) == [("Winter", 1, 2), ("Spring", 2, None), ("Summer", 3, 1), ("Autumn", 4, None)]
    more = df.unionByName(spark.createDataFrame([(D(2022, 1, 4),)], "d date"))
    assert rows(op.mean_daily_by_month(more, "d")) == [(1, 1.5), (7, 1.0)]


def test_counts_by_hour_skips_bad_times(spark):
    df = spark.createDataFrame([("0:05",), ("0:59",), ("23:59",), ("25:00",), (None,)], "t string")
    assert rows(op.counts_by_hour(df, "t")) == [(0, 2), (23, 1)]


def test_monthly_means_skip_empty_values(spark):
    df = spark.createDataFrame(
        [(D(2022, 1, 1), 2), (D(2022, 1, 9), 4), (D(2022, 1, 10), None), (D(2022, 2, 1), 10)], "d date, v int"
    )
    monthly = op.monthly_means(df, "d", ["v"])
    assert sorted(rows(monthly)) == [("2022-01", 3.0), ("2022-02", 10.0)]
    assert rows(op.mean_of_groups(monthly, ["v"], "name", "mean")) == [("v", 6.5)]


def test_token_vocabulary(spark):
    df = spark.createDataFrame([("RA  SN",), ("RA",), (None,), ("",)], "w string")
    assert sorted(r[0] for r in op.token_vocabulary(df, "w").collect()) == ["RA", "SN"]


def test_series_are_sorted_and_selected(spark):
    df = spark.createDataFrame(
        [
            ("a", dt.datetime(2022, 1, 3, 1), 1.0), ("b", dt.datetime(2022, 1, 3, 0), 2.0),
            ("a", dt.datetime(2022, 1, 9, 23), 3.0), ("a", dt.datetime(2022, 1, 10), 4.0),
            ("a", dt.datetime(2021, 1, 5), 5.0),
        ],
        "station string, ts timestamp_ntz, m double",
    )
    assert [r.m for r in op.station_series(df, "2022-01-03", "2022-01-03", ["m"], ordered=True).collect()] == [2.0, 1.0]
    assert [r.m for r in op.week_series(df, "2022-01-05", ["m"], ordered=True).collect()] == [2.0, 1.0, 3.0]
    assert [r.m for r in op.month_series(df, 1, ["m"], stations=["a"], ordered=True).collect()] == [5.0, 1.0, 3.0, 4.0]
    assert [r.m for r in op.month_series(df, 1, ["m"], year=2022, stations=["b"]).collect()] == [2.0]
    assert rows(op.measure_bounds(df, "m")) == [(1.0, 5.0)]


def test_labelled_parts_equal_the_split(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "kind string, v int")
    parts = op.split_by_value(df, "kind", {"first": ("a", ["v"]), "second": ("b", ["v"])})
    assert {k: rows(v) for k, v in parts.items()} == {"first": [(1,)], "second": [(2,)]}
    labelled = op.labelled_parts(df, "kind", {"a": "first", "b": "second"}, "part")
    assert rows(labelled.select("part", "v").orderBy("v")) == [("first", 1), ("second", 2)]


def test_a_crowded_key_changes_no_result(spark):
    """A third of all rows on one day, with one value: counts, sums and top-k stay whole."""
    n = 60000
    crowded = F.col("id") % 3 == 0
    df = spark.range(0, n, 1, 16).select(
        F.when(crowded, F.lit("2022-06-01").cast("date"))
        .otherwise(F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 365).cast("int")))
        .alias("d"),
        F.when(crowded, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 5000)).alias("v"),
    )
    daily = op.daily_counts_and_sums(df, "d", [])
    assert daily.agg(F.sum("n")).first()[0] == n and daily.count() == 365
    top = rows(op.top_k_with_others(df, ["v"], 3))
    assert top[0] == ("hot", n // 3) and sum(r[1] for r in top) == n
    assert sum(r[2] for r in rows(op.by_weekday(df, "d"))) == n


def test_labels(spark):
    df = spark.createDataFrame([(1, 2, 3)], "min_t int, metro_north int, crash int")
    assert op.with_labels(df).columns == ["min t", "metro-north", "crash"]


# --- correlation -----------------------------------------------------------------


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=(n, 4)) * [3, 5, 1000, 40] + [10, 20, 50000, 7]
    y = x @ np.array([0.5, -0.25, 0.001, 0.0]) + 4 + rng.normal(size=n)
    start = D(2022, 1, 1)
    return [start + dt.timedelta(days=i) for i in range(n)], x, y


def test_corr_long_against_numpy_with_missing_and_constant(spark, sample):
    day, x, y = sample
    data = [
        (float(a[0]), None if i % 7 == 0 else float(a[1]), 3.0, None if i % 5 == 0 else float(b))
        for i, (a, b) in enumerate(zip(x, y))
    ]
    df = spark.createDataFrame(data, "a double, b double, c double, y double")
    got = {r.x: r.r for r in op.corr_long(df, ["a", "b", "c"], ["y"]).collect()}
    keep_a = [i for i in range(len(y)) if i % 5]
    keep_b = [i for i in keep_a if i % 7]
    assert got["a"] == pytest.approx(np.corrcoef(x[keep_a, 0], y[keep_a])[0, 1])
    assert got["b"] == pytest.approx(np.corrcoef(x[keep_b, 1], y[keep_b])[0, 1])
    assert got["c"] is None
    zero = {r.x: r.r for r in op.corr_long(df, ["b"], ["y"], nulls="zero").collect()}
    filled = np.array([[r[1] or 0.0, r[3] or 0.0] for r in data])
    assert zero["b"] == pytest.approx(np.corrcoef(filled.T)[0, 1])
    with pytest.raises(ValueError):
        op.corr_long(df, ["a"], ["y"], nulls="keep")


def test_corr_matrix_fills_missing_cells_with_zero(spark):
    corr = spark.createDataFrame([("b", "p", 0.5), ("a", "q", -0.25)], "x string, y string, r double")
    wide = op.corr_matrix(corr, ["q", "p"])
    assert wide.columns == ["x", "p", "q"] and rows(wide) == [("a", 0.0, -0.25), ("b", 0.5, 0.0)]


# --- least squares -----------------------------------------------------------------


def _table(spark, sample):
    day, x, y = sample
    data = [(d, *map(float, a), float(b), float(b) * 2 + 1) for d, a, b in zip(day, x, y)]
    return spark.createDataFrame(data, "date date, a double, b double, c double, d double, y double, z double")


def test_ols_report_against_numpy(spark, sample):
    df = _table(spark, sample)
    day, x, y = sample
    report = {(r.label, r.term): r for r in op.ols_report(df, list("abcd"), ["y", "z"]).collect()}
    assert len(report) == 10
    train = np.array([int(hashlib.md5(f"{d}|0".encode()).hexdigest()[:8], 16) % 10 < 7 for d in day])
    design = np.column_stack([x, np.ones(len(y))])
    for label, target in (("y", y), ("z", y * 2 + 1)):
        a, b = design[train], target[train]
        coef, *_ = np.linalg.lstsq(a, b, rcond=None)
        rest = b - a @ coef
        ours = np.array([report[label, term].coef for term in [*"abcd", "intercept"]])
        left = b - a @ ours
        assert (abs(a.T @ left) / (abs(a).T @ abs(left))).max() < 1e-8
        sigma2 = rest @ rest / (len(b) - 5)
        t = coef / np.sqrt(sigma2 * np.diag(np.linalg.inv(a.T @ a)))
        r2 = 1 - rest @ rest / ((b - b.mean()) ** 2).sum()
        out = target[~train] - design[~train] @ coef
        spread = ((target[~train] - target[~train].mean()) ** 2).sum()
        for i, term in enumerate([*"abcd", "intercept"]):
            row = report[label, term]
            assert row.coef == pytest.approx(coef[i], rel=1e-6)
            assert row.t_value == pytest.approx(t[i], rel=1e-6)
            assert row.r2 == pytest.approx(r2)
            assert row.holdout_r2 == pytest.approx(1 - out @ out / spread)
            assert row.holdout_rmse == pytest.approx(math.sqrt((out**2).mean()))


def test_ols_leaves_out_unknown_features_and_labels(spark):
    data = [(D(2022, 1, 1) + dt.timedelta(days=i), float(i), 3.0 * i + 1) for i in range(40)]
    data += [(D(2023, 1, 1), None, 5.0), (D(2023, 1, 2), 7.0, None)]
    df = spark.createDataFrame(data, "date date, a double, y double")
    coef = {r.term: r.coef for r in op.ols_report(df, ["a"], ["y"]).collect()}
    assert coef["a"] == pytest.approx(3.0) and coef["intercept"] == pytest.approx(1.0)


def test_ols_report_with_dependent_features_has_no_t_values(spark, sample):
    df = _table(spark, sample).withColumn("twice", F.col("a") * 2)
    report = op.ols_report(df, ["a", "twice"], ["y"]).collect()
    assert [r.term for r in report] == ["a", "twice", "intercept"]
    assert all(r.coef is not None for r in report)


def test_split_by_day_covers_every_row_once(spark, sample):
    df = _table(spark, sample)
    train, holdout = op.split_by_day(df)
    assert train.count() + holdout.count() == df.count()
    assert train.join(holdout, "date").count() == 0
    # the same whatever the partitioning
    again, _ = op.split_by_day(df.repartition(13))
    assert again.select("date").exceptAll(train.select("date")).count() == 0


def test_split_by_day_scatters_the_days(spark):
    df = spark.range(3000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    side = [r[0] for r in df.orderBy("date").select(op.in_training("date")).collect()]
    assert 0.66 < sum(side) / len(side) < 0.74
    changes = sum(a != b for a, b in zip(side, side[1:]))
    assert 0.38 < changes / len(side) < 0.46  # 2 * 0.7 * 0.3 of neighbours fall apart
    other = [r[0] for r in df.orderBy("date").select(op.in_training("date", seed=1)).collect()]
    assert other != side


def test_ols_report_without_held_out_days_and_without_a_copy_left(spark, sample):
    df = _table(spark, sample)
    train, _ = op.split_by_day(df)
    report = op.ols_report(train, ["a"], ["y"]).collect()
    assert all(r.holdout_r2 is None and r.holdout_rmse is None and r.r2 is not None for r in report)
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "daygrain"
    before = set(folder.glob("model-days-*"))
    op.ols_report(df, ["a"], ["y"], split="random", seed=5)
    assert set(folder.glob("model-days-*")) == before


def test_only_missing_t_values_become_null():
    class Lost:
        @property
        def tValues(self):  # noqa: N802
            raise RuntimeError("an executor was lost")

    class Model:
        summary = Lost()

    with pytest.raises(RuntimeError, match="lost"):
        regression._t_values(Model(), 2)


def test_rates_of_whole_numbers_are_exact(spark):
    df = spark.createDataFrame([(4999999999, 10**10), (5 * 10**9, 10**10), (7, 2), (-7, 2), (1, 0)], "t long, d long")
    got = [r[0] for r in df.select(rate("t", "d", 0, whole=True)).collect()]
    assert got == [0.0, 1.0, 4.0, -4.0, None]
    assert df.select(rate("t", "d", 3, whole=True)).first()[0] == 0.5


def test_months_open_their_folders_only(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.range(1200).select(
        F.lit("s").alias("station"), F.col("id").cast("double").alias("m"),
        (F.lit("2021-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("ts"),
    )
    df.withColumns({"year": F.year("ts"), "month": F.month("ts")}).write.partitionBy("year", "month").parquet(path)
    table = spark.read.parquet(path)
    for series, n in (
        (op.month_series(table, 2, ["m"]), 28 * 3 + 29),
        (op.month_series(table, 2, ["m"], year=2022), 28),
        (op.station_series(table, "2021-12-30", "2022-01-02", ["m"]), 4),
    ):
        plan = series._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*month", plan), plan
        assert series.count() == n


def test_random_split_is_repeatable(spark, sample):
    df = _table(spark, sample)
    a, b = op.random_split(df, seed=3)
    c, _ = op.random_split(df, seed=3)
    assert a.count() + b.count() == df.count() and rows(a) == rows(c)


def test_holdout_predictions(spark, sample):
    df = _table(spark, sample)
    got = op.holdout_predictions(df, list("abcd"), "y")
    assert got.columns == ["date", "y", "prediction"]
    assert got.count() == op.split_by_day(df)[1].count()


def test_counts_at_several_grains_from_one_scan(spark):
    from daygrain.operators import counts_by_grains, grain_of

    rows = [(1, "a", None), (1, "b", 2), (None, "a", 2), (1, "a", None)]
    df = spark.createDataFrame(rows, "x int, y string, z int").repartition(3)
    grains = {"xy": {"x": F.col("x"), "y": F.upper("y")}, "z": {"z": F.col("z")}, "all": {"known": F.col("x").isNotNull()}}
    counts = counts_by_grains(df, grains)
    got = {g: sorted((tuple(r) for r in grain_of(counts, g).collect()), key=repr) for g in grains}
    assert got == {
        "xy": sorted([(1, "A", 2), (1, "B", 1), (None, "A", 1)], key=repr),
        "z": sorted([(None, 2), (2, 2)], key=repr),
        "all": sorted([(True, 3), (False, 1)], key=repr),
    }
    assert counts_by_grains(df.limit(0), grains).count() == 0
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_four_products_of_a_profile_equal_those_of_the_collisions(spark, sf_dir):
    from daygrain.plans import collisions
    from daygrain.queries.raw_standins import crashes

    events = collisions.clean(crashes(spark, sf_dir))
    profile = collisions.profile(events)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    for product in (collisions.per_hour, collisions.severity_by_month, collisions.per_day_and_borough, collisions.involved_parties):
        one, two = product(events), product(profile)
        assert one.dtypes == two.dtypes
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
