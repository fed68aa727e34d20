"""States that add up: against numpy on the rows, over any cut of the days, with constants and dependence."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrain.operators import (
    corr_from_moments,
    corr_long,
    in_training,
    merge_moments,
    moment_state,
    ols_from_moments,
    ols_models,
    ols_report,
    pair_models,
    spread_from_moments,
)

FEATURES, LABELS = ["a", "b"], ["y", "z"]


@pytest.fixture(scope="module")
def days(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a, b = (float(v) for v in draw.normal(50, 3, 2))
        y = 2 * a - b + float(draw.normal(0, 1))
        rows.append((dt.date(2022, 1, 1) + dt.timedelta(days=i % 200), None if i % 37 == 0 else a, b, y, None if i % 11 == 0 else y * b, 7.0))
    rows.append((None, 1.0, 2.0, 3.0, 4.0, 7.0))
    return spark.createDataFrame(rows, "date date, a double, b double, y double, z double, same double").repartition(5).cache()


def reports(df):
    return {(r.label, r.term): tuple(r)[2:] for r in df.collect()}


def near(one, two, rel=1e-9):
    assert one.keys() == two.keys()
    for key, values in one.items():
        assert values == pytest.approx(two[key], rel=rel), key


def test_report_equals_row_by_row_fits(days):
    state = moment_state(days, ols_models(FEATURES, LABELS))
    near(reports(ols_from_moments(state, FEATURES, LABELS)), reports(ols_report(days, FEATURES, LABELS)), 1e-7)


def test_any_cut_of_the_rows_gives_the_same_report(spark, days, tmp_path):
    models = ols_models(FEATURES, LABELS)
    whole = reports(ols_from_moments(moment_state(days, models), FEATURES, LABELS))
    part = F.crc32(F.col("b").cast("string")) % 3
    for k in range(3):  # the rows of a day lie in several loads
        moment_state(days.filter(part == k), models).write.mode("append").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    near(reports(ols_from_moments(stored, FEATURES, LABELS)), whole)
    merged = merge_moments(stored, ["date"])
    assert merged.count() < stored.count()
    near(reports(ols_from_moments(merged, FEATURES, LABELS)), whole)


def test_new_rows_of_a_day_change_only_its_state(days):
    models = ols_models(FEATURES, LABELS)
    day = dt.date(2022, 2, 1)
    keyed = lambda df: {(r.date, r.model): tuple(r)[2:] for r in moment_state(df, models).collect()}
    before, after = keyed(days), keyed(days.unionByName(days.filter(F.col("date") == day)))
    changed = {k[0] for k in after if after[k] != pytest.approx(before[k], rel=1e-12)}
    assert changed == {day}


def test_an_origin_changes_no_number_of_the_report(days):
    far = days.select("date", *[(F.col(c) + 1e7).alias(c) for c in (*FEATURES, *LABELS)])
    origin = {c: 1e7 + 50 for c in (*FEATURES, *LABELS)}
    models = ols_models(FEATURES, LABELS)
    state = moment_state(far, models, origin=origin)
    got = reports(ols_from_moments(state, FEATURES, LABELS, origin=origin))
    want = reports(ols_from_moments(moment_state(days, models), FEATURES, LABELS))
    for key in want:
        if key[1] != "intercept":
            assert got[key] == pytest.approx(want[key], rel=1e-6)


def test_dependent_and_constant_features(days):
    wide = days.withColumns({"twice": F.col("a") * 2, "sum": F.col("a") + F.col("b")})
    features = ["a", "twice", "b", "sum", "same"]
    got = reports(ols_from_moments(moment_state(wide, ols_models(features, ["y"])), features, ["y"]))
    plain = reports(ols_from_moments(moment_state(days, ols_models(FEATURES, ["y"])), FEATURES, ["y"]))
    for term in ("twice", "sum", "same"):
        assert got["y", term][:2] == (0.0, None)
    for term in ("a", "b", "intercept"):
        assert got["y", term] == pytest.approx(plain["y", term], rel=1e-6)


def test_few_rows_and_constant_labels(spark, days):
    models = ols_models(["a"], ["y", "same"])
    train = days.filter(in_training("date") & F.col("a").isNotNull())
    one = ols_from_moments(moment_state(train.limit(1), models), ["a"], ["y", "same"]).collect()
    assert {r.t_value for r in one} == {None} and {r.holdout_rmse for r in one} == {None}
    assert {(r.term, r.coef) for r in one if r.label == "same"} == {("a", 0.0), ("intercept", 7.0)}
    flat = reports(ols_from_moments(moment_state(days, models), ["a"], ["same"]))
    assert flat["same", "intercept"][0] == 7.0 and flat["same", "a"][2:4] == (None, None)
    none = ols_from_moments(moment_state(days.limit(0), models), ["a"], ["y"]).collect()
    assert [tuple(r) for r in none] == [("y", t, None, None, None, None, None) for t in ("a", "intercept")]


def test_correlations_from_moments(days):
    xs, ys = ["a", "b", "same"], ["y", "z", "same"]
    pairs = pair_models(xs, ys)
    keyed = lambda df: {(r.x, r.y): r.r for r in df.collect()}
    got, want = keyed(corr_from_moments(moment_state(days, pairs), pairs)), keyed(corr_long(days, xs, ys))
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] if want[k] is None else got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    whole = keyed(corr_from_moments(moment_state(days, pairs, by=[]), pairs))
    rows = np.array([r[1:3] for r in days.select("date", "a", "y").collect() if r.a is not None])
    assert whole["a", "y"] == pytest.approx(np.corrcoef(rows.T)[0, 1], rel=1e-9)
    assert whole["same", "y"] is None and whole["a", "same"] is None


def test_spread_of_one_row_and_of_many(days):
    state = moment_state(days.filter("date IS NOT NULL"), {"a": ["a"], "same": ["same"]})
    got = {r.model: r for r in spread_from_moments(merge_moments(state)).collect()}
    values = [r.a for r in days.collect() if r.a is not None and r.date is not None]
    assert got["a"].n == len(values)
    assert (got["a"].mean, got["a"].stddev) == pytest.approx((np.mean(values), np.std(values, ddof=1)), rel=1e-9)
    assert got["same"].stddev == pytest.approx(0, abs=1e-5)
    single = spread_from_moments(moment_state(days.limit(1), {"b": ["b"]}, by=[])).collect()
    assert [(r.n, r.stddev) for r in single] == [(1, None)]


def test_one_scan_and_one_shuffle_for_all_models(spark, sf_dir):
    from test_physical import count, planned

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    models = ols_models(["l_quantity", "l_discount"], ["l_tax", "l_extendedprice", "l_linenumber"])
    plan = planned(moment_state(lines, models, [F.to_date("l_shipdate").alias("date")]))
    assert count(plan, "FileScan parquet") == 1 and count(plan, "Exchange") == 1
