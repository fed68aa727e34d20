"""Heavy hitters, day bitmaps, buckets and lookups: results, plans and rows read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_physical import count, final, planned

from daygrain.operators import (
    co_occurring_days,
    day_bitmaps,
    days_of,
    days_with_all,
    days_with_any,
    heavy_hitters,
    join_on,
    merge_bitmaps,
    top_k_with_others,
)
from daygrain.operators.bitmaps import bitmap_calendar
from daygrain.sources import rows_read, values_of, write_bucketed, write_for_lookup

D = dt.date


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("tracked", [20, 200, 20_000])
def test_heavy_hitters_equal_the_count_of_all_values(spark, tracked):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").otherwise(F.concat(F.lit("v"), F.col("id") % 7000))
    df = spark.range(0, 60_000, 1, 6).select(hot.alias("a"), F.when(F.col("id") % 5 == 2, "Others").alias("b"), F.lit(None).cast("string").alias("c"))
    for k in (1, 2, 5):
        want = rows(top_k_with_others(df, ["a", "b", "c"], k))
        assert sorted(rows(heavy_hitters(df, ["a", "b", "c"], k, tracked=tracked))) == sorted(want)


def test_heavy_hitters_of_few_values_and_none(spark):
    df = spark.createDataFrame([("x", None), ("x", "y"), (None, None)], "a string, b string")
    assert sorted(rows(heavy_hitters(df, ["a", "b"], 5))) == [("Others", 0), ("x", 2), ("y", 1)]
    assert rows(heavy_hitters(df.limit(0), ["a"], 3)) == [("Others", 0)]


def test_a_million_values_are_not_shuffled(spark):
    df = spark.range(0, 1_000_000, 1, 4).select(F.when(F.col("id") % 4 < 2, F.concat(F.lit("h"), F.col("id") % 4)).otherwise(F.col("id").cast("string")).alias("a"))
    shuffled = []

    from daygrain.operators import heavy

    kept = heavy.written
    try:
        def watched(frame, name):
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan()
            plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
            stack = [plan]
            while stack:
                node = stack.pop()
                if node.nodeName() == "Exchange":
                    shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
                if "QueryStage" in node.nodeName():
                    stack.append(node.plan())
                stack += [node.children().apply(i) for i in range(node.children().size())]
            return kept(frame, name)

        heavy.written = watched
        got = sorted(rows(heavy_hitters(df, ["a"], 2, tracked=500)))
    finally:
        heavy.written = kept
    assert got == [("Others", 500_000), ("h0", 250_000), ("h1", 250_000)]
    assert shuffled and max(shuffled) <= 4 * 501


@pytest.fixture
def codes(spark):
    data = [
        (D(2022, 1, 1), "RA SN"), (D(2022, 1, 1), "RA"), (D(2022, 1, 2), "SN  BR"), (D(2022, 3, 1), "RA BR"),
        (None, "RA"), (D(2022, 1, 3), None), (D(1970, 1, 1), "RA"), (D(1969, 12, 31), "SN RA"), (D(2100, 5, 5), "RA SN"),
    ]
    return spark.createDataFrame(data, "ts date, text string").repartition(3)


def test_bitmaps_equal_sets_of_days(spark, codes):
    bitmaps = day_bitmaps(codes, "ts", "text")
    first, last = "1969-01-01", "2101-01-01"
    want = {}
    for r in codes.collect():
        for code in (r.text or "").split():
            if r.ts:
                want.setdefault(code, set()).add(r.ts)
    for code, days in want.items():
        assert {r.date for r in days_of(days_with_any(bitmaps, [code]), first, last).collect()} == days
    both = want["RA"] & want["SN"]
    assert {r.date for r in days_of(days_with_all(bitmaps, ["RA", "SN", "RA"]), first, last).collect()} == both
    assert {r.date for r in days_of(days_with_any(bitmaps), first, last).collect()} == set.union(*want.values())
    assert days_of(days_with_all(bitmaps, ["RA", "NEVER"]), first, last).count() == 0
    pairs = {(r.code_1, r.code_2): r.days for r in co_occurring_days(bitmaps, ["RA", "SN", "BR", "NEVER"]).collect()}
    assert pairs == {("RA", "SN"): len(both), ("BR", "RA"): 1, ("BR", "SN"): 1}
    grid = bitmap_calendar(bitmaps, ["RA", "NEVER"], "2021-12-31", "2022-03-02").collect()
    assert len(grid) == 2 * 62 and {r.date for r in grid if r.present} == {D(2022, 1, 1), D(2022, 3, 1)}


def test_bitmaps_of_loads_are_put_together(codes):
    whole = day_bitmaps(codes, "ts", "text")
    parts = [day_bitmaps(codes.filter(c), "ts", "text") for c in ("ts < '2022-02-01'", "ts >= '2022-02-01'", "ts IS NULL")]
    merged = merge_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert sorted(rows(merged.select("code", "bucket", F.hex("days")))) == sorted(rows(whole.select("code", "bucket", F.hex("days"))))
    assert day_bitmaps(codes.limit(0), "ts", "text").count() == 0


def test_buckets_are_joined_and_regrouped_without_exchange(spark, tmp_path):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        frames = [
            spark.range(200).select(F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"), (F.col("id") * k).alias(f"v{k}"))
            for k in (1, 2, 3)
        ]
        plain = join_on([f.groupBy("date").agg(F.sum(f"v{k}").alias(f"s{k}")) for k, f in enumerate(frames, 1)])
        kept = [write_bucketed(f, f"layout_{k}", str(tmp_path / str(k)), "date", 4) for k, f in enumerate(frames, 1)]
        grouped = [f.groupBy("date").agg(F.sum(f"v{k}").alias(f"s{k}")) for k, f in enumerate(kept, 1)]
        joined = join_on(grouped)
        assert count(final(joined), "Exchange") == 0 and count(final(joined), "SortMergeJoin") == 2
        assert count(planned(plain), "Exchange") == 3
        assert sorted(rows(joined)) == sorted(rows(plain))
    finally:
        spark.conf.set(key, before)
        for k in (1, 2, 3):
            spark.sql(f"DROP TABLE IF EXISTS layout_{k}")


def test_a_station_is_looked_up_in_few_row_groups(spark, tmp_path):
    station = F.concat(F.lit("s"), F.lpad(((F.col("id") * 7919) % 97).cast("string"), 3, "0"))
    events = spark.range(0, 50_000, 1, 2).select("id", station.alias("station"))
    plain = str(tmp_path / "plain")
    events.write.parquet(plain)
    before = rows_read(spark.read.parquet(plain).filter("station = 's042'"), spark)
    kept = write_for_lookup(events, str(tmp_path / "kept"), "station", rows_per_group=2_000)
    found = values_of(kept, "station", ["s042"])
    after = rows_read(found, spark)
    assert before == 50_000 and after <= 8_000
    assert found.count() == events.filter("station = 's042'").count() > 0
    assert rows_read(values_of(kept, "station", ["s0421"]), spark) == 0
    assert values_of(kept, "station", ["s001", "s002"]).count() == events.filter("station IN ('s001', 's002')").count()
