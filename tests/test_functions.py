import datetime as dt

import pytest
from pyspark.sql import functions as F

from daygrain import functions as fn


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def column(spark, values, expression, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_parse_date_turns_bad_text_into_null(spark):
    got = column(spark, ["12/31/2021", "2022-01-01", "soon", None], fn.parse_date("v", "MM/dd/yyyy"))
    assert got == [dt.date(2021, 12, 31), None, None, None]


def test_parse_timestamp_keeps_wall_clock_in_any_session_zone(spark):
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    # 02:30 does not exist on that night in New York, 01:30 exists twice in November
    texts = ["2022-03-13T02:30:00", "2022-11-06T01:30:00", "2022-07-01T23:59:59", "bad", None]
    want = [
        dt.datetime(2022, 3, 13, 2, 30), dt.datetime(2022, 11, 6, 1, 30),
        dt.datetime(2022, 7, 1, 23, 59, 59), None, None,
    ]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert column(spark, texts, fn.parse_timestamp("v", pattern)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hour_of_text(spark):
    assert column(spark, ["0:05", "23:59", "7:30", "24:00", "x", None], fn.hour_of_text("v")) == [
        0, 23, 7, None, None, None,
    ]


def test_hhmm_to_minutes(spark):
    assert column(spark, [716, 1929, 0, None], fn.hhmm_to_minutes("v"), "v int") == [
        436, 1169, 0, None,
    ]


@pytest.mark.parametrize(
    "day, monday, sunday",
    [
        ("2022-01-03", "2022-01-03", "2022-01-09"),
        ("2022-01-09", "2022-01-03", "2022-01-09"),
        ("2022-01-01", "2021-12-27", "2022-01-02"),
    ],
)
def test_week_bounds(day, monday, sunday):
    assert fn.week_bounds(day) == (dt.date.fromisoformat(monday), dt.date.fromisoformat(sunday))


def test_names_of_days_and_months_agree_with_formatting(spark):
    days = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    wrong = days.filter(
        (fn.month_name("d") != F.date_format("d", "MMMM"))
        | (fn.weekday_name("d") != F.date_format("d", "EEEE"))
    )
    assert wrong.count() == 0


def test_season(spark):
    got = column(spark, list(range(1, 13)), fn.season_of_month("v"), "v int")
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


def test_days_between_includes_both_days(spark):
    stamps = ["2021-12-31T23:59:59", "2022-01-01T00:00:00", "2022-12-31T23:59:59", "2023-01-01T00:00:00"]
    got = column(
        spark, stamps, fn.days_between(F.col("v").cast("timestamp_ntz"), "2022-01-01", "2022-12-31")
    )
    assert got == [False, True, True, False]


def test_normalise_text(spark):
    assert column(spark, ["  queens ", None, "BRONX"], fn.normalise_text("v")) == ["QUEENS", None, "BRONX"]


def test_coerce_number_with_trace_mark(spark):
    got = column(spark, ["T", "0.12", "33s", "", None, "100"], fn.coerce_number("v", {"T": "0.00"}))
    assert got == [0.0, 0.12, None, None, None, 100.0]


def test_recode_keeps_unknown_values(spark):
    assert column(spark, ["a", "b", None], fn.recode("v", {"a": "Alpha"})) == ["Alpha", "b", None]


def test_tokens_by_blank_and_by_white_space(spark):
    assert column(spark, ["RA  SN", None], fn.tokens("v")) == [["RA", "", "SN"], None]
    assert column(spark, ["RA  SN\tBR", ""], fn.tokens("v", None)) == [["RA", "SN", "BR"], [""]]
    assert column(spark, ["a.b|c"], fn.tokens("v", ".")) == [["a", "b|c"]]


def test_flag_from_code_contains_and_token(spark):
    texts = ["FZRA", "RA SN", "BR", None]
    assert column(spark, texts, fn.flag_from_code("v", "RA")) == [True, True, False, False]
    assert column(spark, texts, fn.flag_from_code("v", "RA", "token")) == [False, True, False, False]
    with pytest.raises(ValueError):
        fn.flag_from_code("v", "RA", "regex")


def test_severity_treats_unknown_counts_as_none(spark):
    df = spark.createDataFrame([(1, 0), (0, 2), (0, 0), (None, None), (None, 1)], "i int, k int")
    got = [r[0] for r in df.select(fn.severity([F.col("i") > 0, F.col("k") > 0])).collect()]
    assert got == ["Dangerous", "Dangerous", "Non-Injury", "Non-Injury", "Dangerous"]


def test_share_and_rate(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.share("a", ["a", "b"])).collect()] == [25.0, None, None]
    assert one(spark, fn.rate(F.lit(5), F.lit(2)), fn.rate(F.lit(1), F.lit(3), 3), fn.rate(F.lit(1), F.lit(0))) == (
        3.0, 0.333, None,
    )


def test_steady_round_does_not_depend_on_order_of_summation(spark):
    half = 125829.85
    below = half - 3e-11
    assert below < half
    assert one(spark, fn.steady_round(F.lit(half), 1), fn.steady_round(F.lit(below), 1)) == (125829.9, 125829.9)
