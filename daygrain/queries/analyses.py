"""The analyses of :mod:`daygrain.plans` on the three data sets in their own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.plans import collisions, impact, ridership, weather
from daygrain.queries.models import in_train_sql, report_sql
from daygrain.queries.raw_standins import RAW_SQL, WITH_GAPS_SQL, crashes, reports, rides
from daygrain.queries.registry import oracle_sql, query
from daygrain.queries.standins import half_up

OUTCOMES = ["crash", *V.CASUALTIES, *V.TRANSIT_MODES]
_UNION = "\nUNION ALL\n"

_FLAGS_SQL = ", ".join(
    f"bool_or(coalesce(contains(daily_weather, '{code}'), FALSE)) AS {flag}"
    for flag, code in V.CONDITION_CODES.items()
)
_TEMPERATURE_SQL = f"""
  SELECT CAST(ts AS DATE) AS date, min(try_cast(dry_bulb_temperature AS DOUBLE)) AS min_t,
         max(try_cast(dry_bulb_temperature AS DOUBLE)) AS max_t,
         avg(try_cast(dry_bulb_temperature AS DOUBLE)) AS avg_t
  FROM reports WHERE station = '{V.STATION_CENTRAL_PARK}' AND report_type = 'FM-15' GROUP BY 1"""
_CONDITIONS_SQL = f"""
  SELECT CAST(ts AS DATE) AS date, min(sunrise) AS sunrise, max(sunset) AS sunset, {_FLAGS_SQL}
  FROM reports WHERE station = '{V.STATION_CENTRAL_PARK}' AND report_type = 'SOD' GROUP BY 1"""
_CASUALTIES_SQL = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in V.CASUALTIES)


def _crash_days_sql(source: str) -> str:
    return f"SELECT crash_date AS date, count(*) AS crash, {_CASUALTIES_SQL} FROM {source} GROUP BY 1"


DAYS_SQL = f"""{RAW_SQL},
temperature AS ({_TEMPERATURE_SQL}),
conditions AS ({_CONDITIONS_SQL}),
crash_days AS ({_crash_days_sql("crashes_folded")}),
days AS (
  SELECT * REPLACE ({half_up("avg_t", 1)} AS avg_t),
         sunrise // 100 * 60 + sunrise % 100 AS sunrise_min,
         sunset // 100 * 60 + sunset % 100 AS sunset_min
  FROM temperature JOIN conditions USING (date) JOIN crash_days USING (date)
  JOIN rides_folded USING (date))
"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.daily_features(
        weather.daily_weather(reports(spark, sf_dir)),
        collisions.daily(collisions.clean(crashes(spark, sf_dir, fold=True))),
        rides(spark, sf_dir, fold=True),
    )


@query(f"{DAYS_SQL} SELECT * REPLACE (round(avg_t, 6) AS avg_t) FROM temperature")
def weather_daily_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = weather.daily_temperature(reports(spark, sf_dir))
    return daily.withColumn("avg_t", F.round("avg_t", 6))


@query(f"{DAYS_SQL} SELECT * FROM conditions")
def weather_daily_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.daily_conditions(reports(spark, sf_dir))


@query(f"{DAYS_SQL} SELECT * REPLACE (round(avg_t, 6) AS avg_t) "
       "FROM temperature JOIN conditions USING (date)")
def weather_daily_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = weather.daily_weather(reports(spark, sf_dir))
    return daily.withColumn("avg_t", F.round("avg_t", 6))


def _described_sql(code: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN '{d}'" for c, d in V.WEATHER_CODES.items())
    return f"CASE {code} {cases} ELSE {code} END AS description"


@query(f"""{RAW_SQL}
SELECT DISTINCT t.code, {_described_sql("t.code")}
FROM reports, unnest(string_split(daily_weather, ' ')) AS t(code)
WHERE t.code <> '' AND station = '{V.STATION_CENTRAL_PARK}'""")
def weather_code_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.code_vocabulary(reports(spark, sf_dir))


@query(f"""{RAW_SQL},
hits AS (
  SELECT DISTINCT t.code, CAST(ts AS DATE) AS date, 1 AS present
  FROM reports, unnest(string_split(daily_weather, ' ')) AS t(code)
  WHERE t.code <> '' AND ts >= DATE '2024-01-01' AND ts < DATE '2024-01-31'),
grid AS (
  SELECT code, CAST(d AS DATE) AS date
  FROM unnest([{", ".join(f"'{c}'" for c in V.WEATHER_CODES)}]) AS c(code),
       generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) AS s(d))
SELECT code, date, coalesce(present, 0) AS present, {_described_sql("code")}
FROM grid FULL JOIN hits USING (code, date)""")
def weather_code_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.code_calendar(reports(spark, sf_dir), "2024-01-01", "2024-01-30")


_NAMED_SQL = " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in V.STATION_NAMES.items())
_CLEAN_SQL = f"""
  SELECT ts, report_type, CASE station {_NAMED_SQL} ELSE station END AS station,
         try_cast(dry_bulb_temperature AS DOUBLE) AS dry_bulb_temperature,
         try_cast(relative_humidity AS DOUBLE) AS relative_humidity,
         try_cast(CASE precipitation WHEN 'T' THEN '0.00' ELSE precipitation END AS DOUBLE)
           AS precipitation
  FROM reports"""
_SERIES_SQL = "station, ts, dry_bulb_temperature, relative_humidity, precipitation"


@query(f"{RAW_SQL} {_CLEAN_SQL}")
def weather_clean_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = weather.clean_hourly(reports(spark, sf_dir))
    return clean.select("ts", "report_type", "station", *weather.SERIES_MEASURES)


@query(f"{RAW_SQL} SELECT {_SERIES_SQL} FROM ({_CLEAN_SQL}) WHERE report_type = 'FM-15' "
       "AND ts >= DATE '2024-01-15' AND ts < DATE '2024-01-22'")
def weather_weekly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.weekly_series(weather.clean_hourly(reports(spark, sf_dir)), "2024-01-18")


@query(f"{RAW_SQL} SELECT {_SERIES_SQL} FROM ({_CLEAN_SQL}) WHERE report_type = 'FM-15' "
       "AND month(ts) = 1 AND station IN ('EWR', 'LGA', 'Central Park')")
def weather_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.monthly_series(weather.clean_hourly(reports(spark, sf_dir)), 1)


@query(f"""{RAW_SQL},
days AS ({_crash_days_sql("crashes")})
SELECT CAST(month(date) AS INTEGER) AS month, round(avg(crash), 6) AS avg_daily FROM days GROUP BY 1""")
def collision_means_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the day table, as `run` takes it."""
    means = collisions.mean_by_month(collisions.daily(crashes(spark, sf_dir)))
    return means.withColumn("avg_daily", F.round("avg_daily", 6))


@query(f"""{RAW_SQL},
domain(weekday, ord) AS (
  VALUES ('Monday', 1), ('Tuesday', 2), ('Wednesday', 3), ('Thursday', 4), ('Friday', 5),
         ('Saturday', 6), ('Sunday', 7)),
counts AS (SELECT dayname(crash_date) AS weekday, count(*) AS crash FROM crashes GROUP BY 1)
SELECT weekday, ord, crash FROM domain LEFT JOIN counts USING (weekday)""")
def collision_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the day table, as `run` takes it."""
    return collisions.per_weekday(collisions.daily(crashes(spark, sf_dir)))


@query(f"{RAW_SQL} {_crash_days_sql('crashes')}")
def collision_day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.daily(collisions.clean(crashes(spark, sf_dir)))


@query(f"""{RAW_SQL}
SELECT crash_date AS date, nullif(count(*) FILTER (upper(trim(borough)) = 'BRONX'), 0) AS "BRONX",
       nullif(count(*) FILTER (upper(trim(borough)) <> 'BRONX'), 0) AS "Others"
FROM crashes WHERE borough IS NOT NULL GROUP BY 1""")
def collision_boroughs_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = collisions.clean(crashes(spark, sf_dir))
    return collisions.per_day_and_borough(cleaned, ["BRONX"])


@query(f"""{RAW_SQL}
SELECT CAST(split_part(crash_time, ':', 1) AS INTEGER) AS hour, count(*) AS crash
FROM crashes GROUP BY 1""")
def collision_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.per_hour(crashes(spark, sf_dir))


@query(f"""{RAW_SQL},
months AS (SELECT CAST(m AS INTEGER) AS ord, monthname(make_date(2000, CAST(m AS INTEGER), 1)) AS month
           FROM range(1, 13) AS r(m)),
counts AS (
  SELECT CAST(month(crash_date) AS INTEGER) AS ord,
         nullif(count(*) FILTER (ppl_i > 0 OR ppl_k > 0), 0) AS "Dangerous",
         nullif(count(*) FILTER (NOT (ppl_i > 0 OR ppl_k > 0)), 0) AS "Non-Injury"
  FROM crashes GROUP BY 1)
SELECT month, ord, "Dangerous", "Non-Injury" FROM months LEFT JOIN counts USING (ord)""")
def collision_severity_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.severity_by_month(crashes(spark, sf_dir))


@query(f"""{RAW_SQL},
counts AS (
  SELECT value, count(*) AS n
  FROM ({_UNION.join(f"SELECT vehicle_{i} AS value FROM crashes" for i in range(1, 6))})
  WHERE value IS NOT NULL GROUP BY 1),
top AS (SELECT value, n FROM counts WHERE value <> 'Others' ORDER BY n DESC, value LIMIT 10)
SELECT value, n FROM top
UNION ALL
SELECT 'Others', CAST(coalesce(sum(n), 0) AS BIGINT) FROM counts
WHERE value NOT IN (SELECT value FROM top)""")
def collision_vehicle_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.vehicle_types(crashes(spark, sf_dir))


_HURT_SQL = {
    party: f"(coalesce({p}_i, 0) > 0 OR coalesce({p}_k, 0) > 0)"
    for party, p in (("Pedestrian", "ped"), ("Cyclist", "cyc"), ("Motorist", "mot"))
}


@query(RAW_SQL + _UNION.join(
    [f"SELECT '{p}' AS party, count(*) AS n FROM crashes WHERE {c}" for p, c in _HURT_SQL.items()]
    + [f"SELECT 'Vehicle', count(*) FROM crashes WHERE NOT ({' OR '.join(_HURT_SQL.values())})"]))
def collision_involved_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.involved_parties(crashes(spark, sf_dir))


@query(f"{RAW_SQL} SELECT * FROM rides WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def ridership_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ridership.clean(rides(spark, sf_dir), "1996-01-01", "1996-12-31")


@query(f"""{RAW_SQL}
SELECT strftime(date, '%Y-%m') AS month,
       {", ".join(f"round(avg({m}), 6) AS {m}" for m in V.PROFILE_MODES)}
FROM rides GROUP BY 1""")
def ridership_monthly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = ridership.monthly_profile(rides(spark, sf_dir))
    return profile.withColumns({m: F.round(m, 6) for m in V.PROFILE_MODES})


_TOTAL_SQL = " + ".join(V.SHARE_MODES)


@query(f"""{RAW_SQL},
monthly AS (
  SELECT strftime(date, '%Y-%m') AS month,
         {", ".join(f"avg({m} * 100.0 / nullif({_TOTAL_SQL}, 0)) AS {m}" for m in V.SHARE_MODES)}
  FROM rides GROUP BY 1)
{_UNION.join(f"SELECT '{m}' AS mode, round(avg({m}), 6) AS percent FROM monthly"
             for m in V.SHARE_MODES)}""")
def ridership_mean_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = ridership.mean_shares(rides(spark, sf_dir))
    return shares.withColumn("percent", F.round("percent", 6))


def _spread_sql(condition: str, value: str, mode: str, where: str = "TRUE") -> str:
    return (
        f"SELECT '{condition}' AS condition, {value} AS value, '{mode}' AS measure, "
        f"round(avg({mode}), 6) AS mean, round(stddev_samp({mode}), 6) AS stddev "
        f"FROM rides_folded JOIN conditions USING (date) WHERE {where} GROUP BY 1, 2"
    )


@query(DAYS_SQL.replace(*WITH_GAPS_SQL) + _UNION.join(
    part for m in V.SPREAD_MODES for part in (
        _spread_sql("rain", "rain", m),
        _spread_sql("snow", "snow", m),
        _spread_sql("neither", "TRUE", m, "NOT rain AND NOT snow"))))
def transit_by_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the one-pass day table; all reports count, and some days lack hourly ones."""
    days = weather.weather_days(reports(spark, sf_dir, gaps=True))
    conditions = weather.conditions_of(days)
    spread = ridership.spread_by_weather(rides(spark, sf_dir, fold=True), conditions)
    return spread.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(f"{DAYS_SQL} SELECT * FROM days")
def joint_daily_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


def _impact_sql(condition: str) -> str:
    rates = ", ".join(
        f"{half_up(f'sum({c}) / count(crash)', places)} AS {name}"
        for c, name, places in (
            ("ppl_i", "ppl_injured_per_day", 3), ("ppl_k", "ppl_killed_per_day", 3),
            ("crash", "crashes_per_day", 0), ("sub", "sub_per_day", 0), ("bus", "bus_per_day", 0))
    )
    totals = ", ".join(
        f"CAST(sum({c}) AS BIGINT) AS {name}" for c, name in impact.IMPACT_SUMS.items()
    )
    return (
        f"SELECT '{condition}' AS condition, {condition} AS value, count(crash) AS days, {totals}, "
        f"{rates} FROM days GROUP BY 1, 2"
    )


@query(DAYS_SQL + _UNION.join(_impact_sql(c) for c in V.IMPACT_CONDITIONS))
def joint_condition_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.condition_impact(_features(spark, sf_dir))


def _corr_sql(x: str, y: str) -> str:
    r = f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN round(corr({x}, {y}), 6) END"
    return f"SELECT '{x}' AS x, '{y}' AS y, {r} AS r FROM days"


@query(DAYS_SQL + _UNION.join(_corr_sql(x, y) for x in V.WEATHER_MEASURES for y in OUTCOMES))
def joint_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.correlations(_features(spark, sf_dir)).withColumn("r", F.round("r", 6))


_MODEL_SQL = f"""{DAYS_SQL},
model AS (SELECT *, {in_train_sql("date")} AS in_train FROM days)
"""


@query(report_sql(_MODEL_SQL, V.MODEL_FEATURES, V.MODEL_LABELS))
def joint_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = impact.regression_report(_features(spark, sf_dir))
    numbers = ["coef", "t_value", "r2", "holdout_r2", "holdout_rmse"]
    return report.withColumns({c: F.round(c, 6) for c in numbers})


def _from_profile(name: str, of):
    """The same product from the profile, with the SQL of the one from the collisions."""

    def from_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
        return of(collisions.profile(collisions.clean(crashes(spark, sf_dir))))

    return query(oracle_sql()[name], name=f"{name}_from_profile")(from_profile)


collision_hours_from_profile = _from_profile("collision_hours", collisions.per_hour)
collision_severity_from_profile = _from_profile("collision_severity_by_month", collisions.severity_by_month)
collision_boroughs_from_profile = _from_profile(
    "collision_boroughs_by_day", lambda profile: collisions.per_day_and_borough(profile, ["BRONX"])
)
collision_parties_from_profile = _from_profile("collision_involved_parties", collisions.involved_parties)
