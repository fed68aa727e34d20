"""The analyses on small raw files, against results worked out by hand."""

import datetime as dt

import pytest

from daygrain import fixed_values as V
from daygrain.plans import Scope, collisions, impact, ridership, run, weather
from daygrain.sources import read_collisions, read_csv, read_ridership, read_table, read_weather

D = dt.date
PARK, LGA, EWR = V.STATION_CENTRAL_PARK, V.STATION_LGA, V.STATION_EWR


def rows(df):
    return [tuple(r) for r in df.collect()]


WEATHER = f"""STATION,DATE,REPORT_TYPE,SOURCE,DailyWeather,HourlyDryBulbTemperature,HourlyRelativeHumidity,HourlyPrecipitation,Sunrise,Sunset
{PARK},2022-01-01T00:51:00,FM-15,7,,9,80,T,,
{PARK},2022-01-01T01:51:00,FM-15,7,,10,81,0.10,,
{PARK},2022-01-01T02:51:00,FM-15,7,,100,82,0.05s,,
{PARK},2022-01-01T03:51:00,FM-15,7,,33s,83,,,
{PARK},2022-01-01T04:10:00,FM-16,7,,-40,84,,,
{PARK},2022-01-01T23:59:00,SOD  ,6,RA  FG,,,,0720,1639
{LGA},2022-01-01T00:51:00,FM-15,7,,-99,70,0.00,,
{LGA},2022-01-01T23:59:00,SOD  ,6,HZ,,,,0719,1638
{PARK},2022-01-02T00:51:00,FM-15,7,,30,60,0.00,,
{PARK},2022-01-02T23:59:00,SOD  ,6,FZRA BLSN,,,,0720,1640
{PARK},2022-01-03T00:51:00,FM-15,7,,20,50,0.00,,
{PARK},2022-01-03T23:59:00,SOD  ,6,,,,,0720,1641
{PARK},2022-01-04T00:51:00,FM-15,7,,25,50,0.00,,
{EWR},2022-02-10T00:51:00,FM-15,7,,41,50,0.00,,
"""

_COLLISION_HEADER = list(V.COLLISION_COLUMNS)


def _collision(**given):
    return ",".join(str(given.get(V.COLLISION_COLUMNS[c], "")) for c in _COLLISION_HEADER)


COLLISIONS = "\n".join(
    [
        ",".join(_COLLISION_HEADER),
        _collision(crash_date="2022-01-01", crash_time="0:05", borough=" queens ", ppl_i=2, ped_i=1,
                   ppl_k=0, mot_i=1, vehicle_1="Sedan", vehicle_2="Bus", collision_id=1),
        _collision(crash_date="2022-01-01", crash_time="0:59", borough="BRONX", ppl_i=0, ppl_k=1,
                   cyc_k=1, vehicle_1="Sedan", vehicle_2="Bike", collision_id=2),
        _collision(crash_date="2022-01-02", crash_time="23:59", ppl_i=0, ppl_k=0, vehicle_1="Sedan",
                   collision_id=3),
        _collision(crash_date="2022-01-03", crash_time="7:30", borough="Bronx", vehicle_1="Taxi",
                   vehicle_2="Bus", collision_id=4),
        _collision(crash_date="2022-07-04", crash_time="7:45", borough="BRONX", ppl_i=1, mot_i=1,
                   vehicle_1="Sedan", collision_id=5),
        _collision(crash_time="7:50", borough="BRONX", ppl_i=1, vehicle_1="Van", collision_id=6),
    ]
) + "\n"

RIDERSHIP = """Date,Subways: Total Estimated Ridership,Subways: % of Comparable Pre-Pandemic Day,Buses: Total Estimated Ridership,Buses: % of Comparable Pre-Pandemic Day,LIRR: Total Estimated Ridership,Metro-North: Total Estimated Ridership,Access-A-Ride: Total Scheduled Trips,Bridges and Tunnels: Total Traffic,Staten Island Railway: Total Estimated Ridership
12/31/2021,1,0.1,1,0.1,1,1,1,1,1
01/01/2022,600,0.1,300,0.1,10,20,30,100,5
01/02/2022,200,0.1,,0.1,11,21,31,200,6
01/03/2022,500,0.1,250,0.1,12,22,32,250,7
02/01/2022,100,0.1,100,0.1,13,23,33,200,8
12/31/2022,100,0.1,300,0.1,14,24,34,400,9
01/01/2023,1,0.1,1,0.1,1,1,1,1,1
someday,1,0.1,1,0.1,1,1,1,1,1
"""


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    paths = {}
    for name, text in (("weather", WEATHER), ("collisions", COLLISIONS), ("ridership", RIDERSHIP)):
        (folder / name).mkdir()
        (folder / name / "part-0.csv").write_text(text)
        paths[name] = str(folder / name)
    return paths


@pytest.fixture(scope="module")
def reports(spark, raw):
    return read_weather(spark, raw["weather"])


@pytest.fixture(scope="module")
def crashes(spark, raw):
    return collisions.clean(read_collisions(spark, raw["collisions"]))


@pytest.fixture(scope="module")
def rides(spark, raw):
    return ridership.clean(read_ridership(spark, raw["ridership"]))


@pytest.fixture(scope="module")
def features(reports, crashes, rides):
    return impact.daily_features(weather.daily_weather(reports), collisions.daily(crashes), rides)


J1, J2, J3, J4 = (D(2022, 1, d) for d in range(1, 5))


def test_daily_temperature(reports):
    assert sorted(rows(weather.daily_temperature(reports))) == [
        (J1, 9.0, 100.0, pytest.approx(119 / 3)), (J2, 30.0, 30.0, 30.0), (J3, 20.0, 20.0, 20.0),
        (J4, 25.0, 25.0, 25.0),
    ]
    assert rows(weather.daily_temperature(reports, report=V.REPORT_SPECIAL)) == [(J1, -40.0, -40.0, -40.0)]


def test_daily_conditions(reports):
    got = weather.daily_conditions(reports)
    assert got.columns == ["date", "sunrise", "sunset", "rain", "snow", "mist", "haze", "fog"]
    assert sorted(rows(got)) == [
        (J1, 720, 1639, True, False, False, False, True),
        (J2, 720, 1640, True, True, False, False, False),
        (J3, 720, 1641, False, False, False, False, False),
    ]
    exact = sorted(rows(weather.daily_conditions(reports, match="token")))
    assert exact[1] == (J2, 720, 1640, False, False, False, False, False)


def test_one_pass_over_the_reports_equals_the_join(reports):
    joined = weather.daily_temperature(reports).join(weather.daily_conditions(reports), "date")
    one = weather.daily_weather(reports)
    assert one.columns == joined.columns
    assert sorted(rows(one)) == sorted(rows(joined)) and one.count() == 3


def test_report_split(reports):
    parts = weather.report_split(reports)
    assert {k: v.count() for k, v in parts.items()} == {"hourly": 7, "special": 1, "summary": 3}
    assert parts["summary"].columns == ["ts", "source", "daily_weather", "sunrise", "sunset"]
    assert "daily_weather" not in parts["hourly"].columns and "station" not in parts["hourly"].columns


def test_codes(reports):
    codes = dict(rows(weather.code_vocabulary(reports)))
    assert codes == {"RA": "Rain", "FG": "Fog", "FZRA": "Freezing Rain", "BLSN": "Blowing Snow"}
    assert set(dict(rows(weather.code_vocabulary(reports, station=None)))) == {*codes, "HZ"}


def test_report_counts(reports):
    assert dict(rows(weather.report_counts(reports))) == {"FM-15": 9, "SOD": 4, "FM-16": 1}


def test_clean_hourly_and_series(reports):
    clean = weather.clean_hourly(reports)
    first = rows(weather.day_series(clean, "2022-01-01", ordered=True))
    assert [(r[0], r[2], r[4]) for r in first] == [
        ("Central Park", 9.0, 0.0), ("LGA", -99.0, 0.0), ("Central Park", 10.0, 0.1),
        ("Central Park", 100.0, None), ("Central Park", None, None),
    ]
    week = rows(weather.weekly_series(clean, "2022-01-05", ordered=True))
    assert [r[2] for r in week] == [20.0, 25.0]
    assert [r[0] for r in rows(weather.monthly_series(clean, 2))] == ["EWR"]
    assert rows(weather.monthly_series(clean, 2, stations=["LGA"])) == []
    assert len(rows(weather.monthly_series(clean, 1, year=2022))) == 8
    assert rows(weather.monthly_series(clean, 1, year=2021)) == []


def test_code_calendar(reports):
    grid = weather.code_calendar(reports)
    assert grid.count() == 14 * 365
    hits = sorted((r.code, r.date, r.description) for r in grid.filter("present = 1").collect())
    assert hits == [
        ("BLSN", J2, "Blowing Snow"), ("FG", J1, "Fog"), ("FZRA", J2, "Freezing Rain"),
        ("HZ", J1, "Haze"), ("RA", J1, "Rain"),
    ]


def test_collision_cleaning_and_day_table(crashes):
    assert sorted({r.borough for r in crashes.collect() if r.borough}) == ["BRONX", "QUEENS"]
    daily = sorted(rows(collisions.daily(crashes)))
    assert daily[0] == (J1, 2, 2, 1, 1, None, None, 1, 1, None)
    assert [r[:3] for r in daily] == [(J1, 2, 2), (J2, 1, 0), (J3, 1, None), (D(2022, 7, 4), 1, 1)]


def test_collision_profiles(crashes):
    days = collisions.daily(crashes)
    assert rows(collisions.worst_days(days, 2)) == [(J1, 2), (J2, 1)]
    assert rows(collisions.mean_by_month(days)) == [(1, pytest.approx(4 / 3)), (7, 1.0)]
    weekday = {r[0]: r[2] for r in rows(collisions.per_weekday(days))}
    assert weekday == {"Saturday": 2, "Sunday": 1, "Monday": 2, "Tuesday": None, "Wednesday": None,
                       "Thursday": None, "Friday": None}
    assert [r[2] for r in rows(collisions.per_season(days))] == [4, None, 1, None]
    assert rows(collisions.per_hour(crashes)) == [(0, 2), (7, 3), (23, 1)]
    months = rows(collisions.severity_by_month(crashes))
    assert len(months) == 12
    assert months[0] == ("January", 1, 2, 2) and months[1] == ("February", 2, None, None)
    assert months[6] == ("July", 7, 1, None)
    boroughs = collisions.per_day_and_borough(crashes)
    assert [tuple(r) for r in boroughs.select("date", "BRONX", "QUEENS", "Others").orderBy("date").collect()] == [
        (J1, 1, 1, None), (J3, 1, None, None), (D(2022, 7, 4), 1, None, None),
    ]
    unlisted = collisions.per_day_and_borough(crashes, ["QUEENS"]).orderBy("date")
    assert rows(unlisted) == [(J1, 1, 1), (J3, None, 1), (D(2022, 7, 4), None, 1)]


def test_vehicles_and_parties(crashes):
    assert rows(collisions.vehicle_types(crashes, 2)) == [("Sedan", 4), ("Bus", 2), ("Others", 3)]
    assert dict(rows(collisions.involved_parties(crashes))) == {
        "Pedestrian": 1, "Cyclist": 1, "Motorist": 2, "Vehicle": 3,
    }


def test_ridership(rides):
    assert [r.date for r in rides.orderBy("date").collect()] == [J1, J2, J3, D(2022, 2, 1), D(2022, 12, 31)]
    monthly = rows(ridership.monthly_profile(rides))
    assert monthly[0] == ("2022-01", pytest.approx(1300 / 3), 275.0, 31.0, pytest.approx(550 / 3), 6.0)
    shares = dict(rows(ridership.mean_shares(rides)))
    assert shares["sub"] == pytest.approx((55 + 25 + 12.5) / 3)
    assert shares["bus"] == pytest.approx((27.5 + 25 + 37.5) / 3)
    assert rows(ridership.two_modes(rides))[1] == (J2, 200, None)


def test_a_file_without_a_needed_column_is_refused(spark, tmp_path):
    file = tmp_path / "r.csv"
    file.write_text(RIDERSHIP.replace("Buses: Total", "Busses: Total"))
    with pytest.raises(ValueError, match="'Buses: Total Estimated Ridership'"):
        read_ridership(spark, str(file))


def test_transit_by_weather(rides, reports):
    spread = ridership.spread_by_weather(rides, weather.daily_conditions(reports))
    got = {(r.condition, r.value, r.measure): (r["mean"], r.stddev) for r in spread.collect()}
    assert got["rain", True, "sub"] == (400.0, pytest.approx(200 * 2**0.5))
    assert got["rain", True, "bus"] == (300.0, None)
    assert got["snow", True, "sub"] == (200.0, None)
    assert got["neither", True, "brdg_tun"] == (250.0, None)
    assert not [k for k in got if k[0] == "neither" and not k[1]]


def test_features_and_impact(features):
    got = features.orderBy("date").collect()
    assert [r.date for r in got] == [J1, J2, J3]
    assert (got[0].avg_t, got[0].sunrise, got[0].sunrise_min, got[0].sunset_min) == (39.7, 720, 440, 999)
    table = {(r.condition, r.value): r for r in impact.condition_impact(features).collect()}
    rain = table["rain", True]
    assert (rain.days, rain.tt_crash, rain.ppl_injured, rain.ppl_killed) == (2, 3, 2, 1)
    assert (rain.ppl_injured_per_day, rain.ppl_killed_per_day, rain.crashes_per_day) == (1.0, 0.5, 2.0)
    assert (rain.sub_total, rain.sub_per_day, rain.bus_per_day) == (800, 400.0, 150.0)
    assert set(table) >= {("snow", True), ("fog", True), ("haze", False), ("mist", False)}
    corr = impact.correlations(features)
    assert corr.count() == 80
    labels = {(r.x, r.y) for r in impact.correlation_labels(corr).collect()}
    assert ("min t", "metro-north") in labels and ("Sunrise", "crash") in labels


def test_run_writes_every_product(spark, raw, tmp_path):
    # enough days for the models: 40 days with a full set of sources
    import random

    draw = random.Random(1)
    folder = {k: tmp_path / k for k in raw}
    days = [D(2023, 3, 1) + dt.timedelta(days=i) for i in range(40)]
    crashed, ridden, half = {}, {}, 0
    reports, crashes, rides = [WEATHER.splitlines()[0]], [COLLISIONS.splitlines()[0]], [RIDERSHIP.splitlines()[0]]
    for i, d in enumerate(days):
        for hour in (6, 14) if i % 4 else ():
            reports.append(f"{PARK},{d}T{hour:02d}:51:00,FM-15,7,,{draw.randint(20, 90)},50,0.00,,")
        reports.append(f"{PARK},{d}T23:59:00,SOD  ,6,{'RA' if i % 3 else 'SN BR'},,,,06{i:02d},18{i:02d}")
        crashed[d] = draw.randint(1, 6)
        for j in range(crashed[d]):
            half += j % 2
            crashes.append(_collision(crash_date=d, crash_time=f"{j}:15", borough="QUEENS" if j % 2 else "ELSEWHERE", ppl_i=j % 2,
                                      ppl_k=draw.randint(0, 1), vehicle_1=f"Type {j}", collision_id=i * 10 + j))
        counts = [draw.randint(100, 900) for _ in range(9)]
        ridden[d] = counts[0]
        rides.append(",".join([d.strftime("%m/%d/%Y"), *map(str, counts)]))
    for name, lines in (("weather", reports), ("collisions", crashes), ("ridership", rides)):
        folder[name].mkdir()
        middle = len(lines) // 2
        (folder[name] / "a.csv").write_text("\n".join(lines[:middle]) + "\n")
        (folder[name] / "b.csv").write_text("\n".join([lines[0], *lines[middle:]]) + "\n")
    out, year = str(tmp_path / "out"), Scope("2023-01-01", "2023-12-31")
    names = run(spark, str(folder["weather"]), str(folder["collisions"]), str(folder["ridership"]), out,
                events_by_month=True, scope=year)
    assert len(names) == 31
    assert read_table(spark, f"{out}/tables/daily_features").count() == 30
    # days without hourly reports count where conditions alone are asked for
    assert read_table(spark, f"{out}/results/weather_cond").count() == 40
    assert read_table(spark, f"{out}/results/weather_agg").count() == 30
    spread = {(r.condition, r.value): r for r in read_table(spark, f"{out}/results/transit_by_weather").filter("measure = 'sub'").collect()}
    wet = [ridden[d] for i, d in enumerate(days) if i % 3]
    assert spread["rain", True]["mean"] == pytest.approx(sum(wet) / len(wet))
    crashes_of = {r[0]: r[1] for r in read_table(spark, f"{out}/results/worst_days").collect()}
    assert crashes_of == {d: n for d, n in sorted(crashed.items(), key=lambda x: (-x[1], x[0]))[:20]}
    weekdays = {r.weekday: r.crash for r in read_table(spark, f"{out}/results/collisions_by_weekday").collect()}
    assert sum(weekdays.values()) == sum(crashed.values())
    boroughs = read_table(spark, f"{out}/results/collisions_by_borough")
    assert boroughs.selectExpr("sum(QUEENS)", "sum(Others)").first() == (half, sum(crashed.values()) - half)
    predicted = read_table(spark, f"{out}/results/predictions_crash")
    assert 0 < predicted.count() < 30
    terms = read_table(spark, f"{out}/results/regression").collect()
    assert {(r.label, r.term) for r in terms} == {
        (label, term) for label in V.MODEL_LABELS for term in [*V.MODEL_FEATURES, "intercept"]
    }
    assert read_table(spark, f"{out}/tables/collisions").filter("month = 4").count() > 0
    again = run(spark, str(folder["weather"]), str(folder["collisions"]), str(folder["ridership"]), out,
                fmt="csv", mode="overwrite", scope=year)
    assert again == names
    assert read_table(spark, f"{out}/tables/correlations").count() == 80
