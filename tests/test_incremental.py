"""Loads that open new files alone, tables that appear together, and runs that go on where they stopped."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daygrain.plans import Scope, collisions, incremental, run, weather
from daygrain.plans import run as run_all
from daygrain.sources import CommitLog, publish, read_published, read_table, read_weather
from daygrain.sources.steps import Steps, files_key

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def spoil(folder, names):
    """Other bytes of the same length and time, which a reader would fail on or give other rows for."""
    for name in names:
        file = Path(folder) / name
        seen, size = file.stat(), file.stat().st_size
        file.write_bytes(b"#" * size)
        os.utime(file, ns=(seen.st_atime_ns, seen.st_mtime_ns))


WEATHER_HEAD = "STATION,DATE,REPORT_TYPE,SOURCE,DailyWeather,HourlyDryBulbTemperature,HourlyRelativeHumidity,HourlyPrecipitation,Sunrise,Sunset"


def weather_lines(days, hours, summaries=True):
    lines = [WEATHER_HEAD]
    for k, d in enumerate(days):
        for h in hours:
            lines.append(f"72505394728,{d}T{h:02d}:51:00,FM-15,7,,{20 + 3 * k + h},50,0.00,,")
        if summaries:
            lines.append(f"72505394728,{d}T23:59:00,SOD  ,6,{'RA' if k % 3 else 'SN'},,,,0700,1700")
    return "\n".join(lines) + "\n"


DAYS = [D(2022, 1, 20) + dt.timedelta(days=i) for i in range(40)]


@pytest.mark.parametrize("cut", [1, 20, 39])
def test_two_loads_equal_one_and_the_second_opens_only_its_files(spark, tmp_path, cut):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    (source / "a.csv").write_text(weather_lines(DAYS[:cut], (1, 2)))
    first = incremental.load(spark, str(source), state, incremental.WEATHER_DAYS)
    assert [Path(f).name for f in first] == ["a.csv"]
    # the second half has later hours of a day of the first one, too
    (source / "b.csv").write_text(weather_lines(DAYS[cut - 1 :], (7, 9), summaries=False))
    want = rows(weather.weather_days(read_weather(spark, str(source))))
    spoil(source, ["a.csv"])
    assert [Path(f).name for f in incremental.load(spark, str(source), state, incremental.WEATHER_DAYS)] == ["b.csv"]
    days = incremental.read_days(spark, state)
    assert days.columns == weather.weather_days(read_weather(spark, str(source / "b.csv"))).columns
    assert rows(days) == want and len(want) == 40
    assert incremental.load(spark, str(source), state, incremental.WEATHER_DAYS) == []


def test_only_months_with_new_days_are_rewritten(spark, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    source.mkdir()
    (source / "a.csv").write_text(weather_lines(DAYS, (1,)))
    incremental.load(spark, str(source), str(state), incremental.WEATHER_DAYS)
    files = lambda: {p.parent.name: (p.name, p.stat().st_mtime_ns) for p in (state / "days").rglob("*.parquet")}
    before = files()
    assert set(before) == {"month=1", "month=2"}
    (source / "b.csv").write_text(weather_lines([D(2022, 2, 25)], (13,)))
    incremental.load(spark, str(source), str(state), incremental.WEATHER_DAYS)
    after = files()
    assert after["month=1"] == before["month=1"] and after["month=2"] != before["month=2"]


def test_a_changed_file_is_refused(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    (source / "a.csv").write_text(weather_lines(DAYS[:3], (1,)))
    incremental.load(spark, str(source), state, incremental.WEATHER_DAYS)
    (source / "a.csv").write_text(weather_lines(DAYS[:4], (1,)))
    with pytest.raises(ValueError, match="a.csv was loaded and has changed"):
        incremental.load(spark, str(source), state, incremental.WEATHER_DAYS)


@pytest.mark.parametrize("broken", ["partials", "days"])
def test_a_load_that_fails_is_done_again(spark, tmp_path, monkeypatch, broken):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    head = "CRASH DATE,CRASH TIME,BOROUGH,NUMBER OF PERSONS INJURED,COLLISION_ID"
    how = incremental.counted_days(
        lambda spark, files: spark.read.option("header", True).csv(list(files)).withColumn("date", F.to_date("CRASH DATE")), "date", {"COLLISION_ID": "ids"}, "crash"
    )
    (source / "a.csv").write_text(f"{head}\n2022-01-01,1:00,X,0,1\n2022-02-01,1:00,X,0,2\n")
    incremental.load(spark, str(source), state, how)
    (source / "b.csv").write_text(f"{head}\n2022-02-01,1:00,X,0,5\n")
    with monkeypatch.context() as patched:
        if broken == "partials":
            patched.setattr(CommitLog, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        else:
            patched.setattr(incremental, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.load(spark, str(source), state, how)
    assert rows(incremental.read_days(spark, state)) == [(D(2022, 1, 1), 1, 1.0), (D(2022, 2, 1), 1, 2.0)]
    again = incremental.load(spark, str(source), state, how)
    assert len(again) == (1 if broken == "partials" else 0)
    assert rows(incremental.read_days(spark, state)) == [(D(2022, 1, 1), 1, 1.0), (D(2022, 2, 1), 2, 7.0)]


def test_collision_days_of_parts_add_up(spark, sf_dir):
    from daygrain.queries.raw_standins import crashes

    events = collisions.clean(crashes(spark, sf_dir))
    how = incremental.COLLISION_DAYS
    parts = [how.partial(events.filter(f"crash_time {op} '12:00'")) for op in ("<", ">=")]
    merged = incremental._combined(parts[0].unionByName(parts[1]), how)
    assert rows(merged.select(*collisions.daily(events).columns)) == rows(collisions.daily(events))


def test_nothing_is_published_if_a_target_fails(spark, tmp_path):
    log, one, two = CommitLog(spark, str(tmp_path / "log")), str(tmp_path / "one"), str(tmp_path / "two")
    old, new = spark.range(3), spark.range(5)
    failing = new.select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(FileNotFoundError):
        read_published(log, one)
    with pytest.raises(Exception, match="lost"):
        publish({one: new, two: failing}, log)
    with pytest.raises(FileNotFoundError):
        read_published(log, one)
    publish({one: old, two: old}, log)
    with pytest.raises(Exception, match="lost"):
        publish({one: new, two: failing}, log)
    assert (read_published(log, one).count(), read_published(log, two).count()) == (3, 3)
    publish({one: new}, log, fmt="csv")
    assert (read_published(log, one).count(), read_published(log, two).count()) == (5, 3)


def test_two_writers_cannot_take_one_record(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert [log.append({"k": i}) for i in range(12)] == list(range(12))
    with pytest.raises(FileExistsError):
        log.append({"k": "other"}, 3)
    assert [r["k"] for r in log.records()] == list(range(12))
    assert not [p for p in (tmp_path / "log").iterdir() if "_staged" in p.name and not p.name.endswith(".crc")]


def test_steps_are_made_once_for_each_key(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(2)

    write = lambda df, how: df.write.mode(how).parquet(str(tmp_path / "t"))
    for key, fresh in (("a", True), ("a", False), ("b", True)):
        steps = Steps(spark, str(tmp_path / "log"), resume=True)
        assert steps.keep("t", key, make, write, "errorifexists") is fresh
    assert len(made) == 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text("1")
    before = files_key(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "g.csv").write_text("1")
    assert files_key(spark, str(tmp_path / "in")) != before


@pytest.fixture
def raw(tmp_path):
    import random

    draw = random.Random(4)
    (tmp_path / "weather").mkdir()
    (tmp_path / "weather" / "a.csv").write_text(weather_lines(DAYS, (6, 14)).replace("FM-15,7,,26", "FM-15,7,,bad"))
    (tmp_path / "collisions").mkdir()
    from daygrain import fixed_values as V

    heads = list(V.COLLISION_COLUMNS)
    lines = [",".join(heads)]
    for i, d in enumerate(DAYS):
        for j in range(draw.randint(1, 5)):
            values = {"crash_date": "no day" if (i, j) == (3, 0) else d, "crash_time": f"{j}:15", "ppl_i": j % 2, "ppl_k": draw.randint(0, 1), "collision_id": 10 * i + j}
            lines.append(",".join(str(values.get(V.COLLISION_COLUMNS[h], "")) for h in heads))
    (tmp_path / "collisions" / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "ridership").mkdir()
    heads = list(V.RIDERSHIP_COLUMNS)
    lines = [",".join(heads)]
    for d in DAYS:
        lines.append(",".join([d.strftime("%m/%d/%Y"), *(str(draw.randint(100, 900)) for _ in heads[1:])]))
    (tmp_path / "ridership" / "a.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_a_stopped_run_goes_on_without_the_raw_files(spark, raw, monkeypatch):
    paths = [str(raw / k) for k in ("weather", "collisions", "ridership")]
    module = __import__("sys").modules["daygrain.plans.run"]
    with monkeypatch.context() as patched:
        patched.setattr(module, "joined_tables", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            run_all(spark, *paths, str(raw / "out"))
    whole = run(spark, *paths, str(raw / "other"))
    for folder in ("weather", "collisions", "ridership"):
        spoil(raw / folder, ["a.csv"])
    names = run(spark, *paths, str(raw / "out"), resume=True)
    assert set(whole) - set(names) == {"read_counts", "rejected_fields"}  # told by the run that read the files
    for name in names:
        kind = "tables" if (raw / "out" / "tables" / name).exists() else "results"
        assert rows(read_table(spark, f"{raw}/out/{kind}/{name}")) == rows(read_table(spark, f"{raw}/other/{kind}/{name}")), name
    counts = {(r.source, r.column): (r.given, r.typed, r.rejected) for r in read_table(spark, f"{raw}/out/results/read_counts").collect()}
    assert counts["collisions", "crash_date"][2] == 1 and counts["reports", None][2] == 0
    assert [(r.source, r.raw) for r in read_table(spark, f"{raw}/out/results/rejected_fields").collect()] == [("collisions", "no day")]


def test_a_finished_run_is_not_made_again(spark, raw, monkeypatch):
    paths = [str(raw / k) for k in ("weather", "collisions", "ridership")]
    names = run(spark, *paths, str(raw / "out"))
    with monkeypatch.context() as patched:
        patched.setattr(Steps, "keep", lambda self, name, key, *a: not self.is_finished(name, key))
        assert set(names) - {"read_counts", "rejected_fields"} == set(run(spark, *paths, str(raw / "out"), resume=True))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        run(spark, *paths, str(raw / "out"))
