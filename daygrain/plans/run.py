"""All analyses from raw files to result tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import astuple, dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daygrain import fixed_values as V
from daygrain.operators import corr_matrix
from daygrain.plans import collisions, impact, ridership, weather
from daygrain.sources import (
    COLLISIONS,
    RIDERSHIP,
    WEATHER,
    check_raw,
    observed_counts,
    read_collisions,
    read_table,
    read_weather,
    write_table,
)
from daygrain.sources.steps import Steps, files_key, key_of


CENTRAL_PARK = V.STATION_NAMES[V.STATION_CENTRAL_PARK]


@dataclass(frozen=True)
class Scope:
    """What of the sources is studied: the station of the day tables, and the days of the rides.

    The defaults are those of the published results. Reports and collisions are kept
    for all days; the joined tables have the days of all sources.
    """

    first: str = V.FIRST_DAY
    last: str = V.LAST_DAY
    station: str | None = CENTRAL_PARK
    split: str = "day"
    seed: int = 0


def event_tables(spark: SparkSession, weather_path: str, collisions_path: str):
    """The two clean event tables, by name."""
    return {
        "reports": weather.clean_hourly(read_weather(spark, weather_path)),
        "collisions": collisions.clean(read_collisions(spark, collisions_path)),
    }


def day_tables(
    events: dict[str, DataFrame], rides: DataFrame, scope: Scope = Scope()
) -> dict[str, DataFrame]:
    """The three day tables, by name."""
    return {
        "daily_weather": weather.weather_days(events["reports"], station=scope.station),
        "daily_collisions": collisions.daily(events["collisions"]),
        "daily_ridership": ridership.clean(rides, scope.first, scope.last),
    }


def joined_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The days that all sources have, by name."""
    days = (weather.both_of(tables["daily_weather"]), tables["daily_collisions"])
    return {"daily_features": impact.daily_features(*days, tables["daily_ridership"])}


def joint_results(features: DataFrame, scope: Scope = Scope()) -> dict[str, DataFrame]:
    """Result tables by name, from the joined day table."""
    return {
        "condition_impact": impact.condition_impact(features),
        "correlations": impact.correlations(features),
        "regression": impact.regression_report(features, split=scope.split, seed=scope.seed),
        **{
            f"predictions_{label}": impact.regression_predictions(
                features, label, split=scope.split, seed=scope.seed
            )
            for label in V.MODEL_LABELS
        },
    }


def products(tables: dict[str, DataFrame], scope: Scope = Scope()) -> dict[str, DataFrame]:
    """Result tables by name, from the event and day tables.

    With the table ``collision_profile`` four of them need no pass over the collisions.
    """
    crashes, reports = tables["collisions"], tables["reports"]
    profile = tables.get("collision_profile", crashes)
    crash_days, rides = tables["daily_collisions"], tables["daily_ridership"]
    conditions = weather.conditions_of(tables["daily_weather"])
    return {
        "weather_agg": weather.temperature_of(tables["daily_weather"]),
        "weather_cond": conditions,
        "correlation_matrix": corr_matrix(
            tables["correlations"], ["crash", *V.CASUALTIES, *V.TRANSIT_MODES]
        ),
        "transit_by_weather": ridership.spread_by_weather(rides, conditions),
        "ridership_by_month": ridership.monthly_profile(rides),
        "mode_shares": ridership.mean_shares(rides),
        "subway_and_bus": ridership.two_modes(rides),
        "worst_days": collisions.worst_days(crash_days),
        "collisions_by_month": collisions.mean_by_month(crash_days),
        "collisions_by_weekday": collisions.per_weekday(crash_days),
        "collisions_by_season": collisions.per_season(crash_days),
        "collisions_by_hour": collisions.per_hour(profile),
        "severity_by_month": collisions.severity_by_month(profile),
        "collisions_by_borough": collisions.per_day_and_borough(profile),
        "vehicle_types": collisions.vehicle_types(crashes),
        "involved_parties": collisions.involved_parties(profile),
        "report_counts": weather.report_counts(reports),
        "weather_codes": weather.code_vocabulary(reports, station=None),
        "code_calendar": weather.code_calendar(reports, scope.first, scope.last),
    }


#: Results of the joined day table besides the correlations, as :func:`joint_results` names them.
JOINT = ["condition_impact", "regression", *(f"predictions_{c}" for c in V.MODEL_LABELS)]
COUNTS_SCHEMA = "source string, column string, given bigint, typed bigint, rejected bigint"


def run(
    spark: SparkSession,
    weather_path: str,
    collisions_path: str,
    ridership_path: str,
    out: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    events_by_month: bool = False,
    scope: Scope = Scope(),
    resume: bool = False,
) -> list[str]:
    """Write event tables, day tables and results, each from the files of the one before.

    The raw text is parsed once. Collisions are reduced to days once, and what the days
    tell is taken from them; hours, severity, boroughs and parties are counted in one pass over
    the collisions, vehicles in one of their own. Raw files come roughly in time order, which the
    event tables keep, so a date range reads few row groups without any shuffle;
    ``events_by_month`` spends a shuffle on a folder per month instead. ``scope`` sets
    period, station and split. Gives the names of the tables and results.

    Fields and records that cannot be read are counted while the tables are written. If there
    are any, ``read_counts`` has the counts by source and column, and ``rejected_fields`` the texts, for
    which the files are read once more.

    Every finished table is noted in a log with a key of the raw files' names, lengths and times and of the
    parameters. ``resume`` goes on from there: tables with the same key are read, not made, and if
    the event tables are among them no raw file is opened.
    """
    paths = {"reports": weather_path, "collisions": collisions_path, "daily_ridership": ridership_path}
    kinds = {"reports": WEATHER, "collisions": COLLISIONS, "daily_ridership": RIDERSHIP}
    steps = Steps(spark, f"{out}/_steps", resume)
    raw_keys = {name: key_of(files_key(spark, path), events_by_month) for name, path in paths.items()}
    raw_keys["daily_ridership"] = key_of(raw_keys["daily_ridership"], scope.first, scope.last)
    key = key_of(sorted(raw_keys.items()), astuple(scope))
    by_month = {"reports": "ts", "collisions": "crash_date"} if events_by_month else {}

    def written_to(name: str, df: DataFrame, how: str) -> None:
        path = f"{out}/tables/{name}"
        if name in by_month:
            day = by_month[name]
            monthly = df.withColumns({"year": F.year(day), "month": F.month(day)})
            write_table(monthly, path, mode=how, order_by=[day], partition_by=["year", "month"])
        else:
            write_table(df, path, mode=how)

    def keep(name: str, key: str, make: Callable[[], DataFrame]) -> bool:
        return steps.keep(name, key, make, partial(written_to, name), mode)

    def kept(*names: str) -> dict[str, DataFrame]:
        return {name: read_table(spark, f"{out}/tables/{name}") for name in names}

    cleaned = {
        "reports": weather.clean_hourly,
        "collisions": collisions.clean,
        "daily_ridership": lambda rides: ridership.clean(rides, scope.first, scope.last),
    }
    counts, ledgers = [], []
    for name, clean in cleaned.items():
        seen = Observation(f"read {name}")

        def typed(name=name, clean=clean, seen=seen) -> DataFrame:
            return clean(check_raw(spark, paths[name], kinds[name], seen).rows)

        if keep(name, raw_keys[name], typed):
            found = observed_counts(seen, kinds[name]["names"])
            counts += [(name, *c) for c in found]
            if any(c[-1] for c in found):
                ledger = check_raw(spark, paths[name], kinds[name]).ledger
                ledgers.append(ledger.select(F.lit(name).alias("source"), "*"))
    events = kept("reports", "collisions")
    faults = ["read_counts", "rejected_fields"] if ledgers else []
    if ledgers:
        how = "overwrite" if resume else mode
        write_table(spark.createDataFrame(counts, COUNTS_SCHEMA), f"{out}/results/read_counts", fmt, how)
        write_table(reduce(DataFrame.unionByName, ledgers), f"{out}/results/rejected_fields", fmt, how)
    keep("daily_weather", key, lambda: weather.weather_days(events["reports"], station=scope.station))
    keep("daily_collisions", key, lambda: collisions.daily(events["collisions"]))
    days = kept("daily_weather", "daily_collisions", "daily_ridership")
    keep("daily_features", key, lambda: joined_tables(days)["daily_features"])
    joined = kept("daily_features")
    keep("correlations", key, lambda: impact.correlations(joined["daily_features"]))
    correlations = kept("correlations")
    result_key = key_of(key, fmt)
    joint = {}
    if not steps.all_finished(JOINT, result_key):  # making these fits the models
        joint = joint_results(joined["daily_features"], scope)
    keep("collision_profile", raw_keys["collisions"], lambda: collisions.profile(events["collisions"]))
    results = products({**events, **days, **correlations, **kept("collision_profile")}, scope)
    for name, df in {**{n: joint[n] for n in JOINT if n in joint}, **results}.items():
        write = partial(_result, f"{out}/results/{name}", fmt)
        steps.keep(name, result_key, lambda df=df: df, write, mode)
    return [*events, *days, *joined, *correlations, *JOINT, *results, *faults]


def _result(path: str, fmt: str, df: DataFrame, how: str) -> None:
    write_table(df, path, fmt, mode=how)
