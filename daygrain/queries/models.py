"""Correlations, splits and least squares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators import (
    corr_from_moments,
    corr_long,
    corr_matrix,
    holdout_predictions,
    in_training,
    merge_moments,
    moment_state,
    ols_from_moments,
    ols_models,
    ols_report,
    pair_models,
    random_split,
    spread_from_moments,
)
from daygrain.queries.registry import query
from daygrain.queries.standins import DAY_TABLES_SQL, XS, YS, features, table
from daygrain.session import scratch_folder
from daygrain.sources import read_table, write_table, written

_UNION = "\nUNION ALL\n"


@query(DAY_TABLES_SQL + _UNION.join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM features"
    for x in XS for y in YS), name="corr_long")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corr_long(features(spark, sf_dir), XS, YS).withColumn("r", F.round("r", 6))


@query(DAY_TABLES_SQL + _UNION.join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr(coalesce({x}, 0), coalesce({y}, 0)), 6) AS r "
    "FROM features" for x in XS for y in YS))
def corr_nulls_as_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    corr = corr_long(features(spark, sf_dir), XS, YS, nulls="zero")
    return corr.withColumn("r", F.round("r", 6))


@query(DAY_TABLES_SQL + "SELECT * FROM (" + _UNION.join(
    f"SELECT '{x}' AS x, " + ", ".join(f"round(corr({x}, {y}), 6) AS {y}" for y in YS)
    + " FROM features" for x in XS) + ")", name="corr_matrix")
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    corr = corr_long(features(spark, sf_dir), XS, YS).withColumn("r", F.round("r", 6))
    return corr_matrix(corr, YS)


def in_train_sql(day: str, seed: int = 0) -> str:
    """SQL for ``in_training``."""
    digest = f"md5(CAST({day} AS VARCHAR) || '|{seed}')"
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % 10 < 7"


# Prices in units of 100,000, so that coefficients are neither huge nor tiny.
SCALE = 100000
_MODEL_SQL = f"""{DAY_TABLES_SQL},
model AS (
  SELECT date, min_t / {SCALE} AS min_t, max_t / {SCALE} AS max_t, sub / {SCALE} AS sub,
         bus / {SCALE} AS bus, crash, ppl_i, ppl_k, {in_train_sql("date")} AS in_train
  FROM features)
"""
FEATURES = ["min_t", "max_t", "sub", "bus"]
LABELS = ["crash", "ppl_i", "ppl_k"]


def _model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = {c: F.col(c) / SCALE for c in FEATURES}
    return features(spark, sf_dir).withColumns(scaled).select("date", *FEATURES, *LABELS)


@query(_MODEL_SQL + """
SELECT CASE WHEN in_train THEN 'train' ELSE 'holdout' END AS part, count(*) AS days,
       CAST(sum(crash) AS BIGINT) AS crash
FROM model GROUP BY 1""")
def key_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(in_training("date"), "train").otherwise("holdout")
    return _model_table(spark, sf_dir).groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("crash").alias("crash")
    )


@query(_MODEL_SQL + """
SELECT count(*) AS days, CAST(sum(crash) AS BIGINT) AS crash, CAST(0 AS BIGINT) AS in_both,
       TRUE AS about_seven_to_three
FROM model""")
def random_split_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both random parts together are the whole table, they share no day, and none is empty or all."""
    days = written(_model_table(spark, sf_dir).select("date", "crash"), "split-days")
    first, second = random_split(days, seed=17)
    parts = first.withColumn("train", F.lit(1)).unionByName(second.withColumn("train", F.lit(0)))
    by_day = parts.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("crash").alias("crash"), F.avg("train").alias("train")
    )
    return by_day.agg(
        F.sum("n").alias("days"),
        F.sum("crash").alias("crash"),
        F.count_if(F.col("n") > 1).alias("in_both"),
        F.avg("train").between(0.6, 0.8).alias("about_seven_to_three"),
    )


def _sweep(features: list[str], label: str, tag: str) -> tuple[str, str]:
    """Common table expressions that solve a least-squares model, and the last one's name.

    Columns are standardised, their correlation matrix is formed with the label
    in the last row, and the sweep operation is applied to each feature in turn.
    What is left holds coefficients, the inverse and the unexplained share. The
    last table has one row: n, per column its mean m_i and spread s_i, and the
    swept matrix a_i_j.
    """
    p = len(features)
    cols = [*features, label]
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    idx = range(p + 1)
    moments = ", ".join(
        f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(cols)
    )
    stats = f"{tag}_stats AS (SELECT count(*) AS n, {moments} FROM model WHERE in_train AND {known})"
    keep = "n, " + ", ".join(f"m_{i}, s_{i}" for i in idx)
    z = [f"(({c} - m_{i}) / s_{i})" for i, c in enumerate(cols)]
    cells = ", ".join(f"avg({z[i]} * {z[j]}) AS a_{i}_{j}" for i in idx for j in idx)
    ctes = [
        stats,
        f"{tag}_0 AS (SELECT {', '.join(f'any_value({k}) AS {k}' for k in keep.split(', '))}, {cells} "
        f"FROM model, {tag}_stats WHERE in_train AND {known})",
    ]
    for k in range(p):
        swept = []
        for i in idx:
            for j in idx:
                if i == k and j == k:
                    e = f"-1 / a_{k}_{k}"
                elif i == k or j == k:
                    e = f"a_{i}_{j} / a_{k}_{k}"
                else:
                    e = f"a_{i}_{j} - a_{i}_{k} * a_{k}_{j} / a_{k}_{k}"
                swept.append(f"{e} AS a_{i}_{j}")
        ctes.append(f"{tag}_{k + 1} AS (SELECT {keep}, {', '.join(swept)} FROM {tag}_{k})")
    return ",\n".join(ctes), f"{tag}_{p}"


def _coef(i: int, p: int) -> str:
    return f"a_{i}_{p} * s_{p} / s_{i}"


def _intercept(p: int) -> str:
    return f"m_{p} - (" + " + ".join(f"({_coef(i, p)}) * m_{i}" for i in range(p)) + ")"


def report_sql(model: str, features: list[str], labels: list[str]) -> str:
    """The whole report in SQL, on a table ``model`` that the given text defines."""
    p = len(features)
    ctes, selects = [], []
    sigma2 = f"(n * s_{p} * s_{p} * a_{p}_{p} / (n - {p} - 1))"
    r2 = f"1 - a_{p}_{p}"
    quadratic = " + ".join(
        f"m_{i} * m_{j} * -a_{i}_{j} / (n * s_{i} * s_{j})" for i in range(p) for j in range(p)
    )
    for label in labels:
        text, last = _sweep(features, label, f"fit_{label}")
        ctes.append(text)
        known = " AND ".join(f"{c} IS NOT NULL" for c in [*features, label])
        fitted = f"({_intercept(p)})" + "".join(
            f" + ({_coef(i, p)}) * {f}" for i, f in enumerate(features)
        )
        ctes.append(
            f"unseen_{label} AS (SELECT avg(({label} - ({fitted})) ** 2) AS mse, "
            f"var_pop({label}) AS var FROM model, {last} WHERE NOT in_train AND {known})"
        )
        tail = (
            f"round({r2}, 6) AS r2, round(1 - mse / var, 6) AS holdout_r2, "
            f"round(sqrt(mse), 6) AS holdout_rmse FROM {last}, unseen_{label}"
        )
        for i, f in enumerate(features):
            t = f"({_coef(i, p)}) / sqrt({sigma2} * -a_{i}_{i} / (n * s_{i} * s_{i}))"
            selects.append(
                f"SELECT '{label}' AS label, '{f}' AS term, round({_coef(i, p)}, 6) AS coef, "
                f"round({t}, 6) AS t_value, {tail}"
            )
        t = f"({_intercept(p)}) / sqrt({sigma2} * (1.0 / n + {quadratic}))"
        selects.append(
            f"SELECT '{label}' AS label, 'intercept' AS term, round({_intercept(p)}, 6) AS coef, "
            f"round({t}, 6) AS t_value, {tail}"
        )
    return f"{model}, " + ",\n".join(ctes) + "\n" + _UNION.join(selects)


def _predictions_sql(features: list[str], label: str) -> str:
    p = len(features)
    text, last = _sweep(features, label, "fit")
    fitted = f"({_intercept(p)})" + "".join(
        f" + ({_coef(i, p)}) * {f}" for i, f in enumerate(features)
    )
    known = " AND ".join(f"{f} IS NOT NULL" for f in features)
    return (
        f"{_MODEL_SQL}, {text}\nSELECT date, {label}, round({fitted}, 6) AS prediction "
        f"FROM model, {last} WHERE NOT in_train AND {known}"
    )


def _report(spark: SparkSession, sf_dir: str, features: list[str], labels: list[str]) -> DataFrame:
    report = ols_report(_model_table(spark, sf_dir), features, labels)
    numbers = ["coef", "t_value", "r2", "holdout_r2", "holdout_rmse"]
    return report.withColumns({c: F.round(c, 6) for c in numbers})


@query(report_sql(_MODEL_SQL, ["min_t"], ["crash"]))
def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, ["min_t"], ["crash"])


@query(report_sql(_MODEL_SQL, ["min_t", "max_t"], ["crash", "ppl_i"]))
def ols_two_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, ["min_t", "max_t"], ["crash", "ppl_i"])


@query(report_sql(_MODEL_SQL, FEATURES, LABELS))
def ols_report_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, FEATURES, LABELS)


@query(_predictions_sql(FEATURES, "crash"), name="holdout_predictions")
def predictions_on_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = holdout_predictions(_model_table(spark, sf_dir), FEATURES, "crash")
    return predictions.withColumn("prediction", F.round("prediction", 6))



_CORR_SQL = DAY_TABLES_SQL + _UNION.join(
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM features" for x in XS for y in YS)


@query(_CORR_SQL, name="corr_from_moments")
def correlations_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs from states by day, added up."""
    pairs = pair_models(XS, YS)
    state = moment_state(features(spark, sf_dir), pairs)
    return corr_from_moments(state, pairs).withColumn("r", F.round("r", 6))


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({c: F.round(c, 6) for c in ("coef", "t_value", "r2", "holdout_r2", "holdout_rmse")})


@query(report_sql(_MODEL_SQL, FEATURES, LABELS), name="ols_from_moments")
def report_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models, their training and their held-out scores from one aggregation."""
    state = moment_state(_model_table(spark, sf_dir), ols_models(FEATURES, LABELS))
    return _rounded(ols_from_moments(state, FEATURES, LABELS))


@query(report_sql(_MODEL_SQL, FEATURES, LABELS))
def ols_from_stored_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stored state that two loads have written, of odd and of even months."""
    path, models = scratch_folder(spark, "moments"), ols_models(FEATURES, LABELS)
    days = _model_table(spark, sf_dir)
    odd = F.month("date") % 2 == 1
    for mode, load in (("errorifexists", days.filter(odd)), ("append", days.filter(~odd))):
        write_table(moment_state(load, models), path, mode=mode)
    return _rounded(ols_from_moments(read_table(spark, path), FEATURES, LABELS))


@query("""
SELECT o_orderstatus AS status, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
       round(stddev_samp(o_totalprice), 4) AS stddev
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def spread_from_daily_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread of a fact column by group, from a state by day and group."""
    orders = table(spark, sf_dir, "orders").filter("o_orderdate IS NOT NULL")
    by = [F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("status")]
    origin = {"o_totalprice": 150_000.0}
    state = moment_state(orders, {"price": ["o_totalprice"]}, by, origin)
    spread = spread_from_moments(merge_moments(state, ["status"]))
    mean = F.round(F.col("mean") + origin["o_totalprice"], 4)
    return spread.select("status", "n", mean.alias("mean"), F.round("stddev", 4).alias("stddev"))
