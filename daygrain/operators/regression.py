"""Least-squares models on day tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import UnsupportedOperationException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.fixed_values import HOLDOUT_PARTS, TRAIN_PARTS
from daygrain.sources import scratch_copy, written

REPORT_SCHEMA = (
    "label string, term string, coef double, t_value double, "
    "r2 double, holdout_r2 double, holdout_rmse double"
)


def in_training(
    day: str, train: int = TRAIN_PARTS, holdout: int = HOLDOUT_PARTS, seed: int = 0
) -> Column:
    """Does the day belong to the training part? Decided by a hash of day and seed.

    Days are scattered, so that neighbours fall on either side. The same day always
    falls on the same side, whatever the partitioning, so a task that runs again
    cannot move a row to the other side.
    """
    digest = F.md5(F.concat(F.col(day).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(train + holdout)) < train


def split_by_day(
    df: DataFrame,
    day: str = "date",
    train: int = TRAIN_PARTS,
    holdout: int = HOLDOUT_PARTS,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows, see :func:`in_training`; rows without a day are in neither."""
    chosen = in_training(day, train, holdout, seed)
    return df.filter(chosen), df.filter(~chosen)


def random_split(
    df: DataFrame, seed: int, train: int = TRAIN_PARTS, holdout: int = HOLDOUT_PARTS
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows at random, repeatable for one seed and partitioning.

    Each side reads the frame on its own: give it one from :func:`daygrain.sources.written`.
    """
    first, second = df.randomSplit([float(train), float(holdout)], seed)
    return first, second


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vector column; rows with an unknown feature are left out."""
    return VectorAssembler(
        inputCols=list(features), outputCol=output, handleInvalid="skip"
    ).transform(df)


def fit_ols(train: DataFrame, label: str, features: str = "features") -> LinearRegressionModel:
    """Least squares with intercept, solved exactly from the moments of the training rows."""
    return LinearRegression(
        featuresCol=features, labelCol=label, solver="normal", regParam=0.0
    ).fit(train.filter(F.col(label).isNotNull()))


def _parts(df: DataFrame, day: str, split: str, seed: int) -> tuple[DataFrame, DataFrame]:
    if split not in ("day", "random"):
        raise ValueError(f"split must be 'day' or 'random', not {split!r}")
    return split_by_day(df, day, seed=seed) if split == "day" else random_split(df, seed)


def ols_report(
    df: DataFrame,
    features: Sequence[str],
    labels: Sequence[str],
    day: str = "date",
    split: str = "day",
    seed: int = 0,
) -> DataFrame:
    """Models of all labels on the same features and the same training days.

    One row per label and term, the intercept last: coefficient, t-value, R² in
    training, R² and root mean squared error on the held-out days, null if there are
    none. ``split="day"`` decides by a hash of the day, ``"random"`` row by row. Runs
    the fits; the rows are model size.

    The columns the models need are first written to the shared scratch folder,
    so that neither the fits nor a lost executor go back to the events. What is
    read from there is kept in memory until the last fit, and then removed.
    """
    columns = df.select(*dict.fromkeys([day, *features, *labels]))
    with scratch_copy(columns, "model-days") as days:
        data = assemble(days, features).select(day, "features", *labels)
        data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            train, holdout = _parts(data, day, split, seed)
            rows = []
            for label in labels:
                model = fit_ols(train, label)
                known = holdout.filter(F.col(label).isNotNull())
                unseen = None if known.isEmpty() else model.evaluate(known)
                held_out = (unseen.r2, unseen.rootMeanSquaredError) if unseen else (None, None)
                coefs = [*map(float, model.coefficients), float(model.intercept)]
                ts = _t_values(model, len(coefs))
                for term, coef, t in zip([*features, "intercept"], coefs, ts, strict=True):
                    rows.append((label, term, coef, t, model.summary.r2, *held_out))
        finally:
            data.unpersist()
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def holdout_predictions(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    day: str = "date",
    split: str = "day",
    seed: int = 0,
) -> DataFrame:
    """Label and prediction for every held-out day; runs the fit on a written copy of the days."""
    days = written(df.select(*dict.fromkeys([day, *features, label])), "model-days")
    train, holdout = _parts(assemble(days, features), day, split, seed)
    return fit_ols(train, label).transform(holdout).select(day, label, "prediction")


def _t_values(model: LinearRegressionModel, n: int) -> list[float | None]:
    # Unknown if the features depend on each other: the exact solution then has no spread.
    try:
        return [float(t) for t in model.summary.tValues]
    except UnsupportedOperationException:
        return [None] * n
