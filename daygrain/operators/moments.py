"""Moments that are kept by day and added up: correlations, spreads and least squares without the rows.

A state has one row per group and model. It holds, over the rows where all columns of the model are
known, their number, the sum of each column and the sum of each product of two columns. States of
different rows are merged by adding them, so a day's state can be stored, replaced when the day's files
change, and combined with any other days. What is computed from a state is the size of the model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from daygrain.operators.regression import REPORT_SCHEMA, in_training

#: A column whose spread is explained by those before it up to this share depends on them.
DEPENDENT = 1e-11


def _sums(width: int) -> list[str]:
    products = [f"c_{i}_{j}" for i in range(width) for j in range(i, width)]
    return ["n", *(f"s_{i}" for i in range(width)), *products]


def moment_state(
    df: DataFrame,
    models: Mapping[str, Sequence[str]],
    by: Sequence[Column | str] = ("date",),
    origin: Mapping[str, float] | None = None,
) -> DataFrame:
    """``*by, model, n, s_0 …, c_0_0, c_0_1 …``: the state of each model in each group.

    Every model names its columns in order; shorter models leave the last sums at 0. Rows where a column
    of the model is unknown do not count for that model. ``origin`` is subtracted from a column first, to keep
    digits where a mean is large against the spread; states that are merged must share it.

    Rows are repeated once per model and combined within a task before the one shuffle, so a crowded group
    costs no more than others, and the plan does not grow with the number of models.
    """
    width = max(len(columns) for columns in models.values())
    origin = origin or {}

    def number(name: str) -> Column:
        return F.col(name).cast("double") - F.lit(float(origin.get(name, 0.0)))

    entries = []
    for model, columns in models.items():
        values = [number(c) for c in columns]
        known = values[0].isNotNull()
        for value in values[1:]:
            known = known & value.isNotNull()
        padded = [*values, *[F.lit(0.0)] * (width - len(values))]
        entries.append(
            F.when(
                known,
                F.struct(
                    F.lit(model).alias("model"), *[v.alias(f"v_{i}") for i, v in enumerate(padded)]
                ),
            )
        )
    groups = [F.col(b) if isinstance(b, str) else b for b in by]
    listed = F.filter(F.array(*entries), lambda e: e.isNotNull())
    rows = df.select(*groups, F.explode(listed).alias("entry"))
    values = [F.col(f"entry.v_{i}") for i in range(width)]
    sums = [F.count(F.lit(1)), *map(F.sum, values)]
    sums += [F.sum(values[i] * values[j]) for i in range(width) for j in range(i, width)]
    names = rows.columns[:-1]
    named = [s.alias(name) for s, name in zip(sums, _sums(width), strict=True)]
    return rows.groupBy(*names, F.col("entry.model").alias("model")).agg(*named)


def merge_moments(state: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """States added up over all rows that share ``by`` and the model."""
    sums = [c for c in state.columns if c == "n" or c.startswith(("s_", "c_"))]
    groups = [F.col(b) if isinstance(b, str) else b for b in by]
    return state.groupBy(*groups, "model").agg(*[F.sum(c).alias(c) for c in sums])


def spread_from_moments(state: DataFrame, column: int = 0) -> DataFrame:
    """``model, n, mean, stddev`` of one column of each model; the stddev of a single row is null.

    ``state`` may have further columns in front, which stay.
    """
    total, square = F.col(f"s_{column}"), F.col(f"c_{column}_{column}")
    left = F.greatest(square - total * total / F.col("n"), F.lit(0.0))
    kept = [c for c in state.columns if not (c == "n" or c.startswith(("s_", "c_")))]
    return state.select(
        *kept,
        "n",
        (total / F.col("n")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(left / (F.col("n") - 1))).alias("stddev"),
    )


def pair_models(xs: Sequence[str], ys: Sequence[str]) -> dict[str, tuple[str, str]]:
    """A model for every pair of columns."""
    return {f"{x}|{y}": (x, y) for x in xs for y in ys}


def corr_from_moments(state: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``x, y, r`` of every pair, from the merged states of ``pair_models``; constant columns have no r."""
    merged = merge_moments(state)
    n, x, y = F.col("n"), F.col("s_0"), F.col("s_1")
    own = [F.col(f"c_{i}_{i}") - s * s / n for i, s in enumerate((x, y))]
    # what is left of a constant is rounding of its squares
    apart = [d > F.lit(1e-13) * F.col(f"c_{i}_{i}") for i, d in enumerate(own)]
    r = (F.col("c_0_1") - x * y / n) / F.sqrt(own[0] * own[1])
    names = [F.create_map(*[F.lit(v) for m, p in pairs.items() for v in (m, p[i])]) for i in range(2)]
    return merged.select(
        F.element_at(names[0], F.col("model")).alias("x"),
        F.element_at(names[1], F.col("model")).alias("y"),
        F.when(apart[0] & apart[1], r).alias("r"),
    )


def _centred(row: Row, origin: Sequence[float]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, means, and the cross products about the means, which no origin changes."""
    width = len(origin)
    means = np.array([row[f"s_{i}"] for i in range(width)]) / row["n"]
    cross = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            cross[i, j] = cross[j, i] = row[f"c_{i}_{j}"] - row["n"] * means[i] * means[j]
    return row["n"], means + np.array(origin), cross


def _cholesky(matrix: np.ndarray, least: float = DEPENDENT) -> tuple[np.ndarray, list[int]]:
    """Lower factor of a correlation matrix over the columns that do not depend on those before them."""
    kept: list[int] = []
    factor = np.zeros((0, 0))
    for k in range(len(matrix)):
        row = np.zeros(len(kept))
        for i in range(len(kept)):
            row[i] = (matrix[k, kept[i]] - factor[i, :i] @ row[:i]) / factor[i, i]
        left = matrix[k, k] - row @ row
        if left > least:
            factor = np.block([[factor, np.zeros((len(kept), 1))], [row[None, :], np.sqrt([[left]])]])
            kept.append(k)
    return factor, kept


def solve_ols(train: Row | None, origin: Sequence[float]) -> dict | None:
    """Coefficients, their t-values and R² from the moments of the training rows; None without rows.

    The features come first and the label last, each with its origin. Cross products about the means are brought to unit
    diagonal and factored. A feature that depends on those before it has the coefficient 0 and no t-value.
    """
    if train is None or not train["n"]:
        return None
    features = len(origin) - 1
    n, means, cross = _centred(train, origin)
    spread = np.sqrt(np.maximum(np.diag(cross), 0))
    floor = 1e-13 * np.sqrt(np.array([abs(train[f"c_{i}_{i}"]) for i in range(features + 1)]))
    scale = np.where(spread > np.maximum(floor, 0), spread, 0)
    unit = np.divide(cross, np.outer(scale, scale), out=np.zeros_like(cross), where=np.outer(scale, scale) > 0)
    factor, kept = _cholesky(unit[:features, :features])
    inverse = np.linalg.inv(factor) if kept else np.zeros((0, 0))
    inverse = inverse.T @ inverse
    coefs, errors = np.zeros(features), np.full(features, np.nan)
    solved = inverse @ unit[kept, features]
    coefs[kept] = solved * spread[features] / scale[kept]
    rest = cross[features, features] * max(0.0, 1 - float(unit[kept, features] @ solved)) if scale[features] else 0.0
    free = n - len(kept) - 1
    intercept, intercept_error = means[features] - coefs @ means[:features], np.nan
    if free > 0:
        variance = rest / free
        errors[kept] = np.sqrt(variance * np.diag(inverse)) / scale[kept]
        ratio = means[kept] / scale[kept]
        intercept_error = np.sqrt(variance * (1 / n + ratio @ inverse @ ratio))
    values = [*coefs, intercept]
    ts = [v / e if e > 0 else None for v, e in zip(values, [*errors, intercept_error], strict=True)]
    r2 = float(1 - rest / cross[features, features]) if scale[features] else None
    return {"coefs": [float(v) for v in values], "t": [None if t is None else float(t) for t in ts], "r2": r2}


def held_out(model: dict, holdout: Row | None, origin: Sequence[float]) -> tuple[float | None, float | None]:
    """R² and root mean squared error of a model on other rows, from their moments."""
    if holdout is None or not holdout["n"]:
        return None, None
    features = len(origin) - 1
    n, means, cross = _centred(holdout, origin)
    slopes = np.array([*(-b for b in model["coefs"][:features]), 1.0])
    bias = float(slopes @ means) - model["coefs"][features]
    squares = max(0.0, float(slopes @ cross @ slopes)) + n * bias * bias
    total = cross[features, features]
    return (float(1 - squares / total) if total > 0 else None), float(np.sqrt(squares / n))


def ols_models(features: Sequence[str], labels: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """A model for every label on the same features."""
    return {label: (*features, label) for label in labels}


def ols_from_moments(
    state: DataFrame,
    features: Sequence[str],
    labels: Sequence[str],
    day: str = "date",
    seed: int = 0,
    origin: Mapping[str, float] | None = None,
) -> DataFrame:
    """The report of :func:`daygrain.operators.ols_report`, from states of ``ols_models`` by day.

    The states of training and held-out days are added up, two rows per label, and every number of the
    report follows from these: no row of data is read again, whatever the number of models.
    """
    parts = merge_moments(state, [in_training(day, seed=seed).alias("training")])
    rows = {(r["model"], r["training"]): r for r in parts.filter("training IS NOT NULL").collect()}
    width, origin = len(features), origin or {}
    report = []
    for label in labels:
        start = [float(origin.get(c, 0.0)) for c in (*features, label)]
        model = solve_ols(rows.get((label, True)), start)
        scores = (None, None) if model is None else held_out(model, rows.get((label, False)), start)
        model = model or {"coefs": [None] * (width + 1), "t": [None] * (width + 1), "r2": None}
        for term, coef, t in zip([*features, "intercept"], model["coefs"], model["t"], strict=True):
            report.append((label, term, coef, t, model["r2"], *scores))
    return state.sparkSession.createDataFrame(report, REPORT_SCHEMA)
