"""Numbers out of text, rates and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_number(
    text: Column | str, marks: Mapping[str, str] | None = None, to: str = "double"
) -> Column:
    """Text to number after replacing marks such as a trace sign; bad or empty text is null."""
    c = _col(text)
    value = c
    for mark, number in (marks or {}).items():
        value = F.when(c == mark, number).otherwise(value)
    return value.try_cast(to)


def steady_round(value: Column | str, places: int = 0) -> Column:
    """Round half up, the same way whatever the order in which tasks added up.

    A mean that is exactly half-way may come out a few units in the last place
    above or below; a first rounding to six more places removes that.
    """
    return F.round(F.round(_col(value), places + 6), places)


def rate(
    total: Column | str, days: Column | str, places: int = 0, whole: bool = False
) -> Column:
    """Total per day, rounded half up; null where there is no day.

    With ``whole`` both are whole numbers, and the quotient is rounded once and
    exactly, in whole numbers; otherwise see :func:`steady_round`.
    """
    if not whole:
        return steady_round(F.try_divide(_col(total), _col(days)), places)
    t = _col(total).cast("decimal(20,0)")
    d = F.nullif(_col(days).cast("decimal(12,0)"), F.lit(0).cast("decimal(12,0)"))
    scaled = F.call_function("div", F.abs(t) * F.lit(2 * 10**places) + d, d * F.lit(2))
    return scaled * F.signum(t.cast("double")) / F.lit(10**places)


def total_of(cols: Sequence[str]) -> Column:
    """Sum over the columns of a row; null as soon as one of them is."""
    return reduce(add, map(F.col, cols))


def share(part: str, of: Sequence[str]) -> Column:
    """Part of the row total, in percent; null where the total is 0."""
    return F.try_divide(F.col(part), total_of(of)) * 100
