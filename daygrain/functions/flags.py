"""Boolean conditions and the two-way severity class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrain.fixed_values import NOT_SEVERE, SEVERE
from daygrain.functions.text import tokens


def flag_from_code(text: Column | str, code: str, match: str = "contains") -> Column:
    """True if the text names the code; no text means false.

    ``contains`` also accepts compound codes, so freezing rain counts as rain;
    ``token`` wants the code as a word of its own.
    """
    c = F.col(text) if isinstance(text, str) else text
    if match == "contains":
        hit = c.contains(code)
    elif match == "token":
        hit = F.array_contains(tokens(c, None), code)
    else:
        raise ValueError(f"match must be 'contains' or 'token', not {match!r}")
    return F.coalesce(hit, F.lit(False))


def any_of(conditions: Sequence[Column]) -> Column:
    """True if one of the conditions is; an unknown condition counts as false."""
    known = [F.coalesce(c, F.lit(False)) for c in conditions]
    out = known[0]
    for c in known[1:]:
        out = out | c
    return out


def severity(conditions: Sequence[Column]) -> Column:
    """Class of a row: severe if one of the conditions holds."""
    return F.when(any_of(conditions), SEVERE).otherwise(NOT_SEVERE)
