"""Text clean-up, recoding and tokens."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_text(text: Column | str) -> Column:
    """Trimmed and in capitals."""
    return F.upper(F.trim(_col(text)))


def recode(value: Column | str, names: Mapping[str, str]) -> Column:
    """Replace known values; the others stay as they are."""
    c = _col(value)
    return F.coalesce(_lookup(c, names), c)


def describe_code(code: Column | str, descriptions: Mapping[str, str]) -> Column:
    """Description of a code; a code without one is its own description."""
    return recode(code, descriptions)


def tokens(text: Column | str, sep: str | None = " ") -> Column:
    """Array of tokens.

    ``sep`` is taken literally; ``None`` splits on runs of white space. Either
    may leave empty tokens, which are cheaper to filter once they are rows.
    """
    return F.split(_col(text), r"\s+" if sep is None else "\\Q" + sep + "\\E")


def _lookup(c: Column, names: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.element_at(F.create_map(*pairs), c)
