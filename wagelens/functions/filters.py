"""Filters with "all" sentinels and small scalar helpers used by the summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagelens import constants as C


def _values(selection) -> list | None:
    """None when the selection is empty or holds the 'all' sentinel."""
    if selection is None:
        return None
    if isinstance(selection, (str, int)):
        selection = [selection]
    values = list(selection)
    if not values or C.ALL in values or C.ALL_REGIONS in values:
        return None
    return values


def isin_unless_all(c: Column, selection: Iterable | None) -> Column:
    """Multi-valued filter; the sentinel (or nothing) disables it."""
    values = _values(selection)
    return F.lit(True) if values is None else c.isin(values)


def eq_unless_all(c: Column, value) -> Column:
    """Single-value filter with sentinel."""
    values = _values(value)
    return F.lit(True) if values is None else c == F.lit(values[0])


def not_null_all(columns: Iterable[str]) -> Column:
    """Drop-nulls over every listed column (NaN is not NULL, as in the source frames)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def sex_code(sexo: Column) -> Column:
    """0 for men, 1 for every other label (NULL included)."""
    return F.when(sexo == C.MEN, F.lit(0)).otherwise(F.lit(1))


def year_of(d: Column) -> Column:
    return F.year(d)


def year_from_text(s: Column) -> Column:
    """First four characters of an ISO date string, as INT (strict cast)."""
    return F.substring(s, 1, 4).cast("int")


def kpi_format(c: Column, decimals: int = 2) -> Column:
    """Fixed-decimal text with thousands separators ("12,345.67")."""
    return F.format_number(c, decimals)
