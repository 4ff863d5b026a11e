"""Series-name parsing, period mapping and label rules as Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagelens import constants as C

# Python's str.strip() whitespace: the Unicode White_Space set plus the
# information separators U+001C..U+001F.  Spark's trim removes spaces only.
_WS = r"[\s\x{1c}-\x{1f}]"
_EDGE_WS = rf"(?U)^{_WS}+|{_WS}+$"
_DOT_WS = rf"(?U){_WS}*\.{_WS}*"


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace like Python's ``str.strip()``."""
    return F.regexp_replace(c, _EDGE_WS, "")


def name_parts(nombre: Column) -> Column:
    """Split a series name on '.', strip every part and drop the empty ones.

    Stripping every part equals removing the whitespace next to each dot and
    at both ends of the name, so no per-element lambda is needed (built-ins
    only, inside whole-stage codegen).
    """
    tight = strip_ws(F.regexp_replace(nombre, _DOT_WS, "."))
    return F.array_remove(F.split(tight, r"\.", -1), "")


def period_month(fk: Column) -> Column:
    """Period code -> month: quarter codes map to their first month, else January."""
    expr = None
    for code, month in C.PERIOD_MONTH.items():
        expr = (F.when(fk == code, F.lit(month)) if expr is None else expr.when(fk == code, F.lit(month)))
    return expr.otherwise(F.lit(1))


def period_date(anyo: Column, fk: Column) -> Column:
    """First day of the mapped month of the given year."""
    return F.make_date(anyo, period_month(fk), F.lit(1))


def price_category(categoria: Column) -> Column:
    """Any category containing 'general' (any case) becomes the general index."""
    return (F.when(F.lower(categoria).contains(C.GENERAL_WORD), F.lit(C.GENERAL_CATEGORY))
            .otherwise(categoria))


def wage_geography(geografia: Column) -> Column:
    """Wages only: missing -> national total, 'España' -> national total."""
    g = F.coalesce(geografia, F.lit(C.NATIONAL_TOTAL))
    return F.when(g == C.SPAIN, F.lit(C.NATIONAL_TOTAL)).otherwise(g)


def packed_ordinal(rank: Column, series_pos: Column, data_pos: Column | None) -> Column:
    """One DECIMAL(38, 0) load ordinal: rank, series position, datum position + 1, each in its own digits.

    The digits hold any BIGINT series position and any array position, so no
    row is ever rejected for where it stands.  ``data_pos`` None gives the
    series-level ordinal (creation of geography and indicator happens before
    the series' data).  A single number keeps the first-row-wins aggregate a
    hash aggregate with map-side partials.
    """
    series = series_pos.cast("decimal(20,0)") + F.lit(Decimal(10) ** C.SERIES_DIGITS)
    base = (rank.cast("decimal(2,0)") * F.lit(Decimal(10) ** C.RANK_DIGITS)
            + series * F.lit(Decimal(10) ** C.DATUM_DIGITS))
    datum = F.lit(Decimal(0)) if data_pos is None else data_pos.cast("decimal(20,0)") + F.lit(Decimal(1))
    return (base + datum).cast("decimal(38,0)")
