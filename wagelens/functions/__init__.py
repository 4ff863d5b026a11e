"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from wagelens.functions.series import (  # noqa: F401
    name_parts, strip_ws, period_month, period_date, price_category,
    wage_geography, packed_ordinal,
)
from wagelens.functions.filters import (  # noqa: F401
    isin_unless_all, eq_unless_all, not_null_all, sex_code, year_of, year_from_text,
    kpi_format,
)
