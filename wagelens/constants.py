"""Fixed values the results depend on.

Everything in the first block must equal the behaviour being reproduced:
source codes, their load order, name layouts, label defaults, the period
code -> month map and the 19 map coordinates.  They are stated here once, in
natural order, and used everywhere else by name.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must not change: results depend on them)
# --------------------------------------------------------------------------

# Statistics-office table codes.
IPC = 50913
IPV = 25171
ETCL = 6061
EAES_PERCENTILES = 28191
EAES_OCUPACION = 28186
TASA_PARO = 65334
TEMPORALIDAD = 65132

# Load order of the sources (first row wins across them in this order).
LOAD_ORDER = [IPC, IPV, TASA_PARO, TEMPORALIDAD, EAES_OCUPACION, EAES_PERCENTILES, ETCL]

# Families and fact targets.
PRICES, WAGES, EMPLOYMENT = "precios", "salarios", "empleo"
TARGET = {PRICES: "T_precios", WAGES: "T_salarios", EMPLOYMENT: "T_empleo"}

# code -> (family, indicator name, unit)
SOURCES = {
    IPC: (PRICES, "IPC Indice", "Índice"),
    IPV: (PRICES, "IPV Indice", "Índice"),
    TASA_PARO: (EMPLOYMENT, "Tasa_Paro", "%"),
    TEMPORALIDAD: (EMPLOYMENT, "Temporalidad", "%"),
    EAES_OCUPACION: (WAGES, "Salario_Anual_Ocupacion", "Euros"),
    EAES_PERCENTILES: (WAGES, "Salario_Anual_Ocupacion", "Euros"),
    ETCL: (WAGES, "Salario_Anual_Ocupacion", "Euros"),
}

# Series-name layouts: zero-based position of each metadata field among the
# non-empty, stripped, dot-separated parts of the series name.
LAYOUTS = {
    TASA_PARO: {"sexo": 1, "geografia": 2, "grupo_edad": 3},
    TEMPORALIDAD: {"geografia": 0, "sexo": 2, "tipo_contrato": 3, "tipo_jornada": 4},
    IPC: {"geografia": 0, "categoria": 1, "tipo_dato": 2},
    IPV: {"geografia": 0, "categoria": 1, "tipo_dato": 2},
    ETCL: {"geografia": 0, "sector": 1, "indicador": 2},
    EAES_OCUPACION: {"ocupacion": 0, "sexo": 1, "geografia": 2},
    EAES_PERCENTILES: {"sexo": 0, "geografia": 1, "indicador": 3},
}

# Union of all layout fields (fixed nullable columns, not a map).
META_FIELDS = [
    "geografia", "sexo", "grupo_edad", "tipo_contrato", "tipo_jornada",
    "categoria", "tipo_dato", "sector", "indicador", "ocupacion",
]

# Period code -> month; every other code becomes January.
PERIOD_MONTH = {19: 1, 20: 4, 21: 7, 22: 10}

# Labels and defaults.
GENERAL_WORD = "general"          # case-insensitive substring of a price category
GENERAL_CATEGORY = "IPC General"
INDEX_WORD = "Indice"             # substring of both price indicator names
NATIONAL_TOTAL = "Total Nacional"
SPAIN = "España"
DEFAULT_WAGE_SEX = "Ambos"
DEFAULT_OCCUPATION = "Total"
TOTAL = "Total"
NOT_AVAILABLE = "N/A"
MEN = "Hombres"
UNEMPLOYMENT = "Tasa_Paro"
ALL = "Todos"                      # "all" sentinel of the dashboard filters
ALL_REGIONS = "Todas"              # "all" sentinel of the app region filter

# Map coordinates, region -> (lat, lon), 19 entries.
COORDINATES = {
    "Andalucía": (37.38, -5.98),
    "Aragón": (41.65, -0.88),
    "Asturias, Principado de": (43.36, -5.84),
    "Balears, Illes": (39.57, 2.65),
    "Canarias": (28.29, -16.62),
    "Cantabria": (43.46, -3.80),
    "Castilla y León": (41.65, -4.72),
    "Castilla - La Mancha": (39.86, -4.02),
    "Cataluña": (41.38, 2.17),
    "Comunitat Valenciana": (39.47, -0.37),
    "Extremadura": (38.92, -6.34),
    "Galicia": (42.87, -8.54),
    "Madrid, Comunidad de": (40.41, -3.70),
    "Murcia, Región de": (37.99, -1.13),
    "Navarra, Comunidad Foral de": (42.81, -1.64),
    "País Vasco": (42.84, -2.67),
    "Rioja, La": (42.46, -2.44),
    "Ceuta": (35.88, -5.31),
    "Melilla": (35.29, -2.93),
}

# Model settings: 80/20 split, fixed seed; forests; k-means.
TEST_FRACTION = 0.2
SEED = 42
KMEANS_K = 4
KMEANS_RESTARTS = 10

# --------------------------------------------------------------------------
# Derived (computed from the fixed values above)
# --------------------------------------------------------------------------

SOURCE_RANK = {code: rank for rank, code in enumerate(LOAD_ORDER)}
REQUIRED_PARTS = {code: max(layout.values()) + 1 for code, layout in LAYOUTS.items()}

# Load ordinal: rank, then series position (shifted to be positive), then datum position + 1, in decimal digits.
RANK_DIGITS = 30
DATUM_DIGITS = 10
SERIES_DIGITS = 19
