"""Schemas of the payload, the star schema and the read frames."""

from __future__ import annotations

from pyspark.sql import types as T

# One statistics-office payload: a list of series, each with a name and data.
DATUM = T.StructType([
    T.StructField("Anyo", T.IntegerType()),
    T.StructField("FK_Periodo", T.IntegerType()),
    T.StructField("Valor", T.StringType()),  # text, so a value that is no number is seen and rejected
])
SERIES = T.StructType([
    T.StructField("Nombre", T.StringType()),
    T.StructField("Data", T.ArrayType(DATUM)),
])
PAYLOAD = T.ArrayType(SERIES)

# Exploded payload: one row per datum (data_pos NULL for a series without data).
OBSERVATIONS = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("series_pos", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("data_pos", T.LongType()),
    T.StructField("anyo", T.IntegerType()),
    T.StructField("fk_periodo", T.IntegerType()),
    T.StructField("valor", T.DoubleType()),
])

# Star schema (surrogate fact ids are dropped: no read uses them).
TBL_PERIODO = T.StructType([
    T.StructField("id_periodo", T.LongType(), False),
    T.StructField("anio", T.IntegerType(), False),
    T.StructField("trimestre", T.IntegerType()),
    T.StructField("mes", T.IntegerType()),
    T.StructField("fecha_iso", T.DateType(), False),
])
TBL_INDICADOR = T.StructType([
    T.StructField("id_indicador", T.LongType(), False),
    T.StructField("nombre", T.StringType(), False),
    T.StructField("unidad", T.StringType()),
])
TBL_GEOGRAFIA = T.StructType([
    T.StructField("id_geografia", T.LongType(), False),
    T.StructField("nombre", T.StringType(), False),
])
_IDS = [
    T.StructField("id_periodo", T.LongType(), False),
    T.StructField("id_indicador", T.LongType(), False),
    T.StructField("id_geografia", T.LongType(), False),
]
T_PRECIOS = T.StructType(_IDS + [
    T.StructField("categoria_gasto", T.StringType(), False),
    T.StructField("valor", T.DoubleType(), False),
])
T_SALARIOS = T.StructType(_IDS + [
    T.StructField("sexo", T.StringType()),
    T.StructField("sector_cnae", T.StringType()),
    T.StructField("ocupacion_cno11", T.StringType()),
    T.StructField("valor", T.DoubleType(), False),
])
T_EMPLEO = T.StructType(_IDS + [
    T.StructField("sexo", T.StringType(), False),
    T.StructField("grupo_edad", T.StringType()),
    T.StructField("tipo_jornada", T.StringType()),
    T.StructField("tipo_contrato", T.StringType()),
    T.StructField("valor", T.DoubleType(), False),
])

TABLES = {
    "tbl_periodo": TBL_PERIODO,
    "tbl_indicador": TBL_INDICADOR,
    "tbl_geografia": TBL_GEOGRAFIA,
    "T_precios": T_PRECIOS,
    "T_salarios": T_SALARIOS,
    "T_empleo": T_EMPLEO,
}

# The year of a fact's period: a folder of the stored facts, derived at load; it follows from id_periodo, so it is part of no key.
FACT_YEAR = "anio_hecho"


class UnknownTable(KeyError):
    """A load or a read names a table that is none of the star schema's."""

    def __str__(self) -> str:
        return f"the table {self.args[0]!r} does not exist; the tables are {', '.join(TABLES)}"


# Unique keys of the facts (insert-or-ignore targets).
FACT_KEYS = {
    "T_precios": ["id_periodo", "id_indicador", "id_geografia", "categoria_gasto"],
    "T_salarios": ["id_periodo", "id_indicador", "id_geografia", "sexo", "sector_cnae", "ocupacion_cno11"],
    "T_empleo": ["id_periodo", "id_indicador", "id_geografia", "sexo", "grupo_edad", "tipo_jornada", "tipo_contrato"],
}
# Columns declared NOT NULL besides the ids: rows with NULL here are skipped.
FACT_NOT_NULL = {
    "T_precios": ["categoria_gasto", "valor"],
    "T_salarios": ["valor"],
    "T_empleo": ["sexo", "valor"],
}

GOLD_COLUMNS = [
    "valor_salario", "sexo", "sector_cnae", "ocupacion_cno11", "fecha_iso",
    "indicador_salario", "comunidad", "valor_ipc", "categoria_gasto", "indicador",
    "ratio_poder_adquisitivo", "valor_empleo", "indicador_empleo",
]
