"""Ingestion: exploded payload -> parsed rows -> star schema (dims + facts).

The reference walks payloads series by series, datum by datum, looking up or
creating dimension rows one at a time.  Here the whole payload is one
DataFrame; routing is a broadcast join with the 7-row source registry, name
layouts are ``get(parts, position)`` with positions from the registry, and
loading is the set-based first-row-wins of ``operators.dedup``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens import constants as C
from wagelens import schemas as S
from wagelens.functions.series import (
    name_parts, packed_ordinal, period_date, period_month, price_category, wage_geography,
)
from wagelens.operators.dedup import first_wins, insert_or_ignore
from wagelens.operators.dimensions import first_appearance, max_id, new_members

REJECT_COLUMNS = ["code", "series_pos", "nombre", "data_pos", "anyo", "fk_periodo", "reason"]


def registry(spark: SparkSession) -> DataFrame:
    """The 7 sources: family, indicator, unit, target, load rank, layout positions."""
    fields = [
        T.StructField("code", T.IntegerType(), False),
        T.StructField("source_rank", T.IntegerType(), False),
        T.StructField("family", T.StringType(), False),
        T.StructField("reg_indicador", T.StringType(), False),
        T.StructField("reg_unidad", T.StringType(), False),
        T.StructField("target", T.StringType(), False),
        T.StructField("required_parts", T.IntegerType(), False),
    ] + [T.StructField(f"pos_{f}", T.IntegerType()) for f in C.META_FIELDS]
    rows = []
    for code in C.LOAD_ORDER:
        family, indicador, unidad = C.SOURCES[code]
        layout = C.LAYOUTS[code]
        rows.append((code, C.SOURCE_RANK[code], family, indicador, unidad, C.TARGET[family],
                     C.REQUIRED_PARTS[code], *[layout.get(f) for f in C.META_FIELDS]))
    return spark.createDataFrame(rows, T.StructType(fields))


@dataclass
class Parsed:
    rows: DataFrame      # accepted rows (series-level rows have has_datum = false)
    rejects: DataFrame   # code, series_pos, nombre, data_pos, anyo, fk_periodo, reason


ROW_COLUMNS = [
    "code", "series_pos", "nombre", "data_pos", "anyo", "fk_periodo", "valor", "family", "target", "indicador",
    "unidad", "n_parts", *[f"meta_{f}" for f in C.META_FIELDS], "has_datum", "series_ord", "ord", "fecha_iso",
    "mes", "trimestre", "geografia", "categoria_gasto", "sexo", "sector_cnae", "ocupacion_cno11", "grupo_edad",
    "tipo_jornada", "tipo_contrato",
]


def annotate(obs: DataFrame) -> DataFrame:
    """Every payload row with its parsed columns and reject reasons (one pass).

    Reject reasons: ``unreadable_file`` (a landed file that is no payload),
    ``unknown_code`` (no registry entry), ``short_name`` (fewer name parts than
    the layout needs; the reference raises and stops), ``null_year`` /
    ``bad_year`` (datum only; the reference aborts the run), ``bad_value`` (a
    datum's value is text that is no number).
    """
    for flag in ("unreadable", "bad_value"):  # landed payloads carry them
        if flag not in obs.columns:
            obs = obs.withColumn(flag, F.lit(False))
    spark = obs.sparkSession
    reg = F.broadcast(registry(spark))  # fixed 7 rows
    # a series without a name parses as "" (no parts), as a missing name does in the source
    x = obs.join(reg, "code", "left").withColumn("parts", name_parts(F.coalesce(F.col("nombre"), F.lit(""))))
    series_reason = (
        F.when(F.col("unreadable"), F.lit("unreadable_file"))
        .when(F.col("family").isNull(), F.lit("unknown_code"))
        .when(F.size("parts") < F.col("required_parts"), F.lit("short_name"))
    )
    datum_reason = (
        F.when(F.col("data_pos").isNull(), F.lit(None).cast("string"))
        .when(F.col("anyo").isNull(), F.lit("null_year"))
        .when((F.col("anyo") < 1) | (F.col("anyo") > 9999), F.lit("bad_year"))
        .when(F.col("bad_value"), F.lit("bad_value"))
    )
    x = x.withColumn("series_reason", series_reason).withColumn("datum_reason", datum_reason)
    meta = {f: F.get(F.col("parts"), F.col(f"pos_{f}")) for f in C.META_FIELDS}
    fam = F.col("family")
    wages, prices, employment = fam == C.WAGES, fam == C.PRICES, fam == C.EMPLOYMENT
    ocupacion = F.coalesce(meta["ocupacion"], F.lit(C.DEFAULT_OCCUPATION))
    has_datum = (F.col("series_reason").isNull() & F.col("data_pos").isNotNull()
                 & F.col("datum_reason").isNull())
    return x.select(
        "code", "series_pos", "nombre", "data_pos", "anyo", "fk_periodo", "valor",
        "family", "target", F.col("reg_indicador").alias("indicador"), F.col("reg_unidad").alias("unidad"),
        F.size("parts").alias("n_parts"),
        *[meta[f].alias(f"meta_{f}") for f in C.META_FIELDS],
        has_datum.alias("has_datum"),
        packed_ordinal(F.col("source_rank"), F.col("series_pos"), None).alias("series_ord"),
        F.when(has_datum, packed_ordinal(F.col("source_rank"), F.col("series_pos"), F.col("data_pos")))
        .alias("ord"),
        F.when(has_datum, period_date(F.col("anyo"), F.col("fk_periodo"))).alias("fecha_iso"),
        F.when(has_datum, period_month(F.col("fk_periodo"))).alias("mes"),
        F.when(has_datum, F.col("fk_periodo")).alias("trimestre"),
        F.when(wages, wage_geography(meta["geografia"]))
        .otherwise(F.coalesce(meta["geografia"], F.lit(C.NATIONAL_TOTAL))).alias("geografia"),
        F.when(prices, price_category(meta["categoria"])).alias("categoria_gasto"),
        F.when(wages, F.coalesce(meta["sexo"], F.lit(C.DEFAULT_WAGE_SEX)))
        .when(employment, meta["sexo"]).alias("sexo"),
        F.when(wages, F.coalesce(meta["sector"], ocupacion)).alias("sector_cnae"),
        F.when(wages, ocupacion).alias("ocupacion_cno11"),
        F.when(employment, meta["grupo_edad"]).alias("grupo_edad"),
        F.when(employment, meta["tipo_jornada"]).alias("tipo_jornada"),
        F.when(employment, meta["tipo_contrato"]).alias("tipo_contrato"),
        "series_reason", "datum_reason",
    )


def split(annotated: DataFrame) -> Parsed:
    """Accepted rows (series not rejected) and reject rows of an annotated payload."""
    rows = annotated.where(F.col("series_reason").isNull()).select(*ROW_COLUMNS)
    rejects = (annotated.where(F.col("series_reason").isNotNull() | F.col("datum_reason").isNotNull())
               .select("code", "series_pos", "nombre", "data_pos", "anyo", "fk_periodo",
                       F.coalesce("series_reason", "datum_reason").alias("reason")))
    return Parsed(rows=rows, rejects=rejects)


def parse(obs: DataFrame, raise_on_reject: bool = False) -> Parsed:
    """Route, parse series names and map periods; rejects instead of aborting.

    ``raise_on_reject=True`` turns any reject into an error, as the reference
    stops on a short name or a missing year.
    """
    parsed = split(annotate(obs))
    if raise_on_reject:
        check_rejects(parsed.rejects)
    return parsed


def check_rejects(rejects: DataFrame) -> None:
    first = rejects.first()
    if first is not None:
        raise ValueError(f"payload rejected: {first.asDict()}")


@dataclass
class Star:
    periodo: DataFrame
    indicador: DataFrame
    geografia: DataFrame
    precios: DataFrame
    salarios: DataFrame
    empleo: DataFrame
    empty: bool = False

    def table(self, name: str) -> DataFrame | None:
        """A table with the columns of its schema (stored facts also carry their year, see ``gold``)."""
        found = {
            "tbl_periodo": self.periodo, "tbl_indicador": self.indicador, "tbl_geografia": self.geografia,
            "T_precios": self.precios, "T_salarios": self.salarios, "T_empleo": self.empleo,
        }
        if name not in found:
            raise S.UnknownTable(name)
        return None if found[name] is None else found[name].select(*S.TABLES[name].fieldNames())

    def union(self, other: "Star") -> "Star":
        """Table-wise union (None tables of ``other`` keep this side's table)."""
        if self.empty:
            return other
        out = []
        for n in S.TABLES:
            mine, theirs = self.table(n), other.table(n)
            out.append(mine if theirs is None else mine.unionByName(theirs))
        return Star(*out)


def empty_star(spark: SparkSession) -> Star:
    return Star(*[spark.createDataFrame([], schema) for schema in S.TABLES.values()], empty=True)


_FACT_ATTRS = {
    "T_precios": ["categoria_gasto"],
    "T_salarios": ["sexo", "sector_cnae", "ocupacion_cno11"],
    "T_empleo": ["sexo", "grupo_edad", "tipo_jornada", "tipo_contrato"],
}


def new_dimensions(rows: DataFrame, stored: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New (periodo, indicador, geografia) members of one load, numbered after the stored ones.

    Geography and indicator are created per series (even with no data),
    periods per datum: their first-appearance ordinals differ.
    """
    known_empty = stored.empty
    geo_first = first_appearance(rows, F.col("geografia"), "nombre", F.col("series_ord"))
    # the unit belongs to the indicator: taken from the registry (7 rows) after the aggregate
    units = {indicador: unidad for _, indicador, unidad in reversed([C.SOURCES[c] for c in C.LOAD_ORDER])}
    unit_rows = rows.sparkSession.createDataFrame(list(units.items()), "nombre string, unidad string")
    ind_first = (first_appearance(rows, F.col("indicador"), "nombre", F.col("series_ord"))
                 .join(F.broadcast(unit_rows), "nombre", "left"))
    per_first = first_appearance(rows.filter("has_datum"), F.col("fecha_iso"), "fecha_iso", F.col("ord"),
                                 {"anio": F.col("anyo"), "mes": F.col("mes"), "trimestre": F.col("trimestre")})
    new_geo = new_members(geo_first, stored.geografia, "nombre", "nombre", "id_geografia",
                          max_id(stored.geografia, "id_geografia", known_empty))
    new_ind = new_members(ind_first, stored.indicador, "nombre", "nombre", "id_indicador",
                          max_id(stored.indicador, "id_indicador", known_empty))
    new_per = new_members(per_first, stored.periodo, "fecha_iso", "fecha_iso", "id_periodo",
                          max_id(stored.periodo, "id_periodo", known_empty))
    d_per = new_per.select("id_periodo", F.col("anio").cast("int").alias("anio"),
                           F.col("trimestre").cast("int").alias("trimestre"),
                           F.col("mes").cast("int").alias("mes"), "fecha_iso")
    d_ind = new_ind.select(*S.TBL_INDICADOR.fieldNames())
    d_geo = new_geo.select(*S.TBL_GEOGRAFIA.fieldNames())
    return d_per, d_ind, d_geo


def new_facts(rows: DataFrame, dims: Star, stored: Star, null_keys_conflict: bool = False,
              years: bool = False) -> dict[str, DataFrame]:
    """New fact rows of one load: first row wins per key, stored keys ignored.

    ``dims`` must hold every dimension member the rows refer to (stored + new).
    A datum gives at most one row; a NULL value or NOT NULL column skips it.
    ``years`` adds the year of the period, which follows from the key.
    """
    data = rows.filter(F.col("has_datum") & F.col("valor").isNotNull())
    data = (
        data.join(dims.periodo.select("id_periodo", "fecha_iso"), "fecha_iso")
        .join(dims.indicador.select("id_indicador", F.col("nombre").alias("indicador")), "indicador")
        .join(dims.geografia.select("id_geografia", F.col("nombre").alias("geografia")), "geografia")
    )
    facts = {}
    for table in _FACT_ATTRS:
        part = data.filter(F.col("target") == table)
        for c in S.FACT_NOT_NULL[table]:
            part = part.filter(F.col(c).isNotNull())
        keys, more = S.FACT_KEYS[table], [S.FACT_YEAR] if years else []
        part = part.withColumn(S.FACT_YEAR, F.year("fecha_iso")).select(*keys, *more, "valor", "ord")
        firsts = first_wins(part, [*keys, *more], ["valor"], null_keys_conflict=null_keys_conflict)
        if not stored.empty:
            firsts = insert_or_ignore(firsts, stored.table(table), keys, null_keys_conflict)
        facts[table] = firsts.select(*S.TABLES[table].fieldNames(), *more)
    return facts


def load_delta(parsed: Parsed | DataFrame, stored: Star, null_keys_conflict: bool = False) -> Star:
    """New dimension members and new fact rows of one load against ``stored`` (lazy).

    The result holds only what an insert-or-ignore load would add; the stored
    tables plus this delta are the tables after the load.
    """
    rows = parsed.rows if isinstance(parsed, Parsed) else parsed
    d_per, d_ind, d_geo = new_dimensions(rows, stored)
    dims = stored.union(Star(d_per, d_ind, d_geo, *([None] * 3)))
    facts = new_facts(rows, dims, stored, null_keys_conflict)
    return Star(d_per, d_ind, d_geo, facts["T_precios"], facts["T_salarios"], facts["T_empleo"])


def build_star(parsed: Parsed | DataFrame, stored: Star | None = None, null_keys_conflict: bool = False) -> Star:
    """Tables after loading ``parsed`` on top of ``stored`` (empty by default)."""
    spark = (parsed.rows if isinstance(parsed, Parsed) else parsed).sparkSession
    stored = stored or empty_star(spark)
    return stored.union(load_delta(parsed, stored, null_keys_conflict))


def source_counts(parsed: Parsed) -> DataFrame:
    """Rows built per source code (every accepted datum, NULL values included)."""
    return (parsed.rows.filter("has_datum").groupBy("code")
            .agg(F.count(F.lit(1)).alias("filas")))


def source_samples(parsed: Parsed) -> DataFrame:
    """The first processed row of every source (load order).

    A hash aggregate finds each source's smallest ordinal; the ordinal is
    unique, so a join back on it returns exactly one row per source.  The
    7-row side is bounded by the registry and broadcast.  No per-source window:
    one source may hold a third of all rows.
    """
    data = parsed.rows.where("has_datum")
    firsts = data.groupBy("code").agg(F.min("ord").alias("ord"))
    return (data.join(F.broadcast(firsts), ["code", "ord"])
            .select("code", "series_pos", "nombre", "anyo", "fk_periodo", "valor"))


def series_table(parsed: Parsed) -> DataFrame:
    """One row per accepted series with its parsed metadata."""
    cols = ["code", "series_pos", "nombre", "n_parts"] + [f"meta_{f}" for f in C.META_FIELDS]
    return parsed.rows.select(*cols).distinct()  # the parse depends on code and name only

