"""DuckDB SQL oracle for every contract query with a SQL form.

An independent formulation of the same chain: the payload shaping as SQL,
first-row-wins and dimension numbering with ``row_number()`` windows, the gold
relation materialised and aggregated directly (no factorisation), and the
annual change as a self-join.  Tables are the driver's pre-registered views.
"""

from __future__ import annotations

from wagelens import constants as C
from wagelens.contract import (
    APP_REGION, DECIMALS, UNKNOWN_CODE, RANK_SECTORS, RANK_SEXES, RANK_YEARS, TREND_REGIONS, TREND_YEARS,
)
from wagelens.plans import extensions as X
from wagelens.plans import summaries as SM
from wagelens.sources import driver_tables as D


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _label(col: str, mapping: dict, other: str) -> str:
    whens = " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {_q(other)} END)"


def _index(col: str, keys: list) -> str:
    whens = " ".join(f"WHEN {col} = {_q(k)} THEN {i}" for i, k in enumerate(keys))
    return f"(CASE {whens} ELSE {len(keys)} END)"


def _geo(national: str) -> str:
    whens = " ".join(f"WHEN n_nationkey = {i} THEN {_q(n)}" for i, n in enumerate(D.REGION_NAMES, start=1))
    return f"(CASE WHEN n_nationkey = 0 THEN {_q(national)} {whens} ELSE n_name END)"


def _sex(key: str) -> str:
    return f"(CASE {key} % 3 WHEN 0 THEN {_q(D.SEXES[0])} WHEN 1 THEN {_q(D.SEXES[1])} ELSE {_q(D.SEXES[2])} END)"


def _month(fk: str) -> str:
    whens = " ".join(f"WHEN {fk} = {k} THEN {v}" for k, v in C.PERIOD_MONTH.items())
    return f"(CASE {whens} ELSE 1 END)"


def _registry() -> str:
    cols = ["code", "source_rank", "family", "reg_indicador", "reg_unidad", "target", "required_parts"] + \
        [f"pos_{f}" for f in C.META_FIELDS]
    rows = []
    for code in C.LOAD_ORDER:
        fam, ind, unit = C.SOURCES[code]
        lay = C.LAYOUTS[code]
        vals = [str(code), str(C.SOURCE_RANK[code]), _q(fam), _q(ind), _q(unit), _q(C.TARGET[fam]),
                str(C.REQUIRED_PARTS[code])] + [
            (f"CAST({lay[f]} AS INTEGER)" if f in lay else "CAST(NULL AS INTEGER)") for f in C.META_FIELDS]
        rows.append("(" + ", ".join(vals) + ")")
    return f"reg({', '.join(cols)}) AS (VALUES {', '.join(rows)})"


_WS = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
SCALE = f"{float(10 ** DECIMALS)}"


def _r(expr: str) -> str:
    """round(x * 10^d) / 10^d (the Spark side uses the same arithmetic)."""
    return f"(round(({expr}) * {SCALE}) / {SCALE})"


def _base() -> str:
    nat, spain = _q(C.NATIONAL_TOTAL), _q(C.SPAIN)
    sex_s = _sex("l_suppkey")
    sex_c = _sex("o_custkey")
    geo_e = _geo(C.NATIONAL_TOTAL)
    geo_w = _geo(C.SPAIN)
    seg = _index("c_mktsegment", D.SEGMENTS)
    meta = ",\n    ".join(f"parts[pos_{f} + 1] AS meta_{f}" for f in C.META_FIELDS)
    meta_cols = ", ".join(f"meta_{f}" for f in C.META_FIELDS)
    month = _month("fk_periodo")
    ws_sector = _WS.format(x="sector_cnae")
    return f"""
{_registry()},
sn AS (SELECT s_suppkey, n_nationkey, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
li_sn AS (SELECT l.l_suppkey, l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
                 sn.n_nationkey, sn.n_name, sn.n_regionkey
          FROM lineitem l JOIN sn ON l.l_suppkey = sn.s_suppkey),
li_snr AS (SELECT li_sn.*, r_regionkey, r_name FROM li_sn JOIN region ON n_regionkey = r_regionkey),
p_rows AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN {C.IPC} ELSE {C.IPV} END AS code,
         r_regionkey * 4 + {_index('l_returnflag', list(D.PRICE_CATEGORIES))} AS series_pos,
         concat_ws('. ', r_name, {_label('l_returnflag', D.PRICE_CATEGORIES, D.PRICE_OTHER)}, {_q(D.PRICE_MEASURE)}) || '. ' AS nombre,
         year(l_shipdate) AS anyo,
         CASE WHEN l_linestatus = 'O' THEN month(l_shipdate) ELSE quarter(l_shipdate) + {D.QUARTER_BASE} END AS fk_periodo,
         l_quantity AS x
  FROM li_snr),
e_rows AS (
  SELECT {C.TASA_PARO} AS code,
         (n_nationkey * 3 + l_suppkey % 3) * 4 + {_index('l_returnflag', list(D.AGE_GROUPS))} AS series_pos,
         concat_ws('. ', {_q(D.UNEMPLOYMENT_LABEL)}, {sex_s}, {geo_e}, {_label('l_returnflag', D.AGE_GROUPS, D.AGE_OTHER)}) || '. ' AS nombre,
         year(l_shipdate) AS anyo, quarter(l_shipdate) + {D.QUARTER_BASE} AS fk_periodo,
         round(l_discount * 100, 0) AS x
  FROM li_sn),
t_rows AS (
  SELECT {C.TEMPORALIDAD} AS code,
         (((n_nationkey * 3 + l_suppkey % 3) * 2 + {_index('l_returnflag', list(D.CONTRACTS))}) * 4
           + CASE WHEN l_tax <> 0 THEN {_index('l_linestatus', list(D.WORKING_TIME))} ELSE 2 END) AS series_pos,
         concat_ws('. ', {geo_e}, {_q(D.EMPLOYEES_LABEL)}, {sex_s}, {_label('l_returnflag', D.CONTRACTS, D.CONTRACT_OTHER)},
                   CASE WHEN l_tax <> 0 THEN {_label('l_linestatus', D.WORKING_TIME, D.WORKING_TIME_OTHER)} ELSE '' END) || '. ' AS nombre,
         year(l_shipdate) AS anyo, quarter(l_shipdate) + {D.QUARTER_BASE} AS fk_periodo,
         l_quantity AS x
  FROM li_sn),
w_src AS (SELECT o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
                 c.c_mktsegment, n.n_nationkey, n.n_name
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
w_rows AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN {C.EAES_OCUPACION} WHEN o_orderstatus = 'O' THEN {C.EAES_PERCENTILES} ELSE {C.ETCL} END AS code,
         CASE WHEN o_orderstatus = 'F' THEN (n_nationkey * 8 + {seg}) * 4 + o_custkey % 3
              WHEN o_orderstatus = 'O' THEN (n_nationkey * 4 + o_custkey % 3) * 8 + {_index('o_orderpriority', list(D.PERCENTILE_MEASURES))}
              ELSE (n_nationkey * 8 + {seg}) * 2 + {_index('o_orderpriority', list(D.COST_MEASURES))} END AS series_pos,
         CASE WHEN o_orderstatus = 'F' THEN concat_ws('. ', c_mktsegment, {sex_c}, {geo_w}) || '. '
              WHEN o_orderstatus = 'O' THEN concat_ws('. ', {sex_c}, {geo_w}, {_q(D.PERCENTILE_AGES)},
                                                      {_label('o_orderpriority', D.PERCENTILE_MEASURES, D.PERCENTILE_OTHER)}) || '. '
              ELSE concat_ws('. ', {geo_w}, c_mktsegment, {_label('o_orderpriority', D.COST_MEASURES, D.COST_OTHER)}) || '. ' END AS nombre,
         year(o_orderdate) AS anyo,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN {D.ANNUAL_CODE} ELSE quarter(o_orderdate) + {D.QUARTER_BASE} END AS fk_periodo,
         round(o_totalprice * 100, 0) AS x
  FROM w_src),
obs AS (
  SELECT code, CAST(series_pos AS BIGINT) AS series_pos, nombre, CAST(anyo * {D.DATA_POS_FACTOR} + fk_periodo AS BIGINT) AS data_pos,
         CAST(anyo AS INTEGER) AS anyo, CAST(fk_periodo AS INTEGER) AS fk_periodo, CAST(round(sum(x) / count(*) * {D.VALUE_STEPS}) / {D.VALUE_STEPS} AS DOUBLE) AS valor
  FROM (SELECT * FROM p_rows UNION ALL SELECT * FROM e_rows UNION ALL SELECT * FROM t_rows)
  GROUP BY code, series_pos, nombre, anyo, fk_periodo
  UNION ALL
  SELECT code, CAST(series_pos AS BIGINT), nombre, CAST(anyo * {D.DATA_POS_FACTOR} + fk_periodo AS BIGINT),
         CAST(anyo AS INTEGER), CAST(fk_periodo AS INTEGER), CAST(round(sum(x) / count(*) / 100) AS DOUBLE)
  FROM w_rows GROUP BY code, series_pos, nombre, anyo, fk_periodo),
x1 AS (
  SELECT *, list_filter(list_transform(string_split(nombre, '.'), lambda p: {_WS.format(x='p')}), lambda p: p <> '') AS parts
  FROM obs LEFT JOIN reg USING (code)),
x2 AS (
  SELECT *,
    CASE WHEN family IS NULL THEN 'unknown_code'
         WHEN len(parts) < required_parts THEN 'short_name'
         END AS series_reason,
    CASE WHEN data_pos IS NULL THEN NULL
         WHEN anyo IS NULL THEN 'null_year'
         WHEN anyo < 1 OR anyo > 9999 THEN 'bad_year' END AS datum_reason
  FROM x1),
rej AS (
  SELECT code, series_pos, nombre, data_pos, anyo, fk_periodo, coalesce(series_reason, datum_reason) AS reason
  FROM x2 WHERE series_reason IS NOT NULL OR datum_reason IS NOT NULL),
m1 AS (
  SELECT *, {meta},
    (data_pos IS NOT NULL AND datum_reason IS NULL) AS has_datum,
    CAST(source_rank AS HUGEINT) * {10 ** C.RANK_DIGITS} + CAST(series_pos AS HUGEINT) * {10 ** C.DATUM_DIGITS} AS series_ord
  FROM x2 WHERE series_reason IS NULL),
rows_ AS (
  SELECT code, series_pos, nombre, data_pos, anyo, fk_periodo, valor, family, target,
    reg_indicador AS indicador, reg_unidad AS unidad, CAST(len(parts) AS INTEGER) AS n_parts, {meta_cols}, has_datum, series_ord,
    CASE WHEN has_datum THEN series_ord + data_pos + 1 END AS ord,
    CASE WHEN has_datum THEN make_date(anyo, {month}, 1) END AS fecha_iso,
    CASE WHEN has_datum THEN {month} END AS mes,
    CASE WHEN has_datum THEN fk_periodo END AS trimestre,
    CASE WHEN family = 'salarios' AND coalesce(meta_geografia, {nat}) = {spain} THEN {nat}
         ELSE coalesce(meta_geografia, {nat}) END AS geografia,
    CASE WHEN family = 'precios' THEN
         CASE WHEN contains(lower(meta_categoria), {_q(C.GENERAL_WORD)}) THEN {_q(C.GENERAL_CATEGORY)} ELSE meta_categoria END
    END AS categoria_gasto,
    CASE WHEN family = 'salarios' THEN coalesce(meta_sexo, {_q(C.DEFAULT_WAGE_SEX)})
         WHEN family = 'empleo' THEN meta_sexo END AS sexo,
    CASE WHEN family = 'salarios' THEN coalesce(meta_sector, meta_ocupacion, {_q(C.DEFAULT_OCCUPATION)}) END AS sector_cnae,
    CASE WHEN family = 'salarios' THEN coalesce(meta_ocupacion, {_q(C.DEFAULT_OCCUPATION)}) END AS ocupacion_cno11,
    CASE WHEN family = 'empleo' THEN meta_grupo_edad END AS grupo_edad,
    CASE WHEN family = 'empleo' THEN meta_tipo_jornada END AS tipo_jornada,
    CASE WHEN family = 'empleo' THEN meta_tipo_contrato END AS tipo_contrato
  FROM m1),
dim_geo AS (
  SELECT CAST(row_number() OVER (ORDER BY first_ord) AS BIGINT) AS id_geografia, nombre
  FROM (SELECT geografia AS nombre, min(series_ord) AS first_ord FROM rows_ WHERE geografia IS NOT NULL GROUP BY geografia)),
dim_ind AS (
  SELECT CAST(row_number() OVER (ORDER BY first_ord) AS BIGINT) AS id_indicador, nombre, unidad
  FROM (SELECT indicador AS nombre, series_ord AS first_ord, unidad,
               row_number() OVER (PARTITION BY indicador ORDER BY series_ord) AS rn FROM rows_)
  WHERE rn = 1),
dim_per AS (
  SELECT CAST(row_number() OVER (ORDER BY ord) AS BIGINT) AS id_periodo, CAST(anyo AS INTEGER) AS anio,
         CAST(trimestre AS INTEGER) AS trimestre, CAST(mes AS INTEGER) AS mes, fecha_iso
  FROM (SELECT *, row_number() OVER (PARTITION BY fecha_iso ORDER BY ord) AS rn FROM rows_ WHERE has_datum)
  WHERE rn = 1),
data_ AS (
  SELECT r.*, p.id_periodo, i.id_indicador, g.id_geografia
  FROM rows_ r JOIN dim_per p ON p.fecha_iso = r.fecha_iso JOIN dim_ind i ON i.nombre = r.indicador
       JOIN dim_geo g ON g.nombre = r.geografia
  WHERE r.has_datum AND r.valor IS NOT NULL),
f_precios AS (
  SELECT id_periodo, id_indicador, id_geografia, categoria_gasto, valor FROM (
    SELECT *, row_number() OVER (PARTITION BY id_periodo, id_indicador, id_geografia, categoria_gasto ORDER BY ord) AS rn
    FROM data_ WHERE target = 'T_precios' AND categoria_gasto IS NOT NULL)
  WHERE rn = 1),
f_salarios AS (
  SELECT id_periodo, id_indicador, id_geografia, sexo, sector_cnae, ocupacion_cno11, valor FROM (
    SELECT *, row_number() OVER (PARTITION BY id_periodo, id_indicador, id_geografia, sexo, sector_cnae, ocupacion_cno11
                                 ORDER BY ord) AS rn
    FROM data_ WHERE target = 'T_salarios')
  WHERE rn = 1 OR sexo IS NULL OR sector_cnae IS NULL OR ocupacion_cno11 IS NULL),
f_empleo AS (
  SELECT id_periodo, id_indicador, id_geografia, sexo, grupo_edad, tipo_jornada, tipo_contrato, valor FROM (
    SELECT *, row_number() OVER (PARTITION BY id_periodo, id_indicador, id_geografia, sexo, grupo_edad, tipo_jornada,
                                 tipo_contrato ORDER BY ord) AS rn
    FROM data_ WHERE target = 'T_empleo' AND sexo IS NOT NULL)
  WHERE rn = 1 OR grupo_edad IS NULL OR tipo_jornada IS NULL OR tipo_contrato IS NULL),
prices_read AS (
  SELECT f.valor AS valor_ipc, f.categoria_gasto, p.fecha_iso, i.nombre AS indicador
  FROM f_precios f JOIN dim_per p USING (id_periodo) JOIN dim_ind i USING (id_indicador)),
wages_read AS (
  SELECT f.valor AS valor_salario, f.sexo, f.sector_cnae, f.ocupacion_cno11, p.fecha_iso,
         i.nombre AS indicador_salario, g.nombre AS comunidad
  FROM f_salarios f JOIN dim_per p USING (id_periodo) JOIN dim_ind i USING (id_indicador) JOIN dim_geo g USING (id_geografia)),
emp_read AS (
  SELECT f.valor AS valor_empleo, f.sexo, p.fecha_iso, i.nombre AS indicador_empleo
  FROM f_empleo f JOIN dim_per p USING (id_periodo) JOIN dim_ind i USING (id_indicador)),
idx AS (
  SELECT * FROM prices_read
  WHERE valor_ipc IS NOT NULL AND categoria_gasto IS NOT NULL AND fecha_iso IS NOT NULL AND indicador IS NOT NULL
    AND valor_ipc > 0 AND categoria_gasto = {_q(C.GENERAL_CATEGORY)} AND contains(indicador, {_q(C.INDEX_WORD)})),
wages_clean AS (
  SELECT * FROM (SELECT valor_salario, sexo, {ws_sector} AS sector_cnae, ocupacion_cno11, fecha_iso, indicador_salario, comunidad
                 FROM wages_read)
  WHERE valor_salario IS NOT NULL AND sexo IS NOT NULL AND sector_cnae IS NOT NULL AND ocupacion_cno11 IS NOT NULL
    AND fecha_iso IS NOT NULL AND indicador_salario IS NOT NULL AND comunidad IS NOT NULL AND valor_salario > 0),
paro AS (
  SELECT * FROM emp_read
  WHERE valor_empleo IS NOT NULL AND sexo IS NOT NULL AND fecha_iso IS NOT NULL AND indicador_empleo IS NOT NULL
    AND indicador_empleo = {_q(C.UNEMPLOYMENT)}),
gold AS (
  SELECT w.valor_salario, w.sexo, w.sector_cnae, w.ocupacion_cno11, w.fecha_iso, w.indicador_salario, w.comunidad,
         i.valor_ipc, i.categoria_gasto, i.indicador, w.valor_salario / i.valor_ipc AS ratio_poder_adquisitivo,
         e.valor_empleo, e.indicador_empleo
  FROM wages_clean w JOIN idx i ON w.fecha_iso = i.fecha_iso
       JOIN paro e ON e.fecha_iso = w.fecha_iso AND e.sexo = w.sexo),
app AS (
  SELECT f.valor AS salario, f.sector_cnae, f.sexo, g.nombre AS comunidad, strftime(p.fecha_iso, '%Y-%m-%d') AS fecha_iso
  FROM f_salarios f JOIN dim_per p USING (id_periodo) JOIN dim_geo g USING (id_geografia)
  WHERE f.sector_cnae <> {_q(C.NOT_AVAILABLE)} AND strftime(p.fecha_iso, '%Y-%m-%d') <> ''),
mi0 AS (
  SELECT CAST(f.valor AS DOUBLE) AS salario, f.sector_cnae, f.sexo, g.nombre AS comunidad,
         strftime(p.fecha_iso, '%Y-%m-%d') AS fecha_iso
  FROM f_salarios f JOIN dim_per p USING (id_periodo) JOIN dim_geo g USING (id_geografia)
  WHERE f.sector_cnae IS NOT NULL AND f.sexo <> {_q(C.TOTAL)} AND p.fecha_iso IS NOT NULL
    AND strftime(p.fecha_iso, '%Y-%m-%d') <> ''),
mi AS (
  SELECT *, CAST(substr(fecha_iso, 1, 4) AS INTEGER) AS anio,
         CASE WHEN sexo = {_q(C.MEN)} THEN 0 ELSE 1 END AS sexo_num
  FROM mi0
  WHERE salario IS NOT NULL AND sector_cnae IS NOT NULL AND sexo IS NOT NULL AND comunidad IS NOT NULL
    AND fecha_iso IS NOT NULL)"""


def _with(body: str) -> str:
    return "WITH " + _base().strip() + "\n" + body


def _in(values) -> str:
    return "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _coords() -> str:
    rows = ", ".join(f"({_q(k)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
                     for k, (lat, lon) in C.COORDINATES.items())
    return f"(VALUES {rows}) AS coords(comunidad, lat, lon)"


def _named(table: str, cols: str) -> str:
    return (f"SELECT {cols}, p.fecha_iso, i.nombre AS indicador, g.nombre AS geografia FROM {table} f "
            "JOIN dim_per p USING (id_periodo) JOIN dim_ind i USING (id_indicador) JOIN dim_geo g USING (id_geografia)")


def _corr() -> str:
    cols = ["salario", "sexo_num", "anio"]
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                v = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            else:
                v = f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END"
            parts.append(f"SELECT {_q(a)} AS var_a, {_q(b)} AS var_b, {_r(f"CAST({v} AS DOUBLE)")} AS corr FROM mi")
    return "\nUNION ALL ".join(parts)


def _reload() -> str:
    keys = {
        "T_precios": ["id_periodo", "id_indicador", "id_geografia", "categoria_gasto"],
        "T_salarios": ["id_periodo", "id_indicador", "id_geografia", "sexo", "sector_cnae", "ocupacion_cno11"],
        "T_empleo": ["id_periodo", "id_indicador", "id_geografia", "sexo", "grupo_edad", "tipo_jornada", "tipo_contrato"],
    }
    src = {"T_precios": "f_precios", "T_salarios": "f_salarios", "T_empleo": "f_empleo"}
    parts = []
    for name, cte in [("tbl_periodo", "dim_per"), ("tbl_indicador", "dim_ind"), ("tbl_geografia", "dim_geo")]:
        parts.append(f"SELECT {_q(name)} AS tabla, count(*) AS filas_una_carga, count(*) AS filas_dos_cargas FROM {cte}")
    for name, ks in keys.items():
        cond = " AND ".join(f"a.{k} = b.{k}" for k in ks)
        again = f"(SELECT count(*) FROM {src[name]} a WHERE NOT EXISTS (SELECT 1 FROM {src[name]} b WHERE {cond}))"
        parts.append(f"SELECT {_q(name)} AS tabla, count(*) AS filas_una_carga, count(*) + {again} AS filas_dos_cargas "
                     f"FROM {src[name]}")
    return "\nUNION ALL ".join(parts)


def _split_bucket() -> str:
    key = ("concat_ws('|', fecha_iso, comunidad, sector_cnae, sexo, "
           "CAST(CAST(round(salario * 100, 0) AS BIGINT) AS VARCHAR))")
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % 100)"


def _exact_split() -> str:
    """Rows of the model input with en_test: the ceil(0.2 n) rows of the smallest md5 of the key."""
    key = ("concat_ws('|', fecha_iso, comunidad, sector_cnae, sexo, "
           "CAST(CAST(round(salario * 100, 0) AS BIGINT) AS VARCHAR))")
    return (f"SELECT mi.*, row_number() OVER (ORDER BY md5({key})) <= "
            f"(count(*) OVER () * {int(round(C.TEST_FRACTION * 100))} + 99) // 100 AS en_test FROM mi")


def _paths(columns: str, where: str, rest: str = "") -> str:
    """Paths of the landed series, values of every third series being text."""
    series = "(SELECT DISTINCT code, series_pos, nombre FROM obs)"
    datum = "obs WHERE data_pos IS NOT NULL"
    parts = [("", "OBJECT", f"count(*) AS filas FROM {series}"), ("code", "INTEGER", f"count(code) FROM {series}"), ("series_pos", "INTEGER", f"count(series_pos) FROM {series}"),
             ("Nombre", "STRING", f"count(nombre) FROM {series}"), ("Data", "ARRAY", f"count(*) FROM {series}"), ("Data[]", "OBJECT", f"count(*) FROM {datum}"),
             ("Data[].Anyo", "INTEGER", f"count(anyo) FROM {datum}"), ("Data[].FK_Periodo", "INTEGER", f"count(fk_periodo) FROM {datum}"),
             ("Data[].Valor", "FLOAT", f"count(valor) FROM {datum} AND series_pos % 3 <> 0"), ("Data[].Valor", "STRING", f"count(valor) FROM {datum} AND series_pos % 3 = 0")]
    rows = " UNION ALL ".join(f"SELECT {_q(c)} AS campo, {_q(t)} AS tipo, {q}" for c, t, q in parts)
    return f"SELECT {columns} FROM ({rows}) WHERE {where}{rest}"


def _zeros(columns: str, rows: list[tuple]) -> str:
    values = ", ".join("(" + ", ".join(_q(x) for x in r) + ", CAST(0 AS BIGINT))" for r in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({columns})"


def _kpis() -> str:
    return (f"SELECT 'ipc_actual' AS kpi, {_r('valor_ipc')} AS valor, format('{{:.2f}}', valor_ipc) AS texto FROM "
            "(SELECT valor_ipc FROM idx ORDER BY fecha_iso DESC, indicador DESC, valor_ipc DESC LIMIT 1)\n"
            f"UNION ALL SELECT 'salario_medio', {_r('avg(valor_salario)')}, format('{{:,.2f}}', avg(valor_salario)) FROM gold\n"
            f"UNION ALL SELECT 'paro_medio', {_r('avg(valor_empleo)')}, format('{{:.2f}}', avg(valor_empleo)) FROM gold")


def oracle_sql() -> dict[str, str]:
    nat = _q(C.NATIONAL_TOTAL)
    not_total_sector = f"sector_cnae <> {_q(C.TOTAL)} AND sector_cnae <> {_q(C.NOT_AVAILABLE)}"
    meta_cols = ", ".join(f"meta_{f}" for f in C.META_FIELDS)
    stats = (f"SELECT sector_cnae, sexo, {_r('avg(ratio_poder_adquisitivo)')} AS media, "
             f"{_r('max(ratio_poder_adquisitivo)')} AS \"max\", "
             f"{_r('stddev_samp(ratio_poder_adquisitivo)')} AS std FROM gold GROUP BY sector_cnae, sexo")
    trend = (f"SELECT fecha_iso, comunidad, {_r('avg(valor_salario)')} AS valor_salario FROM gold "
             f"WHERE comunidad <> {nat} {{extra}} GROUP BY fecha_iso, comunidad")
    rank = (f"SELECT sector_cnae, sexo, {_r('avg(ratio_poder_adquisitivo)')} AS ratio_poder_adquisitivo FROM gold "
            f"WHERE {not_total_sector} {{extra}} GROUP BY sector_cnae, sexo")
    region = (f"SELECT comunidad, {_r('avg(valor_salario)')} AS salario_medio, "
              f"{_r('avg(ratio_poder_adquisitivo)')} AS poder_adquisitivo FROM gold "
              f"WHERE comunidad <> {nat} GROUP BY comunidad")
    wc_keep = (f"NOT (code = {C.ETCL} AND has_datum AND NOT contains(lower(coalesce(meta_indicador, '')), "
               f"{_q(X.WAGE_COST_WORD)}))")
    q = {
        "ratio_stats": stats,
        "incremental_ratio_stats": stats,
        "incremental_trend": trend.format(extra=""),
        "ratio_stats_materialised": stats,
        "price_index_general": "SELECT valor_ipc, categoria_gasto, fecha_iso, indicador FROM idx",
        "price_chart": ("SELECT fecha_iso, valor_ipc, categoria_gasto, indicador FROM (SELECT *, row_number() OVER "
                        "(PARTITION BY fecha_iso ORDER BY indicador, valor_ipc, categoria_gasto) AS rn FROM idx) WHERE rn = 1"),
        "price_series_filtered": ("SELECT valor_ipc, categoria_gasto, fecha_iso, indicador FROM idx "
                                  f"WHERE year(fecha_iso) IN {_in(TREND_YEARS)}"),
        "parquet_roundtrip": "SELECT valor_ipc, categoria_gasto, fecha_iso, indicador FROM idx",
        "reject_unknown_code": (f"SELECT {UNKNOWN_CODE} AS code, 'unknown_code' AS reason, count(*) AS filas FROM obs "
                                f"WHERE code = {C.ETCL}"),
        "typed_reread": "SELECT salario, sector_cnae, sexo, comunidad, CAST(fecha_iso AS DATE) AS fecha FROM app",
        "schema_create": (
            "SELECT 'tbl_periodo' AS tabla, count(DISTINCT fecha_iso) AS filas FROM rows_ WHERE family = 'precios' AND has_datum "
            "UNION ALL SELECT 'tbl_indicador', count(DISTINCT indicador) FROM rows_ WHERE family = 'precios' "
            "UNION ALL SELECT 'tbl_geografia', count(DISTINCT geografia) FROM rows_ WHERE family = 'precios' "
            "UNION ALL SELECT 'T_precios', count(*) FROM f_precios "
            "UNION ALL SELECT 'T_salarios', 0 UNION ALL SELECT 'T_empleo', 0"),
        "schema_report": ("SELECT * FROM (VALUES ('code', 'INTEGER'), ('series_pos', 'INTEGER'), ('Nombre', 'STRING'), "
                          "('Data', 'ARRAY'), ('Data[].Anyo', 'INTEGER'), ('Data[].FK_Periodo', 'INTEGER'), "
                          "('Data[].Valor', 'FLOAT')) AS t(campo, tipo)"),
        "path_statistics": _paths("campo, tipo, filas", "filas > 0"),
        "merged_types": _paths("campo, CASE WHEN count(*) = 1 THEN any_value(tipo) ELSE 'STRING' END AS tipo", "filas > 0", " GROUP BY campo"),
        "model_test_actuals": f"SELECT salario AS \"real\" FROM ({_exact_split()}) WHERE en_test",
        "exact_split": _exact_split(),
        "forest_rules": _zeros("bosque, rule, violations", [(b, r) for b in ("200", "50", "app") for r in (
            "split_below_minimum", "beyond_depth", "children_do_not_add_up", "leaf_could_be_split", "empty_node")]),
        "linear_residuals": (
            "SELECT variable, nivel, count(*) AS n, CAST(0 AS DOUBLE) AS resto FROM (SELECT unnest(['sector_cnae', 'comunidad']) AS variable, "
            f"unnest([sector_cnae, comunidad]) AS nivel FROM ({_exact_split()}) WHERE NOT en_test) GROUP BY variable, nivel"),
        "cluster_violations": f"SELECT CAST(i AS INTEGER) AS cluster, CAST(0 AS BIGINT) AS mas_cerca_de_otro FROM range({C.KMEANS_K}) AS t(i)",
        "score_violations": _zeros("modelo, regla, violaciones", [(m, r) for m in ("lineal", "bosque", "bosque50") for r in ("r2", "mae")]
                                   + [("bosque", "fuera"), ("app", "fuera")]),
        "score_batch_levels": "SELECT DISTINCT sector_cnae, sexo, comunidad FROM app",
        "cluster_rows": "SELECT count(*) AS filas FROM mi",
        "gold_relation": "SELECT * FROM gold",
        "wage_trend_region": trend.format(extra=""),
        "year_filtered_trend": trend.format(
            extra=f"AND year(fecha_iso) IN {_in(TREND_YEARS)} AND comunidad IN {_in(TREND_REGIONS)}"),
        "purchasing_power_rank": rank.format(extra=""),
        "purchasing_power_filtered": rank.format(
            extra=f"AND year(fecha_iso) IN {_in(RANK_YEARS)} AND sexo IN {_in(RANK_SEXES)} "
                  f"AND sector_cnae IN {_in(RANK_SECTORS)}"),
        "region_summary": region,
        "region_map": (f"SELECT r.comunidad, r.salario_medio, r.poder_adquisitivo, coords.lat, coords.lon "
                       f"FROM ({region}) r JOIN {_coords()} ON r.comunidad = coords.comunidad"),
        "dashboard_kpis": _kpis(),
        "app_kpis": f"SELECT {_r('avg(salario)')} AS salario_medio, count(*) AS muestra FROM app",
        "app_region_kpis": (f"SELECT {_r('avg(salario)')} AS salario_medio, count(*) AS muestra FROM app "
                            f"WHERE comunidad = {_q(APP_REGION)}"),
        "wage_by_sector": f"SELECT sector_cnae, {_r('avg(salario)')} AS salario FROM app GROUP BY sector_cnae",
        "gender_gap": (f"SELECT sector_cnae, sexo, {_r('avg(salario)')} AS salario FROM app "
                       f"WHERE sexo <> {_q(C.TOTAL)} GROUP BY sector_cnae, sexo"),
        "distinct_filters": (
            "SELECT DISTINCT filtro, valor FROM ("
            "SELECT 'anio_ipc' AS filtro, CAST(year(fecha_iso) AS VARCHAR) AS valor FROM idx "
            "UNION ALL SELECT 'anio_salario', CAST(year(fecha_iso) AS VARCHAR) FROM gold "
            f"UNION ALL SELECT 'comunidad', comunidad FROM gold WHERE comunidad <> {nat} "
            f"UNION ALL SELECT 'sector', sector_cnae FROM gold WHERE {not_total_sector} "
            "UNION ALL SELECT 'sector_app', sector_cnae FROM app UNION ALL SELECT 'sexo_app', sexo FROM app "
            "UNION ALL SELECT 'comunidad_app', comunidad FROM app)"),
        "series_name_parse": f"SELECT DISTINCT code, series_pos, nombre, n_parts, {meta_cols} FROM rows_",
        "period_map": "SELECT id_periodo, anio, trimestre, mes, fecha_iso FROM dim_per",
        "category_normalise": ("SELECT DISTINCT code, meta_categoria AS categoria, categoria_gasto FROM rows_ "
                               "WHERE family = 'precios'"),
        "wage_defaults": ("SELECT DISTINCT code, meta_geografia AS geografia_origen, geografia, sexo, sector_cnae, "
                          "ocupacion_cno11 FROM rows_ WHERE family = 'salarios'"),
        "first_wins_load": _named("f_precios", "f.categoria_gasto, f.valor"),
        "wage_facts": _named("f_salarios", "f.sexo, f.sector_cnae, f.ocupacion_cno11, f.valor"),
        "null_key_load": _named("f_empleo", "f.sexo, f.grupo_edad, f.tipo_jornada, f.tipo_contrato, f.valor"),
        "reload_idempotent": _reload(),
        "dimension_build": ("SELECT 'tbl_geografia' AS tabla, id_geografia AS id, nombre AS clave, "
                            "CAST(NULL AS VARCHAR) AS unidad FROM dim_geo "
                            "UNION ALL SELECT 'tbl_indicador', id_indicador, nombre, unidad FROM dim_ind"),
        "rejects": "SELECT * FROM rej",
        "source_counts": "SELECT code, count(*) AS filas FROM rows_ WHERE has_datum GROUP BY code",
        "source_samples": ("SELECT code, series_pos, nombre, anyo, fk_periodo, valor FROM (SELECT *, row_number() "
                           "OVER (PARTITION BY code ORDER BY ord) AS rn FROM rows_ WHERE has_datum) WHERE rn = 1"),
        "model_input": "SELECT * FROM mi",
        "correlation_long": _corr(),
        "hash_split": f"SELECT *, {_split_bucket()} < {int(round(C.TEST_FRACTION * 100))} AS en_test FROM mi",
        "wage_share": (f"SELECT sexo, {_r('100.0 * sum(valor_salario) / sum(sum(valor_salario)) OVER ()')} AS porcentaje "
                       f"FROM gold WHERE sexo NOT IN {_in(X.BOTH_SEXES)} GROUP BY sexo"),
        "annual_change": (
            "SELECT a.indicador, a.geografia, a.fecha_iso, a.valor, "
            f"{_r('CASE WHEN b.valor <> 0 THEN 100.0 * (a.valor / b.valor - 1) END')} AS variacion_anual "
            "FROM ac a LEFT JOIN ac b ON a.indicador = b.indicador AND a.geografia = b.geografia "
            "AND b.fecha_iso = CAST(a.fecha_iso - INTERVAL 1 YEAR AS DATE)"),
        "temporality_rate": (
            "SELECT p.fecha_iso, g.nombre AS geografia, f.sexo, "
            + _r(f"100.0 * sum(CASE WHEN f.tipo_contrato = {_q(X.TEMPORARY)} THEN f.valor ELSE 0.0 END) / nullif(coalesce("
                 f"sum(f.valor) FILTER (WHERE f.tipo_contrato = {_q(C.TOTAL)}), sum(f.valor)), 0)") + " AS tasa_temporalidad "
            "FROM f_empleo f JOIN dim_ind i USING (id_indicador) JOIN dim_per p USING (id_periodo) "
            "JOIN dim_geo g USING (id_geografia) "
            f"WHERE i.nombre = {_q(X.TEMPORALITY)} AND contains(lower(f.tipo_jornada), 'completa') "
            "GROUP BY p.fecha_iso, g.nombre, f.sexo"),
        "wage_cost_only": (
            "SELECT fecha_iso, geografia, sector_cnae, valor FROM ("
            "SELECT *, row_number() OVER (PARTITION BY fecha_iso, indicador, geografia, sexo, sector_cnae, ocupacion_cno11 "
            f"ORDER BY ord) AS rn FROM rows_ WHERE {wc_keep} AND target = 'T_salarios' AND has_datum AND valor IS NOT NULL) "
            f"WHERE rn = 1 AND code = {C.ETCL}"),
        "wages_by_sector_dataset": (f"SELECT sector_cnae, {_r('avg(valor_salario)')} AS salario_medio FROM gold "
                                    "GROUP BY sector_cnae"),
        "model_rows_clean": (f"SELECT * FROM mi WHERE comunidad <> {nat} AND sector_cnae <> {_q(C.TOTAL)} "
                             f"AND sexo NOT IN {_in(X.BOTH_SEXES)}"),
        "landing_roundtrip": ("SELECT code, series_pos, nombre, CAST(row_number() OVER (PARTITION BY code, series_pos, "
                              "nombre ORDER BY data_pos) - 1 AS BIGINT) AS data_pos, anyo, fk_periodo, valor FROM obs"),
        "export_roundtrip": "SELECT valor_ipc, categoria_gasto, fecha_iso, indicador FROM idx",
        "master_export": "SELECT * FROM app",
        "master_preview": ("SELECT * FROM app ORDER BY fecha_iso, comunidad, sector_cnae, sexo, salario LIMIT "
                           f"{SM.PREVIEW_ROWS}"),
    }
    ac = (", ac AS (SELECT i.nombre AS indicador, g.nombre AS geografia, p.fecha_iso, f.valor FROM f_precios f "
          "JOIN dim_per p USING (id_periodo) JOIN dim_ind i USING (id_indicador) JOIN dim_geo g USING (id_geografia) "
          f"WHERE f.categoria_gasto = {_q(C.GENERAL_CATEGORY)})\n")
    out = {}
    for name, body in q.items():
        prefix = ac if name == "annual_change" else "\n"
        out[name] = _with(prefix + body)
    return out
