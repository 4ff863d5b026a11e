"""Shape the driver's TPC-H-like tables into statistics-office payloads.

There is no network and no landed source data, so the seven sources are
derived from the driver tables with Spark.  Each source becomes an exploded
payload (one row per series and period) with the same columns as a landed
file after ``posexplode`` (see ``sources.landing``):

``code, series_pos, nombre, data_pos, anyo, fk_periodo, valor``

* A series is a combination of labels; its name joins the labels with ". "
  and its position is computed from the label codes (no window needed).
* A datum is one period of a series; its value aggregates every driver row of
  that series and period (hash aggregate with map-side partials, so a hot
  series or period is combined before the shuffle).  Lines are summed up
  by what their labels and periods depend on first, so that only those sums,
  whose number is bounded by labels and months, are taken three times (one
  datum candidate each for prices, unemployment and temporality).  Values are published on
  a binary-exact grid (whole euros, quarter points), as statistics offices
  publish rounded figures: every later sum is then exact and does not depend
  on the order in which partitions are combined.
* ``data_pos`` orders the data of a series by period (year * 64 + code).

Sources, from the driver tables:

======  =====================  ==============================================
code    driver rows            series labels
======  =====================  ==============================================
IPC     lineitem, status O     region . category(returnflag) . "Índice"
IPV     lineitem, status F     same, quarterly
PARO    lineitem               label . sex(suppkey) . nation . age(returnflag)
TEMP    lineitem               nation . label . sex . contract . working time
                               (working time missing when l_tax = 0: the name
                               is then too short and the series is rejected)
OCUP    orders, status F       segment . sex(custkey) . nation("España" for 0)
PCTL    orders, status O       sex . nation . label . measure(priority)
ETCL    orders, other status   nation . segment . measure(priority)
======  =====================  ==============================================

Nation 0 is the national total; nations 1-19 carry the 19 region names of the
map coordinates; the others keep their driver name (and so have no map point).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import constants as C
from wagelens.operators.joins import join_checked, join_fixed

# --------------------------------------------------------------------------
# FIXED VALUES of the shaping (labels of the derived series)
# --------------------------------------------------------------------------
SEXES = ["Hombres", "Mujeres", "Ambos sexos"]                       # key % 3
PRICE_CATEGORIES = {"A": "Índice general", "N": "Alimentos y bebidas no alcohólicas",
                    "R": "Transporte"}                               # else "Otros bienes y servicios"
PRICE_OTHER = "Otros bienes y servicios"
PRICE_MEASURE = "Índice"
UNEMPLOYMENT_LABEL = "Tasa de paro de la población"
AGE_GROUPS = {"A": "Menores de 25 años", "N": "De 25 a 54 años"}     # else "55 y más años"
AGE_OTHER = "55 y más años"
EMPLOYEES_LABEL = "Asalariados"
CONTRACTS = {"R": "Indefinido"}                                      # else "Temporal"
CONTRACT_OTHER = "Temporal"
WORKING_TIME = {"F": "Jornada completa"}                             # else part time
WORKING_TIME_OTHER = "Jornada a tiempo parcial"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # else index 5
PERCENTILE_AGES = "Todas las edades"
PERCENTILE_MEASURES = {"1-URGENT": "Media", "2-HIGH": "Mediana", "3-MEDIUM": "Percentil 10",
                       "4-NOT SPECIFIED": "Percentil 25"}           # else "Percentil 90"
PERCENTILE_OTHER = "Percentil 90"
COST_MEASURES = {"1-URGENT": "Coste salarial total", "2-HIGH": "Coste salarial total"}
COST_OTHER = "Coste laboral total"
ANNUAL_CODE = 28          # period code of annual data
QUARTER_BASE = 18         # quarter q -> period code 18 + q
DATA_POS_FACTOR = 64      # data_pos = year * 64 + period code
VALUE_STEPS = 4           # index, rate and count values in quarter points
REGION_NAMES = list(C.COORDINATES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_label(c: Column, mapping: dict, other: str) -> Column:
    expr = None
    for key, label in mapping.items():
        expr = F.when(c == key, F.lit(label)) if expr is None else expr.when(c == key, F.lit(label))
    return expr.otherwise(F.lit(other))


def _map_index(c: Column, keys: list) -> Column:
    expr = None
    for i, key in enumerate(keys):
        expr = F.when(c == key, F.lit(i)) if expr is None else expr.when(c == key, F.lit(i))
    return expr.otherwise(F.lit(len(keys)))


def _geography(nationkey: Column, n_name: Column, national: str) -> Column:
    """Nation 0 -> national label; 1..19 -> region names; others keep the driver name."""
    expr = F.when(nationkey == 0, F.lit(national))
    for i, name in enumerate(REGION_NAMES, start=1):
        expr = expr.when(nationkey == i, F.lit(name))
    return expr.otherwise(n_name)


def _name(*parts: Column) -> Column:
    """Labels joined with '. ' plus a trailing '. ' (an empty last part)."""
    return F.concat(F.concat_ws(". ", *parts), F.lit(". "))


def _quarters(mean: Column) -> Column:
    """Round a mean to quarter points (exact in binary)."""
    return F.round(mean * VALUE_STEPS, 0) / VALUE_STEPS


def _lineitem_by_supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    sup = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25) and region (5) are fixed-size; supplier grows with the data.
    sn = join_fixed(sup, nat, sup.s_nationkey == nat.n_nationkey)
    sn = join_fixed(sn, reg, sn.n_regionkey == reg.r_regionkey, "left")
    # supplier rows bound the (inner, fixed-size) joined side
    return join_checked(li, sn, li.l_suppkey == sn.s_suppkey, bound=sup)


# Each driver row (or sum of rows, ``n`` of them) contributes one datum candidate per source.  Only the label
# indices that define a series travel through the aggregate (so they never
# split a series); names are built afterwards on the aggregated rows, keeping
# the per-row work narrow and inside whole-stage codegen.
_LABELS = [("k_region", "int"), ("k_nation", "int"), ("k_sex", "int"), ("k_a", "int"), ("k_b", "int"),
           ("k_text", "string")]
_LABEL_CODES = [k for k, _ in _LABELS]


def _contribution(code: Column, series_pos: Column, anyo: Column, fk: Column, x: Column, n: Column, **labels) -> Column:
    fields = [code.alias("code"), series_pos.cast("long").alias("series_pos"), anyo.alias("anyo"),
              fk.alias("fk_periodo"), x.cast("double").alias("x"), n.cast("long").alias("n")]
    fields += [(labels[k] if k in labels else F.lit(None)).cast(t).alias(k) for k, t in _LABELS]
    return F.struct(*fields)


def _index_label(k: Column, labels: list[str], other: str) -> Column:
    return _map_label(k, dict(enumerate(labels)), other)


def _lineitem_sums(rows: DataFrame) -> DataFrame:
    """Quantities, discounts and counts by all that a line's labels and periods depend on (missing values included)."""
    return (rows.groupBy("r_regionkey", "n_nationkey", F.pmod(F.col("l_suppkey"), F.lit(3)).alias("sex"), "l_returnflag", "l_linestatus",
                         F.coalesce(F.col("l_tax") != 0, F.lit(False)).alias("taxed"), F.trunc("l_shipdate", "month").alias("month"))
            .agg(F.sum("l_quantity").alias("quantity"), F.sum(F.round(F.col("l_discount") * 100, 0)).alias("discount"), F.count(F.lit(1)).alias("n")))


def _lineitem_contributions() -> Column:
    sex = F.col("sex")
    nation = F.col("n_nationkey")
    anyo, n = F.year("month"), F.col("n")
    quarter_fk = F.quarter("month") + QUARTER_BASE
    monthly = F.col("l_linestatus") == "O"
    category = _map_index(F.col("l_returnflag"), list(PRICE_CATEGORIES))
    age = _map_index(F.col("l_returnflag"), list(AGE_GROUPS))
    contract = _map_index(F.col("l_returnflag"), list(CONTRACTS))
    time_idx = F.when(F.col("taxed"), _map_index(F.col("l_linestatus"), list(WORKING_TIME))).otherwise(F.lit(2))
    # no region (dangling key) -> no price candidate: code NULL, dropped after inline
    price_code = F.when(F.col("r_regionkey").isNotNull(),
                        F.when(monthly, F.lit(C.IPC)).otherwise(F.lit(C.IPV)))
    price = _contribution(price_code, F.col("r_regionkey") * 4 + category, anyo,
                          F.when(monthly, F.month("month")).otherwise(quarter_fk), F.col("quantity"), n,
                          k_region=F.col("r_regionkey"), k_a=category)
    paro = _contribution(F.lit(C.TASA_PARO), (nation * 3 + sex) * 4 + age, anyo, quarter_fk,
                         F.col("discount"), n, k_nation=nation, k_sex=sex, k_a=age)
    temp = _contribution(F.lit(C.TEMPORALIDAD), ((nation * 3 + sex) * 2 + contract) * 4 + time_idx, anyo, quarter_fk,
                         F.col("quantity"), n, k_nation=nation, k_sex=sex, k_a=contract, k_b=time_idx)
    return F.array(price, paro, temp)


def _lineitem_names(agg: DataFrame, sf_dir: str) -> DataFrame:
    spark = agg.sparkSession
    reg = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k_region"), "r_name")
    nat = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k_nation"), "n_name")
    named = join_fixed(join_fixed(agg, reg, "k_region", "left"), nat, "k_nation", "left")
    sex = _index_label(F.col("k_sex"), SEXES, SEXES[-1])
    geo = _geography(F.col("k_nation"), F.col("n_name"), C.NATIONAL_TOTAL)
    k_a, code = F.col("k_a"), F.col("code")
    working_time = _index_label(F.col("k_b"), [WORKING_TIME["F"], WORKING_TIME_OTHER], "")
    nombre = (
        F.when(code.isin(C.IPC, C.IPV),
               _name(F.col("r_name"), _index_label(k_a, list(PRICE_CATEGORIES.values()), PRICE_OTHER),
                     F.lit(PRICE_MEASURE)))
        .when(code == C.TASA_PARO,
              _name(F.lit(UNEMPLOYMENT_LABEL), sex, geo, _index_label(k_a, list(AGE_GROUPS.values()), AGE_OTHER)))
        .otherwise(_name(geo, F.lit(EMPLOYEES_LABEL), sex,
                         _index_label(k_a, list(CONTRACTS.values()), CONTRACT_OTHER), working_time))
    )
    return named.withColumn("nombre", nombre)


def _aggregate_contributions(exploded: DataFrame) -> DataFrame:
    """One datum per (code, series, period); the label indices are functions of
    the series position, so grouping by them does not split a series."""
    return (exploded.where(F.col("code").isNotNull())
            .groupBy("code", "series_pos", "anyo", "fk_periodo", *_LABEL_CODES)
            .agg(F.sum("x").alias("sum_x"), F.sum("n").alias("n_x")))


def _finish(named: DataFrame, valor: Column) -> DataFrame:
    return named.select(
        F.col("code").cast("int").alias("code"), F.col("series_pos").cast("long").alias("series_pos"), "nombre",
        (F.col("anyo") * DATA_POS_FACTOR + F.col("fk_periodo")).cast("long").alias("data_pos"),
        F.col("anyo").cast("int").alias("anyo"), F.col("fk_periodo").cast("int").alias("fk_periodo"),
        valor.cast("double").alias("valor"))


def lineitem_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPC, IPV, unemployment and temporality payloads in one lineitem scan.

    Each sum of lines contributes one datum candidate to three sources (``inline`` of
    a 3-element array); a second hash aggregate combines them per (code, series, period).
    """
    sums = _lineitem_sums(_lineitem_by_supplier_nation(spark, sf_dir))
    agg = _aggregate_contributions(sums.select(F.inline(_lineitem_contributions())))
    return _finish(_lineitem_names(agg, sf_dir), _quarters(F.col("sum_x") / F.col("n_x")))


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_observations(spark, sf_dir).where(F.col("code").isin(C.IPC, C.IPV))


def employment_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_observations(spark, sf_dir).where(F.col("code").isin(C.TASA_PARO, C.TEMPORALIDAD))


def _orders_contribution() -> Column:
    status = F.col("o_orderstatus")
    sex = F.pmod(F.col("o_custkey"), F.lit(3))
    nation = F.col("c_nationkey")
    seg = _map_index(F.col("c_mktsegment"), SEGMENTS)
    pct = _map_index(F.col("o_orderpriority"), list(PERCENTILE_MEASURES))
    cost = _map_index(F.col("o_orderpriority"), list(COST_MEASURES))
    occupation, percentiles = status == "F", status == "O"
    code = F.when(occupation, F.lit(C.EAES_OCUPACION)).when(percentiles, F.lit(C.EAES_PERCENTILES)) \
        .otherwise(F.lit(C.ETCL))
    series_pos = (F.when(occupation, (nation * 8 + seg) * 4 + sex)
                  .when(percentiles, (nation * 4 + sex) * 8 + pct)
                  .otherwise((nation * 8 + seg) * 2 + cost))
    fk = F.when(occupation | percentiles, F.lit(ANNUAL_CODE)).otherwise(F.quarter("o_orderdate") + QUARTER_BASE)
    return _contribution(code, series_pos, F.year("o_orderdate"), fk, F.round(F.col("o_totalprice") * 100, 0), F.lit(1),
                         k_nation=nation, k_sex=F.when(~(occupation | percentiles), F.lit(None)).otherwise(sex),
                         k_a=F.when(percentiles, pct).when(~occupation, cost),
                         k_text=F.when(~percentiles, F.col("c_mktsegment")))


def _orders_names(agg: DataFrame, sf_dir: str) -> DataFrame:
    spark = agg.sparkSession
    nat = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k_nation"), "n_name")
    named = join_fixed(agg, nat, "k_nation")
    sex = _index_label(F.col("k_sex"), SEXES, SEXES[-1])
    geo = _geography(F.col("k_nation"), F.col("n_name"), C.SPAIN)
    k_a, code = F.col("k_a"), F.col("code")
    nombre = (F.when(code == C.EAES_OCUPACION, _name(F.col("k_text"), sex, geo))
              .when(code == C.EAES_PERCENTILES,
                    _name(sex, geo, F.lit(PERCENTILE_AGES),
                          _index_label(k_a, list(PERCENTILE_MEASURES.values()), PERCENTILE_OTHER)))
              .otherwise(_name(geo, F.col("k_text"), _index_label(k_a, list(COST_MEASURES.values()), COST_OTHER))))
    return named.withColumn("nombre", nombre)


def wage_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupation, percentile and labour-cost payloads in one orders scan."""
    o = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    cu = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = join_checked(o, cu, o.o_custkey == cu.c_custkey)
    agg = _aggregate_contributions(rows.select(_orders_contribution().alias("c")).select("c.*"))
    # whole euros: exact cents summed, mean rounded to the euro
    return _finish(_orders_names(agg, sf_dir), F.round(F.col("sum_x") / F.col("n_x") / 100, 0))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven sources as one exploded payload (one scan of lineitem, one of orders)."""
    return lineitem_observations(spark, sf_dir).unionByName(wage_observations(spark, sf_dir))
