"""Landed statistics-office payloads.

Two landing formats:

* one JSON document per source table (``<code>.json``): an array of series,
  or a lone series object (wrapped into a list).  A document is read whole
  (``wholetext``), so one file is one task; fine for a table's payload.
* JSON lines, one series per line with its table code and position
  (``{"code": .., "series_pos": .., "Nombre": .., "Data": [..]}``): splittable,
  for payloads beyond one task's memory.

Both give the exploded observation frame of ``schemas.OBSERVATIONS``; series
and datum positions come from ``posexplode`` and feed the load ordinal.  A
file that does not parse yields no series; it becomes one reject row
(``unreadable_file``, named after the file) of the load, and
``unreadable_files`` lists such files (a failed source is skipped).  Values
given as text are kept where they are numbers and rejected (``bad_value``)
where they are not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens import schemas as S
from wagelens.session import scratch_path

CODE_PATTERN = r"(\d+)\.json[a-z]*$"


def _documents(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return documents(raw)


def documents(raw: DataFrame) -> DataFrame:
    """(file, value) rows of whole documents -> (file, code, payload array)."""
    text = F.ltrim(F.col("value"))
    # malformed text: from_json would give a struct of NULLs, so validate first; these two
    # functions stream over the text, so a document's size and repeated keys don't matter
    valid = F.json_array_length("value").isNotNull() | F.json_object_keys("value").isNotNull()
    payload = (F.when(~valid, F.lit(None))
               .when(text.startswith("{"), F.array(F.from_json(F.col("value"), S.SERIES)))
               .otherwise(F.from_json(F.col("value"), S.PAYLOAD)))
    return raw.select(
        "file",
        F.regexp_extract(F.col("file"), CODE_PATTERN, 1).cast("int").alias("code"),
        payload.alias("payload"),
    )


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """Files whose text is not a payload (or whose name carries no code)."""
    docs = _documents(spark, path)
    return docs.where(F.col("payload").isNull() | F.col("code").isNull()).select("file", "code")


NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """A numeric text as double (as a REAL column would store it); NULL for anything else."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _explode(series: DataFrame) -> DataFrame:
    """Series -> observations; ``bad_value`` and ``unreadable`` mark what ``ingest.annotate`` rejects."""
    data = series.select("code", "series_pos", "unreadable",
                         F.when(F.col("unreadable"), F.col("file")).otherwise(F.col("s.Nombre")).alias("nombre"),
                         F.posexplode_outer(F.col("s.Data")).alias("data_pos", "d"))
    value = F.col("d.Valor")
    return data.select(
        F.col("code").cast("int").alias("code"), F.col("series_pos").cast("long").alias("series_pos"), "nombre",
        F.when(F.col("d").isNotNull(), F.col("data_pos")).cast("long").alias("data_pos"),
        F.col("d.Anyo").alias("anyo"), F.col("d.FK_Periodo").alias("fk_periodo"), number(value).alias("valor"),
        (value.isNotNull() & number(value).isNull()).alias("bad_value"), "unreadable",
    )


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """``<code>.json`` documents -> observations (one row per datum)."""
    return observations_from_documents(_documents(spark, path))


def observations_from_documents(docs: DataFrame) -> DataFrame:
    """One row per datum; an unreadable file (no payload or no code) is one row named after it."""
    docs = docs.withColumn("unreadable", F.col("payload").isNull() | F.col("code").isNull())
    own = F.when(~F.col("unreadable"), F.col("payload"))
    series = docs.select("file", "code", "unreadable", F.posexplode_outer(own).alias("series_pos", "s"))
    return _explode(series.where(F.col("unreadable") | F.col("series_pos").isNotNull()))


LINE_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("series_pos", T.LongType()),
    T.StructField("Nombre", T.StringType()),
    T.StructField("Data", T.ArrayType(S.DATUM)),
])


def read_payload_lines(spark: SparkSession, path: str, clean: bool = False) -> DataFrame:
    """S1, splittable form: JSON lines of series carrying code and position (clean: payload columns only)."""
    lines = spark.read.schema(LINE_SCHEMA).json(path)
    series = lines.select("code", "series_pos", F.struct("Nombre", "Data").alias("s"),
                          F.lit(False).alias("unreadable"), F.lit(None).cast("string").alias("file"))
    return _explode(series).drop("bad_value", "unreadable") if clean else _explode(series)


def series_lines(obs: DataFrame) -> DataFrame:
    """Observations -> one JSON line per series (inverse of ``read_payload_lines``).

    Data are collected per series only (bounded by the series' periods),
    ordered by their position.
    """
    datum = F.struct(F.col("data_pos"), F.struct(F.col("anyo").alias("Anyo"), F.col("fk_periodo").alias("FK_Periodo"),
                                                  F.col("valor").alias("Valor")).alias("d"))
    grouped = obs.groupBy("code", "series_pos", "nombre").agg(
        F.sort_array(F.collect_list(F.when(F.col("data_pos").isNotNull(), datum))).alias("data"))
    return grouped.select(F.to_json(F.struct(
        "code", "series_pos", F.col("nombre").alias("Nombre"),
        F.transform("data", lambda x: x["d"]).alias("Data"))).alias("value"))


# ---------------------------------------------------------------- S3

_TYPE_LABELS = [
    (T.BooleanType, "BOOLEAN"), (T.IntegralType, "INTEGER"), (T.FractionalType, "FLOAT"),
    (T.StringType, "STRING"), (T.NullType, "NULL"),
]


def _label(dt: T.DataType) -> str:
    for cls, label in _TYPE_LABELS:
        if isinstance(dt, cls):
            return label
    if isinstance(dt, T.StructType):
        return "OBJECT"
    if isinstance(dt, T.ArrayType):
        return "ARRAY"
    return "UNKNOWN"


def _flatten(dt: T.DataType, prefix: str, out: list) -> None:
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            name = f"{prefix}.{f.name}" if prefix else f.name
            out.append((name, _label(f.dataType)))
            _flatten(f.dataType, name, out)
    elif isinstance(dt, T.ArrayType):
        _flatten(dt.elementType, f"{prefix}[]", out)


def schema_report(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S3: nested field -> type label, inferred over every series (not the first only)."""
    schema = spark.read.option("multiLine", multi_line).json(path).schema
    rows: list = []
    _flatten(schema, "", rows)
    out = T.StructType([T.StructField("campo", T.StringType()), T.StructField("tipo", T.StringType())])
    return spark.createDataFrame(rows, out)


def path_statistics(values: DataFrame, column: str = "value") -> DataFrame:
    """S3 on the raw text: campo, tipo, filas for every path of the JSON values and every type found there.

    A value is read as VARIANT and taken apart level by level: object fields by their name, array elements as ``[]``.
    A path that holds numbers here and texts there has a row for each; text that is no JSON is an UNREADABLE value of
    the path ''.  A value may have up to 16 MB (a series, or a line); split documents with ``document_values`` first.
    """
    spark = values.sparkSession
    raw = F.col(column).cast("string")
    level = values.where(raw.isNotNull()).select(F.lit("").alias("campo"), F.try_parse_json(raw).alias("v"))
    found = None
    while True:
        path = scratch_path(spark, f"paths-{uuid.uuid4().hex}")  # each level is read from the one above it, not from the start
        level.write.parquet(path)
        level = spark.read.schema(level.schema).parquet(path)
        counted = level.groupBy("campo", _variant_label(F.col("v")).alias("tipo")).agg(F.count("*").alias("filas"))
        found = counted if found is None else found.unionByName(counted)
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        name = F.when(F.col("key").isNull(), F.concat("campo", F.lit("[]"))).when(F.col("campo") == "", F.col("key")).otherwise(F.concat_ws(".", "campo", "key"))
        following = inner.select(name.alias("campo"), F.col("value").alias("v"))
        if following.isEmpty():
            return found
        level = following


def document_values(docs: DataFrame, column: str = "value") -> DataFrame:
    """The elements of documents that are arrays, as text (a document may have any size); other documents as they are."""
    text = F.col(column).cast("string")
    parts = F.from_json(text, "array<string>")
    return docs.select(F.explode(F.when(text.rlike(r"^\s*\[") & parts.isNotNull(), parts).otherwise(F.array(text))).alias("value"))


def merged_types(statistics: DataFrame) -> DataFrame:
    """campo, tipo of a schema that holds every value: INTEGER and FLOAT make FLOAT, any other conflict STRING, NULL gives way."""
    kinds = F.array_remove(F.collect_set("tipo"), "NULL")
    one = statistics.groupBy("campo").agg(F.sort_array(kinds).alias("k"))
    return one.select("campo", F.when(F.size("k") == 0, "NULL").when(F.size("k") == 1, F.col("k")[0])
                      .when(F.col("k") == F.array(F.lit("FLOAT"), F.lit("INTEGER")), "FLOAT").otherwise("STRING").alias("tipo"))


def _variant_label(v: Column) -> Column:
    kind = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    label = F.when(v.isNull(), "UNREADABLE")
    for names, to in ((("BIGINT",), "INTEGER"), (("DECIMAL", "DOUBLE", "FLOAT"), "FLOAT"), (("VOID",), "NULL")):
        label = label.when(kind.isin(*names), to)
    return label.otherwise(kind)
