"""JSON ingest that loses no value.

Lines are read as text and parsed twice: into the remembered fields, and into a
map of all fields as they stand in the line. Whatever the typed columns do not
hold goes, row by row, into a ``rescued`` map: fields the schema lacks, values
that are not of their field's type, nested values whose typed form is not the
same JSON, and under ``LINE`` a whole line that is not just one JSON object. No file is looked at
beforehand, so it does not matter when a file arrives or how it is dated.

``learn`` adds the fields found in ``rescued`` to the remembered schema, and
``read_rescued`` shows them as columns for all rows, old ones included.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED, LINE = "rescued", "_line"
RAW = T.MapType(T.StringType(), T.StringType())
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _path(spark: SparkSession, name: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    fs, p = _path(spark, location.rstrip("/") + "/schema")
    if not fs.exists(p):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(p.toString(), wholetext=True).first()[0])["schema"])


def store_schema(spark: SparkSession, location: str, schema: T.StructType, **more) -> None:
    row = json.dumps({"schema": schema.jsonValue(), **more})
    (spark.createDataFrame([(row,)], "s string").coalesce(1)
     .write.mode("overwrite").text(location.rstrip("/") + "/schema"))


def _lost(field: T.StructField, typed: Column, raw: Column) -> Column:
    """Whether ``typed`` holds less than the field's ``raw`` text (NULL: there is nothing to hold)."""
    gone = raw.isNotNull() & typed.isNull()
    if isinstance(field.dataType, _NESTED):
        return gone | (F.to_json(typed) != raw)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return gone | raw.rlike(r"^-?[0-9]{16,}$")           # more digits than a double is sure to keep
    return gone


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns``, each worked out once a row. A plain projection
    would be copied into every later use, filters and lambdas included: dozens
    of parses of one line."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def parse_rescuing(lines: DataFrame, schema: T.StructType, column: str = "value", **options) -> DataFrame:
    """``lines`` of JSON text as the columns of ``schema`` plus ``rescued``
    (map of strings, NULL when everything fits)."""
    text = F.col(column)
    opts = {k: str(v) for k, v in options.items()}
    rows = _once(lines.where(F.length(F.trim(text)) > 0).select(text.alias("line")),
                 typed=F.from_json("line", schema, opts), raw=F.from_json("line", RAW))
    lost = F.array_compact(F.array(*[
        F.when(_lost(f, F.col("typed").getField(f.name), F.col("raw")[f.name]), F.lit(f.name)) for f in schema.fields]))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    kept = F.map_filter("raw", lambda k, v: v.isNotNull() & (
        ~F.array_contains(known, k) | F.array_contains(F.col("lost"), k)))
    whole = F.create_map(F.lit(LINE), F.col("line"))
    # the parser stops at the end of the first object; text after it must not go with it
    more = ~F.col("line").rlike(r"\}\s*$") | F.col("line").rlike(r"\}\s*\{")
    rest = F.when(F.col("raw").isNull(), whole).when(more, F.map_concat(whole, kept)).when(F.size(kept) > 0, kept)
    columns = [F.when(F.col("raw").isNotNull(), F.col("typed").getField(f.name)).alias(f.name) for f in schema.fields]
    return _once(rows, lost=lost).select(*columns, rest.alias(RESCUED))


def refusing(df: DataFrame) -> DataFrame:
    """``df`` without ``rescued``, failing on the first row that has any."""
    what = F.concat(F.lit("fields that the schema does not hold: "),
                    F.array_join(F.map_keys(RESCUED), ", "))
    fits = F.when(F.col(RESCUED).isNull(), F.lit(True)).otherwise(F.raise_error(what).cast("boolean"))
    return df.where(fits).drop(RESCUED)


def _type_of(n: str) -> Column:
    """The narrowest type that holds all values of a field."""
    fits = [(t, F.count_if(F.expr(f"try_cast({n} AS {t})").isNull()) == 0) for t in ("bigint", "double", "boolean")]
    out = F.lit("string")
    for t, all_fit in reversed(fits):
        out = F.when(all_fit, F.lit(t)).otherwise(out)
    return out


def new_fields(table: DataFrame, schema: T.StructType) -> DataFrame:
    """(field, type) of the rescued fields that ``schema`` lacks: one row a field."""
    have = [f.name for f in schema.fields] + [LINE]
    return (table.where(F.col(RESCUED).isNotNull()).select(F.explode(RESCUED).alias("field", "v"))
            .where(~F.col("field").isin(have)).groupBy("field").agg(_type_of("v").alias("type")))


def learn(spark: SparkSession, target: str, location: str) -> T.StructType:
    """Adds the fields that rows of the table at ``target`` brought along to the
    schema remembered at ``location``; streams started later load them as columns."""
    schema = load_schema(spark, location)
    found = new_fields(read_rescued(spark, target, location, promote=False), schema).orderBy("field").collect()
    if found:                                # as many rows as there are new columns
        for r in found:
            schema = schema.add(r["field"], T.LongType() if r["type"] == "bigint" else T._parse_datatype_string(r["type"]))
        store_schema(spark, location, schema)
    return schema


def read_rescued(spark: SparkSession, target: str, location: str, promote: bool = True) -> DataFrame:
    """The table at ``target`` under the remembered schema. Rows loaded before a
    field was known show it from their rescued map, where it then no longer
    stands; what is not of its field's type stays there."""
    schema = load_schema(spark, location)
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(RESCUED, RAW)])).parquet(target)
    if not promote:
        return df
    simple = [f for f in schema.fields if not isinstance(f.dataType, _NESTED)]
    shown = {f.name: F.coalesce(F.col(f"`{f.name}`"), F.expr(
        f"try_cast({RESCUED}[{_quoted(f.name)}] AS {f.dataType.simpleString()})")) for f in simple}
    cast = {f.name: F.expr(f"try_cast({RESCUED}[{_quoted(f.name)}] AS {f.dataType.simpleString()})").isNotNull()
            for f in simple if isinstance(f.dataType, (*_WHOLE, T.StringType, T.BooleanType))}
    done = F.array_compact(F.array(*[F.when(ok, F.lit(n)) for n, ok in cast.items()])) if cast else \
        F.array().cast("array<string>")
    left = F.map_filter(RESCUED, lambda k, v: ~F.array_contains(F.col("__done"), k))
    return (df.withColumn("__done", done)
            .withColumns({**shown, RESCUED: F.when(F.size(left) > 0, left)}).drop("__done"))


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
