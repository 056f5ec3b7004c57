"""Types of landed records, inferred with VARIANT (IO5).

Records are parsed once into VARIANT values, which keep each field's own type.  The
schema of all of them is one mergeable aggregate (``schema_of_variant_agg``), so
inference reads every record of every file, in one pass and without a sample.  A schema
only ever widens: whole numbers to decimals and doubles, and what fits no common type to
VARIANT itself, from which any value can still be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from .envelopes import CORRUPT, ENVELOPE

VARIANT_ENVELOPE = T.StructType(
    [f if f.name != "data" else T.StructField("data", T.ArrayType(T.VariantType()))
     for f in ENVELOPE.fields])


def landed_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all landed envelopes: ``record`` (VARIANT), its file and position."""
    env = (spark.read.schema(VARIANT_ENVELOPE).option("multiLine", True)
           .option("columnNameOfCorruptRecord", CORRUPT)
           .option("recursiveFileLookup", True).json(path))
    return env.select(F.posexplode("data").alias("_record_index", "record"),
                      F.col("_metadata.file_path").alias("_source_file"),
                      F.col("collected_at").alias("_collected_at"))


def _type(text: str) -> T.DataType:
    """A type as ``schema_of_variant_agg`` writes it; numbers with a fraction are read as
    doubles, a field that is always null as text."""
    return _relaxed(T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")))


def _relaxed(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _relaxed(f.dataType)) for f in t.fields]) \
            if t.fields else T.VariantType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_relaxed(t.elementType))
    if isinstance(t, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    return T.StringType() if isinstance(t, T.NullType) else t


def schema_of_records(records: DataFrame, column: str = "record") -> T.StructType:
    """Schema of all VARIANT objects in ``column``, fields in order of name; empty if there
    are none or if some are no objects."""
    text = records.agg(F.schema_of_variant_agg(column).alias("s")).first().s
    if not text or not text.startswith("OBJECT<") or text == "OBJECT<>":
        return T.StructType([])
    return _type(text)


def infer_record_schema(spark: SparkSession, path: str) -> T.StructType:
    """Names and types of the fields of all records landed under ``path``."""
    if not path_exists(spark, path):
        return T.StructType([])
    return schema_of_records(landed_records(spark, path))


def widen(old: T.DataType, new: T.DataType) -> T.DataType:
    """The narrowest type that holds values of both: equal types stay, whole numbers
    widen to doubles, structs and arrays field by field, anything else is VARIANT."""
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        by_name = {f.name: f.dataType for f in new.fields}
        fields = [T.StructField(f.name, widen(f.dataType, by_name.pop(f.name, f.dataType)))
                  for f in old.fields]
        return T.StructType(fields + [f for f in new.fields if f.name in by_name])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widen(old.elementType, new.elementType))
    whole, number = (T.IntegerType, T.LongType), (T.IntegerType, T.LongType, T.DoubleType)
    if isinstance(old, whole) and isinstance(new, whole):
        return T.LongType()
    if isinstance(old, number) and isinstance(new, number):
        return T.DoubleType()
    return T.VariantType()


def field(record: str | Column, name: str, kind: T.DataType) -> Column:
    """Field ``name`` of a VARIANT object as ``kind``; null where it is missing or doesn't fit."""
    if '"' in name:   # such a name can't be written in a path
        members = F.try_variant_get(record, "$", "map<string,variant>")
        return F.try_variant_get(members[F.lit(name)], "$", kind.simpleString()).alias(name)
    return F.try_variant_get(record, f'$["{name}"]', kind.simpleString()).alias(name)


def typed_records(records: DataFrame, schema: T.StructType, column: str = "record",
                  keep: list[str] | None = None) -> DataFrame:
    """The fields of ``schema`` as columns of their types, and the columns ``keep``."""
    return records.select(*[field(column, f.name, f.dataType) for f in schema.fields],
                          *(keep or []))
