"""Landing files: one JSON envelope per file (IO1-IO6 support).

Envelope: ``{source, dataset, collected_at, record_count, data: [record...]}``.
Records carry the feed's fields as JSON strings (or null).

``write_envelopes`` produces landing files from a DataFrame of records with
Spark (used to land derived feeds and in tests).  ``ENVELOPE`` reads records as
raw text and ``record_fields`` opens them, for the stream in
:mod:`skyledger.streaming.bronze`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

DEFAULT_MAX_RECORDS = 100_000  # records per envelope file (bounds one group)


CORRUPT = "_corrupt"

# Records stay raw text here: whatever their fields and types, nothing is lost.
ENVELOPE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("data", T.ArrayType(T.StringType())),
    T.StructField(CORRUPT, T.StringType()),
])


# A file is one JSON document, read as one "line": no text holds this separator.  The
# parser then has the file's bytes at hand and cuts each record's raw text out of them;
# with ``multiLine`` it opens the file anew for every record.
WHOLE_FILE = "\u0000\u0001\u0000\u0002" * 4
ENVELOPE_FILES = {"lineSep": WHOLE_FILE, "columnNameOfCorruptRecord": CORRUPT,
                  "recursiveFileLookup": "true"}


def write_envelopes(records: DataFrame, path: str, dataset: str, fields: Sequence[str],
                    collected_at: Column, seq: Column, order: Sequence[Column] = (),
                    source: str = "spacetrack",
                    max_records: int = DEFAULT_MAX_RECORDS) -> None:
    """Write ``records[fields]`` as envelope files under ``path/collection=<ts>/``.

    One file per (collection time, ``seq // max_records``): a file never holds
    more than ``max_records`` records, whatever the data volume, because
    ``seq`` is unique.  Inside a file, records follow ``order`` then ``seq``.
    Null fields are written as JSON null so every field survives inference.  A record is
    text before it is sorted, so fields of any type can land, VARIANT too.
    """
    keyed = records.select(
        F.date_format(collected_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("_collected_at"),
        F.floor(seq / F.lit(max_records)).alias("_chunk"),
        # flat: a struct in a struct gets an ordering of its own for each comparison
        F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], seq.alias("_seq"),
                 F.to_json(F.struct(*[F.col(c) for c in fields]),
                           {"ignoreNullFields": "false"}).alias("_r")).alias("_item"))
    docs = (keyed.groupBy("_collected_at", "_chunk")
            .agg(F.array_sort(F.collect_list("_item")).alias("_items"))
            .select(
                F.col("_collected_at").alias("collection"),
                F.concat(
                    F.regexp_replace(F.to_json(F.struct(
                        F.lit(source).alias("source"), F.lit(dataset).alias("dataset"),
                        F.col("_collected_at").alias("collected_at"),
                        F.size("_items").cast("long").alias("record_count"))), r"\}$", ""),
                    F.lit(',"data":['), F.array_join(F.transform("_items", lambda x: x["_r"]), ","),
                    F.lit("]}")).alias("value"),
                "_chunk"))
    # One envelope document per file (``maxRecordsPerFile`` = 1 row = 1 doc).
    (docs.drop("_chunk").write.mode("append").option("maxRecordsPerFile", 1)
         .partitionBy("collection").text(path))


def record_fields(raw: str) -> Column:
    """All fields of a raw record as text, by name; null if it is not an object."""
    return F.from_json(F.col(raw), "map<string,string>")


def field_names(spark: SparkSession, path: str, files: int | None = None) -> list[str]:
    """Names of the record fields in all landed envelopes (IO5), or in the first
    ``files`` of them by path, in the order of their first position in a record, then
    by name; none if nothing has landed or all collections are empty."""
    if not path_exists(spark, path):
        return []
    paths = [path]
    if files is not None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path) \
            .select("path").orderBy("path").limit(files)
        paths = [r.path for r in listed.collect()]  # ``files`` rows at most
        if not paths:
            return []
    env = spark.read.schema(ENVELOPE).options(**ENVELOPE_FILES).json(paths)
    fields = env.select(F.explode("data").alias("raw")) \
        .select(F.posexplode(F.map_keys(record_fields("raw"))).alias("at", "name"))
    found = fields.groupBy("name").agg(F.min("at").alias("at")).collect()  # one row a field
    return [r.name for r in sorted(found, key=lambda r: (r["at"], r["name"]))]
