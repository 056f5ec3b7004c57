"""Bronze: envelope files -> append-only raw tables, with Structured Streaming.

* ST1 each landed file is read exactly once: the file source records what it
  has processed in the query checkpoint, a rerun only picks up new files.
  Files count as new whatever their modification time (``MAX_FILE_AGE``);
* ST2 triggered, not continuous: ``trigger(availableNow=True)`` drains what
  is there (in ``max_files_per_trigger`` batches) and stops;
* ST3 stateless append: explode + flatten + lineage, ``outputMode append``.

Nothing that lands is lost.  A record is kept as the text of its fields: known
fields in columns of their own, all others in the map ``_rescued``.  A field
that is met for the first time is therefore in the table from its first file on;
it gets a column of its own from the next run, and :func:`read_bronze` gives it
one for the earlier rows too.  A field whose type changes stays text.  Silver
casts every field, so text loses nothing.

Each run writes a partition of its own (``_run``).  ``_status`` is ``ok`` for a
record, ``empty`` for an envelope without records, ``corrupt`` for a file or a
record that does not parse and ``count`` for records of a file that does not
hold as many as it says.  Only ``ok`` rows are read as bronze; a run that met
corrupt files fails after the good ones are written.

Lineage columns: ``_source_file`` (file path), ``_record_index`` (position in
the envelope), ``_collected_at`` (the envelope's collection time) and
``_ingestion_ts`` (micro-batch time).  ``(_source_file, _record_index)`` is
unique, so downstream "newest per key" never has to break ties arbitrarily.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, settings
from ..sources.envelopes import CORRUPT, ENVELOPE, ENVELOPE_FILES, field_names, record_fields

LINEAGE = ["_source_file", "_record_index", "_collected_at", "_ingestion_ts"]
FIRST_FILES = 8           # files that the first run takes the fields' columns from
LISTING_TASKS = 4         # a core, at most
MAX_FILE_AGE = "36500d"   # older than any history that is loaded after the fact


def _fields_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/_record_fields"


def load_fields(spark: SparkSession, checkpoint: str) -> list[str]:
    """Field names known after the runs so far, in the order they were met."""
    if not path_exists(spark, _fields_path(checkpoint)):
        return []
    rows = spark.read.schema("run long, position int, name string") \
        .json(_fields_path(checkpoint)).collect()  # one row a field
    return list(dict.fromkeys(r.name for r in sorted(rows)))


def save_fields(spark: SparkSession, checkpoint: str, known: list[str], new: list[str]) -> None:
    """Append newly met names; earlier files are never rewritten."""
    if new:
        (spark.createDataFrame([(len(known), i, n) for i, n in enumerate(new)],
                               "run long, position int, name string").coalesce(1)
              .write.mode("append").json(_fields_path(checkpoint)))


def envelope_stream(spark: SparkSession, landing: str, fields: list[str],
                    max_files_per_trigger: int | None = None,
                    max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Streaming DataFrame of flattened records with lineage (IO1-IO4): a text
    column for each of ``fields``, ``_rescued`` and ``_status``."""
    reader = spark.readStream.schema(ENVELOPE).options(**ENVELOPE_FILES) \
        .option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    env = reader.json(landing)
    found = F.coalesce(F.size("data"), F.lit(0))
    # all that is taken from a whole file comes before the explode: a record's row that
    # still needs ``data`` would carry a copy of its file's records
    files = env.select(
        "data", F.col("_metadata.file_path").alias("_source_file"),
        F.col("collected_at").alias("_collected_at"),
        F.col(CORRUPT).isNotNull().alias("_broken"), found.alias("_found"),
        F.coalesce("record_count", found).alias("_stated"))
    records = files.select(
        F.posexplode_outer("data").alias("_record_index", "_raw"),
        "_source_file", "_collected_at", "_broken", "_found", "_stated")
    m = record_fields("_raw")
    others = F.map_filter("_m", lambda k, _: ~k.isin(fields)) if fields else F.col("_m")
    return (records.withColumn("_m", m).select(
        *[F.col("_m")[F.lit(n)].alias(n) for n in fields],
        F.when(F.size(others) > 0, others).alias("_rescued"),
        F.when(F.col("_broken") | (F.col("_raw").isNotNull() & F.col("_m").isNull()), "corrupt")
         .when(F.col("_found") != F.col("_stated"), "count")
         .when(F.col("_raw").isNull(), "empty").otherwise("ok").alias("_status"),
        "_source_file", "_record_index", "_collected_at")
        .withColumn("_ingestion_ts", F.current_timestamp()))


@dataclass
class IngestResult:
    envelopes: int      # files (one envelope each) read by this run
    records: int        # good records of this run
    schema: T.StructType


class CorruptEnvelopes(RuntimeError):
    """Raised after a run that met broken files; their rows stay in the table
    under their status (:func:`read_quarantine`)."""

    def __init__(self, files: int, example: str):
        super().__init__(f"{files} broken envelope file(s), such as {example}")
        self.files = files


def _listing_settings(spark: SparkSession) -> dict[str, str]:
    """A batch's files are listed by a few tasks a core.  Spark's default is a task a file,
    up to 10,000, which the driver deals out one by one."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    return {name: str(min(int(spark.conf.get(name, "10000")), tasks))}


def ingest_envelopes(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                     max_files_per_trigger: int | None = None,
                     max_file_age: str = MAX_FILE_AGE) -> IngestResult:
    """Drain new envelope files under ``landing`` into the parquet table ``bronze``.

    Counts come from the rows of the run itself, however many micro-batches it
    took.  Raises :class:`CorruptEnvelopes` at the end if a file was broken.
    """
    known = load_fields(spark, checkpoint)
    if not known:  # first run: columns from the first files; other fields are rescued
        known = field_names(spark, landing, FIRST_FILES)
        save_fields(spark, checkpoint, [], known)
    run = uuid.uuid4().hex
    rows = envelope_stream(spark, landing, known, max_files_per_trigger, max_file_age) \
        .withColumn("_run", F.lit(run))
    with settings(spark, _listing_settings(spark)):
        q = (rows.writeStream.format("parquet")
             .option("path", bronze)
             .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
             .partitionBy("_run")
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()  # the source takes settings from the session at each batch
    written = f"{bronze.rstrip('/')}/_run={run}"
    if not path_exists(spark, written):
        return IngestResult(0, 0, record_schema(known))
    rows = spark.read.parquet(written)
    total = run_totals(rows).first()
    new = sorted(r.k for r in rows.select(F.explode(F.map_keys("_rescued")).alias("k"))
                 .distinct().collect()) if total.rescued else []  # one row a new field
    save_fields(spark, checkpoint, known, new)
    if total.broken:
        raise CorruptEnvelopes(total.broken, total.example)
    return IngestResult(total.files, total.records, record_schema(known + new))


def run_totals(rows: DataFrame) -> DataFrame:
    """One row: files, good records, rescued rows and broken files of a run.  Counted by
    file first, so that distinct files are counted over one row a file."""
    bad = F.col("_status").isin("corrupt", "count")
    files = rows.groupBy("_source_file").agg(
        F.count_if(F.col("_status") == "ok").alias("ok"),
        F.count("_rescued").alias("rescued"), F.count_if(bad).alias("bad"))
    broken = F.when(F.col("bad") > 0, F.col("_source_file"))
    return files.agg(F.count("_source_file").alias("files"),
                     F.coalesce(F.sum("ok"), F.lit(0)).alias("records"),
                     F.coalesce(F.sum("rescued"), F.lit(0)).alias("rescued"),
                     F.count(broken).alias("broken"), F.min(broken).alias("example"))


def record_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_OWN = T.StructType([
    T.StructField("_rescued", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_status", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_record_index", T.IntegerType()),
    T.StructField("_collected_at", T.StringType()),
    T.StructField("_ingestion_ts", T.TimestampType()),
])


def read_bronze(spark: SparkSession, bronze: str,
                schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a bronze table: the good records' fields and lineage.

    With ``schema`` (``IngestResult.schema``) no file footers are merged.  Without
    it, the fields are those of all files and rescued maps.  A field that was
    rescued before it had a column is read from the map.
    """
    if schema is None:
        found = spark.read.option("mergeSchema", True).parquet(bronze)
        own = {f.name for f in _OWN.fields} | {"_run"}
        names = [c for c in found.columns if c not in own]
        late = found.select(F.explode(F.map_keys("_rescued")).alias("k")).distinct().collect()
        names += sorted({r.k for r in late} - set(names))
        schema = record_schema(names)
    rows = spark.read.schema(T.StructType(list(schema.fields) + list(_OWN.fields))).parquet(bronze)
    return rows.where("_status = 'ok'").select(
        *[F.coalesce(F.col(f"`{f.name}`"), F.col("_rescued")[F.lit(f.name)]).alias(f.name)
          for f in schema.fields], *LINEAGE)


def read_quarantine(spark: SparkSession, bronze: str) -> DataFrame:
    """Rows of broken files and records: status, file, position and what was read."""
    rows = spark.read.option("mergeSchema", True).parquet(bronze)
    fields = [c for c in rows.columns if c not in {f.name for f in _OWN.fields} | {"_run"}]
    return rows.where(F.col("_status").isin("corrupt", "count")) \
        .select("_status", "_source_file", "_record_index", "_rescued", *fields)
