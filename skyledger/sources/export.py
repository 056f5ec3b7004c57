"""Gold -> JSON export (IO10-IO14).

Layout under ``base``::

    <table>.json/part-*      records, one JSON object per line (distributed write)
    _headers/name=<table>/   one JSON row {table, exported_at, row_count, path}
    _manifest/               one JSON row {exported_at, tables, endpoints, total_rows}

The endpoints of the manifest are paths below ``base`` that a reader can open.

Design at scale: records are written by the executors in parallel; the row
count is taken by an ``Observation`` on the same job (no second ``count()``
pass, nothing pulled to the driver); the byte sizes come from one file listing
of what was written (``binaryFile`` source with the content column pruned).
Every table has this one form, whatever its size; tables are written side by side.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_DATE = "yyyy-MM-dd"
WRITERS = 4   # tables written at a time


@dataclass
class ExportResult:
    table: str
    rows: int
    bytes: int
    path: str


def _now_iso() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row: number of files and total bytes under ``path`` (IO14).

    Only ``path`` and ``length`` are selected, so file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "length")
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("total_bytes"))


def endpoint(name: str) -> str:
    """Path of a table's records below the export's base."""
    return f"{name}.json"


def _write_json(df: DataFrame, base: str, name: str) -> int:
    """Write ``df`` as JSON lines under its endpoint; the number of rows written."""
    obs = Observation(f"export_{name}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite")
       .option("timestampFormat", ISO_TS).option("timestampNTZFormat", ISO_TS)
       .option("dateFormat", ISO_DATE).option("ignoreNullFields", False)
       .json(f"{base.rstrip('/')}/{endpoint(name)}"))
    return int(obs.get["rows"])


def _finish(spark: SparkSession, base: str, rows: dict[str, int]) -> list[ExportResult]:
    """Sizes of the written tables by one listing, and their header rows in one write."""
    paths = {name: f"{base.rstrip('/')}/{endpoint(name)}" for name in rows}
    if not rows:
        return []
    table = F.element_at(F.split("path", "/"), -2)
    sizes = {r.folder: r.bytes for r in
             spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
             .load(list(paths.values())).select(table.alias("folder"), "length")
             .groupBy("folder").agg(F.sum("length").alias("bytes")).collect()}  # one row a table
    results = [ExportResult(n, rows[n], int(sizes.get(endpoint(n), 0)), paths[n]) for n in rows]
    headers = spark.createDataFrame(
        [(r.table, r.table, _now_iso(), r.rows, endpoint(r.table)) for r in results],
        "name string, table string, exported_at string, row_count long, path string")
    (headers.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("name").json(f"{base.rstrip('/')}/_headers"))
    return results


def export_json(df: DataFrame, base: str, name: str) -> ExportResult:
    """Write ``df`` as JSON lines under its endpoint, plus a header row (IO10, IO13)."""
    return _finish(df.sparkSession, base, {name: _write_json(df, base, name)})[0]


def read_export(spark: SparkSession, base: str, name: str, schema=None) -> DataFrame:
    """Read exported records back (with the original schema when given)."""
    r = spark.read.option("timestampFormat", ISO_TS).option("timestampNTZFormat", ISO_TS) \
        .option("dateFormat", ISO_DATE)
    if schema is not None:
        r = r.schema(schema)
    return r.json(f"{base.rstrip('/')}/{endpoint(name)}")


def export_manifest(spark: SparkSession, results: list[ExportResult]) -> DataFrame:
    """One-row manifest: table list, endpoint map and total rows (IO11)."""
    per_table = spark.createDataFrame(
        [(r.table, endpoint(r.table), r.rows, r.bytes) for r in results] or [("", "", 0, 0)],
        "table string, endpoint string, rows long, bytes long").where(F.col("table") != "")
    return per_table.agg(
        F.lit(_now_iso()).alias("exported_at"),
        F.coalesce(F.sort_array(F.collect_list("table")),
                   F.array().cast("array<string>")).alias("tables"),
        F.coalesce(F.map_from_entries(F.collect_list(
            F.struct("table", "endpoint"))),
            F.create_map().cast("map<string,string>")).alias("endpoints"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"))


class ExportError(RuntimeError):
    def __init__(self, errors: dict[str, str]):
        super().__init__(f"{len(errors)} table export(s) failed: {sorted(errors)}")
        self.errors = errors


def export_all(spark: SparkSession, tables: dict[str, DataFrame], base: str):
    """Export every table; keep going past failures, then raise if any failed (IO12).

    Returns ``(results, manifest_df)``; the manifest lists the tables that made it
    and is written under ``base/_manifest`` before any error is raised.
    """
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    with ThreadPoolExecutor(WRITERS) as pool:   # the writes don't depend on each other
        jobs = {name: pool.submit(inheritable_thread_target(spark)(_write_json), df, base, name)
                for name, df in tables.items()}
        for name, job in jobs.items():
            try:
                rows[name] = job.result()
            except Exception as e:  # noqa: BLE001 - collected and re-raised below
                errors[name] = str(e).splitlines()[0] if str(e) else type(e).__name__
    results = _finish(spark, base, rows)
    manifest = export_manifest(spark, results)
    manifest.coalesce(1).write.mode("overwrite").json(f"{base.rstrip('/')}/_manifest")
    if errors:
        raise ExportError(errors)
    return results, manifest
