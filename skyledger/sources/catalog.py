"""Named tables on a shared folder (IO7, IO8, IO9).

Layout: ``<base>/<name>/`` is a parquet table; ``<base>/_properties/<name>/``
holds one JSON row ``{name, layer, comment, written_at}``.  Everything is
written by Spark, so ``base`` can be any Hadoop file system path.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

# The tables a client may ask for by name.
GOLD_TABLE_NAMES = [
    "orbital_census",
    "congestion_metrics",
    "country_leaderboard",
    "constellation_growth",
    "decay_tracker",
    "globe_data",
]
LAYERS = ("bronze", "silver", "gold")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def write_table(df: DataFrame, base: str, name: str, layer: str,
                comment: str = "", partition_by: list[str] | None = None) -> str:
    """Overwrite table ``name`` under ``base`` and record its layer tag."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    path = table_path(base, name)
    w = df.write.mode("overwrite")
    if partition_by:
        # Replace only the partitions present in ``df`` (e.g. today's
        # snapshot); earlier snapshots stay readable with partition pruning.
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    props = df.sparkSession.createDataFrame(
        [(name, layer, comment, _dt.datetime.now(_dt.timezone.utc).isoformat())],
        "name string, layer string, comment string, written_at string")
    props.coalesce(1).write.mode("overwrite").json(table_path(base, f"_properties/{name}"))
    return path


def read_layer(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan a table written by :func:`write_table` (IO7)."""
    return spark.read.parquet(table_path(base, name))


def table_properties(spark: SparkSession, base: str, name: str) -> dict:
    row = spark.read.json(table_path(base, f"_properties/{name}")).first()
    return row.asDict() if row else {}


def load_gold(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Gold table by name; names outside the published list are rejected (IO8)."""
    if name not in GOLD_TABLE_NAMES:
        raise ValueError(f"invalid table name: {name!r}")
    return read_layer(spark, base, name)


def read_snapshot(spark: SparkSession, base: str, name: str, snapshot_date: str) -> DataFrame:
    """One snapshot of a table partitioned by ``snapshot_date`` (partition pruning:
    only that directory is listed and read)."""
    from pyspark.sql import functions as F
    return (read_layer(spark, base, name)
            .where(F.col("snapshot_date") == F.lit(snapshot_date).cast("date")))
