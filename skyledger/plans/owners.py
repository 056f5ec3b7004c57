"""Owner enrichment (X8) over bucketed tables.

The daily job joins the object table, rewritten each day, with an owner table that
changes quarterly.  Both are stored bucketed and sorted by object id with the same
number of buckets, so the join shuffles neither side; each bucket is merged by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import lenient
from ..operators.dedup import latest_per_key

BUCKETS = 32
OWNER_COLUMNS = ["operator", "operator_country", "purpose", "launch_mass_kg"]


def clean_owners(raw: DataFrame) -> DataFrame:
    """Typed owner rows, one an object: the last by ``_seq``."""
    typed = raw.select(lenient("NORAD_CAT_ID", "int").alias("norad_cat_id"), "operator",
                       "operator_country", "purpose",
                       lenient("launch_mass_kg", "double").alias("launch_mass_kg"), "_seq") \
        .where(F.col("norad_cat_id").isNotNull())
    return latest_per_key(typed, ["norad_cat_id"], [F.desc("_seq")]).drop("_seq")


def store_bucketed(df: DataFrame, name: str, path: str, key: str = "norad_cat_id",
                   buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path``, bucketed and sorted by ``key``, one file
    a bucket.  (Spark sorts a bucket again before a merge, which is cheap on sorted rows.)"""
    spark: SparkSession = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return spark.table(name)


def enrich_owners(objects: DataFrame, owners: DataFrame) -> DataFrame:
    """Objects with their owner's columns (null without an owner).  Give both as tables
    of :func:`store_bucketed`; the merge hint keeps the plan free of broadcasts of an
    owner table that may grow."""
    return objects.join(owners.hint("merge"), "norad_cat_id", "left")


def owner_summary(enriched: DataFrame) -> DataFrame:
    """Objects, active payloads and the mean launch mass by operator country and purpose."""
    return enriched.groupBy("operator_country", "purpose").agg(
        F.count(F.lit(1)).alias("objects"), F.count_if(F.coalesce("is_active", F.lit(False))).alias("active"),
        F.round(F.avg("launch_mass_kg"), 6).alias("avg_launch_mass_kg"))
