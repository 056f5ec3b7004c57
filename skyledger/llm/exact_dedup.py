"""Exact duplicates by distributed MSD radix partitioning.

A document's radix string is the length of its normalised text followed by its
bytes, so that all members of a group end at the same place.  Each level splits
the groups of the level before by the next bytes (the digit).  A group leaves
when it is a singleton or when its texts have ended; equality is decided by the
bytes themselves, never by a digest.

Digits grow by ``GROWTH`` a level: the number of levels follows the logarithm of
the longest text, and a document's text takes part only while another document
shares all of its earlier bytes.  A level counts its groups with a map-side
aggregate, stores those of several members and joins them back: a group with a
third of all rows is pre-aggregated before its shuffle, and in the join, between
two plain shuffles, the skew join splits it.  These tables grow with the corpus,
so they are merge-joined at every size rather than broadcast while they are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, store, table, text_or_empty

FIRST_DIGIT = 32     # bytes split on at the first level, after the length
DIGIT = 4096         # bytes of the second level's digit
GROWTH = 16          # growth of the digit at each later level


def normalised(text: str = "text"):
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def _split(rows: DataFrame, end: int) -> DataFrame:
    """Split the groups of ``rows`` by ``digit``, which ends at byte ``end``: size
    and first row of each new group, and whether it is finished.  The text stays
    only with rows that go on."""
    groups = store(rows.groupBy("group", "digit").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "row")).alias("first"))
        .where("size > 1"), "radix-groups")
    size = F.coalesce("size", F.lit(1))
    done = (size == 1) | (F.col("bytes") <= end)
    return rows.drop("size", "first").join(
        groups.hint("merge"), ["group", "digit"], "left").select(
        *[c for c in rows.columns if c not in ("group", "digit", "norm", "size", "first", "done")],
        size.alias("size"), F.coalesce("first", F.struct("doc_id", "row")).alias("first"),
        done.alias("done"), F.when(~done, F.col("norm")).alias("norm"))


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Group rows whose texts are equal after white-space normalisation.

    Returns one row per input row: ``carry``, ``doc_id``, ``keep_id`` (smallest
    key of the group), ``group_size``, ``kept`` and ``text_sha256``; other
    columns are left out, so none can clash (``carry`` must not name these).
    Null texts count as empty, and all empty texts are one group.  A null key
    comes before all others.  Of repeated rows with the smallest key, exactly one
    has ``kept``.  An empty table gives no rows.
    """
    rows = df.select(*carry, F.col(key).alias("doc_id"), normalised(text).alias("norm"))
    rows = rows.select("*", F.sha2("norm", 256).alias("text_sha256"),
                       F.octet_length("norm").alias("bytes"),
                       F.col("norm").cast("binary").substr(1, FIRST_DIGIT).alias("head"))
    # Level 0 only counts: the number of a row is taken once, on the stored side.
    groups = store(rows.groupBy("bytes", "head").agg(F.count(F.lit(1)).alias("size"))
                   .where("size > 1"), "radix-groups")
    level = store(
        rows.withColumn("row", F.monotonically_increasing_id())
            .join(groups.hint("merge"), ["bytes", "head"], "left")
            .withColumn("size", F.coalesce("size", F.lit(1)))
            .withColumn("norm", F.when(F.col("size") > 1, F.col("norm"))), "radix-0")
    finished = [level.where("size = 1").withColumn("first", F.struct("doc_id", "row"))]
    active = level.where("size > 1").withColumn("group", F.struct("bytes", "head")).drop("head")
    end, width, n = FIRST_DIGIT, DIGIT, 0
    while not active.isEmpty():
        n += 1
        digit = F.col("norm").cast("binary").substr(end + 1, width)
        end, width = end + width, width * GROWTH
        level = store(_split(active.withColumn("digit", digit), end), f"radix-{n}")
        finished.append(level.where("done"))
        active = level.where("NOT done").withColumn("group", F.col("first.row"))
    parts = [part.select(
        *carry, "doc_id", F.col("first.doc_id").alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256") for part in finished]
    return reduce(DataFrame.unionAll, parts)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
