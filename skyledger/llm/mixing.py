"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words.  The whole part of the target over the source's
words is allocated to each of its documents with certainty.  The rest is sampled:
a document's inclusion probability is the share of words still missing, times its
importance over the source's mean (weighed by words, so that the expected words are
the missing ones).  By default the importance is the square root of the number of
words; a column may give it instead.  Documents are ranked by their random odds over
their inclusion odds (Pareto order sampling), and the smallest ranks are taken until
the missing words are filled: a sample of fixed size with unequal probabilities.

The cut in each source's order is found without sorting the source: words are
summed over the leading digits of the rank (two levels of ``BINS`` bins), which
leaves one bin of about n / BINS**2 documents to be ordered by a window.  Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ROW, WORDS, addressed, store, table, text_or_empty

WEIGHTS = (5, 2, 1)    # of the sources in code point order, repeating
MAX_COPIES = 3         # of a document, and of a source's own words
BINS = 4096
# Inclusion odds are taken of probabilities within these bounds: no document is quite
# sure of its place, and ranks spread over the bins also where next to none or nearly
# all documents are sampled.
ODDS_BOUNDS = (0.001, 0.999)
IMPORTANCE_STEPS = 16   # of one unit: importance is a whole number of steps, 1 at least
SEED = 20240


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORDS)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_copies: int = MAX_COPIES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Targets of ``sources`` (source, source_size): shares of all words by
    weight, held at ``max_copies`` times the source's words, the excess shared
    again by weight until none is above.

    With sources ordered by cap over weight, the words for one unit of weight
    after holding the first i sources rise until the right i and fall beyond it,
    so their maximum is the final level.  One row per source passes the window.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    order = W.orderBy("ratio", "source_no")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    later = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    cap = F.col("source_size") * F.lit(float(max_copies))
    return (
        sources.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[
            (F.col("source_no") - 1) % len(weights)])
        .withColumns({"cap": cap, "ratio": cap / F.col("weight")})
        .withColumn("level", (F.sum("source_size").over(everything)
                              - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                    / F.sum("weight").over(later))
        .withColumn("target", F.least(
            "cap", F.max("level").over(everything) * F.col("weight")))
        .select("source_no", "source", "source_size", "target", *keep))


def draws(df: DataFrame, key: str, text: str, seed: int) -> Column:
    """A random number of each addressed row, by key, text, the name of its file and its
    place in it: the same in every run over the same files, and different for equal
    rows, so these are dealt over all ranks like any others."""
    return F.xxhash64(F.lit(seed), F.col(key), text_or_empty(text),
                      F.substring_index(F.col(ROW), "/", -1))


def inclusion(share: Column, importance: Column, mean: Column) -> Column:
    """Inclusion probability of a document, within the bounds."""
    return F.least(F.greatest(share * importance / mean, F.lit(ODDS_BOUNDS[0])),
                   F.lit(ODDS_BOUNDS[1]))


def _boundary(ranked: DataFrame, within: list[str], bin_: str) -> DataFrame:
    """The bin of each source in which the missing words run out, and the words
    of the bins before it: ``within`` + ``bin_`` + ``before``."""
    words = ranked.groupBy(*within, "missing", bin_).agg(F.sum("size").alias("words"),
                                                         F.first("start").alias("start"))
    order = W.partitionBy(*within).orderBy(bin_).rowsBetween(W.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("words").over(order), F.lit(0))
    return (words.withColumn("before", before)
            .where("before <= missing AND missing < before + words")
            .select(*within, bin_, "before"))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        carry: tuple[str, ...] = (), weights: tuple[float, ...] = WEIGHTS,
        max_copies: int = MAX_COPIES, seed: int = SEED,
        importance: str | None = None) -> DataFrame:
    """Copies of each row in a mix of as many words as the table has.

    Returns one row per input row: ``carry``, ``doc_id``, ``size`` (words),
    ``source_size``, ``target``, ``copies`` (0 to ``max_copies``) and ``taken``
    (words of the copies); other columns are left out, so none can clash
    (``carry`` must not name these).  Null texts have size 0; a null source is a
    source of its own, after all others.  ``importance`` names a column to sample by;
    null, NaN, zero and negative values count as the least.  Ranks come from a hash of
    key, text, seed and the row's place: reruns over the same files agree, and equal
    rows have ranks of their own.  A source without words has target 0 and no copies.
    An empty table gives no rows.
    """
    if ROW not in carry:
        own = [key, source, text, *([importance] if importance else [])]
        df = addressed(df.select(*dict.fromkeys([*own, *carry])))
    size = word_count(text)
    pull = F.sqrt(size) if importance is None else \
        F.coalesce(F.nanvl(F.col(importance).cast("double"), F.lit(0.0)), F.lit(0.0))
    steps = F.floor(F.least(pull, F.lit(1e9)) * IMPORTANCE_STEPS)
    sized = store(df.select(
        *carry, F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
        size.alias("size"), F.greatest(steps, F.lit(1)).alias("importance"),
        draws(df, key, text, seed).alias("draw")), "mix-sizes")
    # exact sums: a source's mean importance does not depend on the order of its rows
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("importance").cast("decimal(20,0)") * F.col("size")).cast("double").alias("pull"))
    targets = store(source_targets(sums, weights, max_copies, ("pull",)), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")) \
        .otherwise(F.lit(0.0))
    # random odds over inclusion odds, brought into [0, 1) as x / (1 + x)
    u = (F.pmod("draw", F.lit(2 ** 52)) + 0.5) / 2 ** 52
    share = inclusion(F.col("expected") - F.col("whole"), F.col("importance"),
                      F.when(F.col("pull") > 0, F.col("pull") / F.col("source_size")).otherwise(1.0))
    pareto = (u / (1 - u)) / (share / (1 - share))
    ranked = (
        sized.join(targets.withColumnRenamed("source", "name"),
                   F.col("source").eqNullSafe(F.col("name")))
        .withColumn("expected", expected)
        .withColumn("whole", F.floor("expected"))
        .withColumn("missing", F.greatest(
            F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
        .withColumn("rank", pareto / (1 + pareto))
        .withColumn("bin1", F.floor(F.col("rank") * BINS))
        .withColumn("bin2", F.floor(F.col("rank") * BINS * BINS) - F.col("bin1") * BINS)
        .select(*carry, "doc_id", "size", "source_no", "source_size", "target", "whole",
                "missing", "rank", "bin1", "bin2"))
    ranked = store(ranked, "mix-ranks")
    first = store(_boundary(ranked.withColumn("start", F.lit(0)), ["source_no"], "bin1"),
                  "mix-bins")
    inside = ranked.join(first.withColumnRenamed("before", "start"), ["source_no", "bin1"])
    cut = store(_boundary(inside, ["source_no", "bin1"], "bin2"), "mix-cut")
    cut = cut.select("source_no", F.col("bin1").alias("cut1"), F.col("bin2").alias("cut2"),
                     "before")
    rows = ranked.join(cut, "source_no", "left")
    at_cut = F.coalesce((F.col("bin1") == F.col("cut1")) & (F.col("bin2") == F.col("cut2")),
                        F.lit(False))
    below = F.when(F.col("cut1").isNull(), F.col("missing") > 0).otherwise(
        (F.col("bin1") < F.col("cut1"))
        | ((F.col("bin1") == F.col("cut1")) & (F.col("bin2") < F.col("cut2"))))
    # in the last bin: a document is taken while half of it or more is missing
    order = W.partitionBy("source_no").orderBy("rank", "doc_id", "size") \
        .rowsBetween(W.unboundedPreceding, -1)
    reached = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    last = rows.where(at_cut).withColumn(
        "one", F.col("missing") - reached >= F.col("size") / 2)
    out = rows.where(~at_cut).withColumn("one", below).unionByName(last)
    copies = F.col("whole") + F.col("one").cast("long")
    return out.select(*carry, "doc_id", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).drop("copies")
