"""The corpus pipeline: five stages, each an operator of ``skyledger.llm``.

Every stage works on all that the stage before it kept, and its decisions take
effect: rejected rows go, duplicates go, copies of the mix are repeated.  All but
the last return the columns of ``documents``.  Rows are told apart by their
address in the stage's input, so that repeated rows and clashing or extra columns
do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.bpe import default_vocabulary, encode
from skyledger.llm.common import ROW, addressed, store, without
from skyledger.llm.exact_dedup import exact_duplicates
from skyledger.llm.language_id import identify_documents, label
from skyledger.llm.mixing import mix
from skyledger.llm.near_dedup import near_duplicates
from skyledger.session import ensure_conf

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with the identified language as their ``lang`` where
    it differs from the declared one (which stays as it was written otherwise).  Null
    and empty texts, texts without letters and texts of no known language go; repeated
    rows are judged each, an empty table stays empty."""
    rows = addressed(docs)
    found = store(identify_documents(rows, [ROW]).select(
        ROW, F.col("accepted").alias("_accepted"), F.col("lang").alias("_found")), "languages")
    # as many rows as the documents: merge-joined at every size
    judged = rows.join(found.where("_accepted").hint("merge"), ROW)
    lang = F.when(label(F.col("lang")).eqNullSafe(F.col("_found")), F.col("lang")) \
        .otherwise(F.col("_found"))
    return judged.select(*[lang.alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest doc_id."""
    rows = addressed(docs)
    return without(rows, exact_duplicates(rows, carry=(ROW,)).where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, the one with the smallest doc_id
    (null last); of several rows with that doc_id, the first by address.  Texts without
    words stay; an empty table stays empty."""
    rows = addressed(docs)
    found = store(near_duplicates(rows, carry=(ROW,), width=SHINGLE_WORDS,
                                  percent=SIMILARITY_PERCENT), "near").where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    several = store(found.groupBy("component").agg(F.min(order).alias("first"),
                                                   F.count(F.lit(1)).alias("n")).where("n > 1"),
                    "near-first")
    dropped = found.join(several, "component").where(F.col(ROW) != F.col(f"first.{ROW}"))
    return without(rows, dropped)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to 3 times.  Null
    texts and texts without words have no words to take and go or stay as the mix
    draws them; repeated rows are drawn each, an empty table stays empty."""
    rows = addressed(docs)
    copies = store(mix(rows, carry=(ROW,)).where("copies > 0")
                   .select(ROW, F.col("copies").cast("int").alias("_copies")), "copies")
    # as many rows as the documents: merge-joined at every size
    return rows.join(copies.hint("merge"), ROW) \
        .withColumn("_copies", F.explode(F.sequence(F.lit(1), "_copies"))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every row: doc_id, lang, source, n_tokens, tokens,
    decoded.  Null and empty texts have no tokens and decode to an empty text; repeated
    rows come out repeatedly, other columns are left out."""
    out = encode(docs, default_vocabulary(), ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source",
                      F.size("tokens").cast("long").alias("n_tokens"), "tokens", "decoded")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

# Fitted language models, hashed sampling and BPE are beyond SQL: the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
