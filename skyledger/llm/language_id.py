"""Language identification by Bayesian evidence fusion.

Evidence of a row, multiplied as likelihoods and a prior:

* text: hashed byte trigrams of the whole text under a model for each language
  and a uniform model ``und`` for text of no known language; overlapping trigrams
  are not independent, so the log likelihood is divided by ``TEMPER``;
* the declared language (markup or metadata): P(declared | language), from the
  grouped sums of text posteriors over the whole table;
* the host: a prior smoothed along address suffix, domain and host, each level
  drawn towards the level above by ``PULL`` pseudo-rows.

Sums by suffix, domain, host and declared language come from grouped aggregation
with map-side combination, whatever the size of a host.  A row's own posterior is
taken out of its host's and declaration's sums, so that it is no evidence for
itself.  The text model is fitted on a bounded sample of labelled rows
(``FIT_ROWS`` distinct texts a language in expectation, by a hash of the text); all
other sums cover every row.

Languages are not limited in number: beyond ``BLOCK`` the model is collected and
broadcast in blocks of languages, and a worker holds ``HELD_BLOCKS`` of them at most.
A row keeps two numbers for each language.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, slices, store, table, text_or_empty

FIT_ROWS = 4000          # expected sample texts a language
BLOCK = 64               # languages of one block of the model
HELD_BLOCKS = 8          # a worker keeps so many blocks from batch to batch
FEATURES = 1 << 16       # hashed trigrams
ALPHA = 0.5              # pseudo-count of a trigram
TEMPER = 3.0             # trigrams that share a byte
PULL = 20.0              # pseudo-rows that a level takes from the level above
MIN_POSTERIOR = 0.5      # of the accepted language
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the letters, words divided by one space."""
    words = text.lower().encode("utf-8", "replace").translate(_LETTERS).split()
    if not words:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA77) \
        + raw[2:] * np.uint32(0xC2B2AE3D)
    return ((code ^ (code >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)) \
        .astype(np.int64)


def label(c: Column) -> Column:
    """A language label in lower case, without white space around it or a region."""
    low = F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))
    return F.regexp_replace(low, r"^([a-z]{2,3})[-_](?:[a-z]{2}|[0-9]{3})$", "$1")


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, text) -> (at, feature, n), summed within the task for the languages ``at``
    of a block's number at a time."""
    sums: dict[int, np.ndarray] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), lang), pa.int32()), pa.array(at, pa.int64()),
                 pa.array(n[at], pa.int64())], names=["at", "feature", "n"])
        sums.clear()

    for batch in slices(batches, "text"):
        for lang, text in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist()):
            if lang not in sums:
                if len(sums) == BLOCK:
                    yield from held()
                sums[lang] = np.zeros(FEATURES, np.int64)
            sums[lang] += np.bincount(trigrams(text), minlength=FEATURES)
    yield from held()


def fit(labelled: DataFrame, lang: str = "lang", text: str = "text",
        rows: int = FIT_ROWS) -> dict:
    """Log probabilities of trigrams for each language of a labelled table.

    Labels are taken without case, white space around them and region (``label``).
    Rows with a null or empty label are not used, and copies of a text under one label
    count once.  The sample takes a text when its hash falls below ``rows`` over the
    number of distinct texts of its language.

    Returns ``names`` and, up to ``BLOCK`` languages, ``model``, one column for each
    name; beyond, ``blocks``, broadcasts of such columns side by side.
    """
    spark = labelled.sparkSession
    known = labelled.select(label(F.col(lang)).alias("lang"),
                            text_or_empty(text).alias("text")).where("lang <> ''")
    counts = {r.lang: r.n for r in known.select("lang", F.xxhash64("text").alias("hash"))
              .distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    several = len(names) > BLOCK
    unknown = np.full((FEATURES, 1), -math.log(FEATURES), np.float32)
    if not names:
        return {"names": [UNKNOWN], "model": unknown}
    shares = spark.createDataFrame([(k, i, rows / counts[k]) for i, k in enumerate(names)],
                                   "lang string, at int, share double")
    sample = known.join(F.broadcast(shares), "lang").where(
        F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("share") * float(1 << 30)) \
        .select("at", "text").distinct()
    found = map_arrow(sample, count_trigrams, "at int, feature long, n long") \
        .groupBy("at", "feature").agg(F.sum("n").alias("n"))
    if several:
        found = store(found, "language-features")
    blocks = []
    for first in range(0, len(names), BLOCK):
        width = min(BLOCK, len(names) - first)
        part = found.where((F.col("at") >= first) & (F.col("at") < first + width)) \
            .toArrow()              # <= FEATURES x BLOCK
        table_ = np.zeros((FEATURES, width))
        table_[part.column("feature").to_numpy(), part.column("at").to_numpy() - first] = \
            part.column("n").to_numpy()
        block = np.log((table_ + ALPHA) / (table_.sum(axis=0) + ALPHA * FEATURES)) \
            .astype(np.float32)
        if first + width == len(names):
            block = np.hstack([block, unknown])
        blocks.append(spark.sparkContext.broadcast(block) if several else block)
    names.append(UNKNOWN)
    return {"names": names, "blocks": blocks} if several else {"names": names, "model": blocks[0]}


def scorer(blocks: list, n: int):
    """Batch function: adds ``letters``, ``logs`` (tempered log likelihoods) and
    ``posterior`` (under a flat prior) for the text.  ``blocks`` are broadcasts of the
    model's columns, ``n`` in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams = [trigrams(text) for text in batch.column("text").to_pylist()]
            letters = [len(g) for g in grams]
            logs = np.zeros((len(grams), n))
            first = 0
            for ref in blocks:
                model = ref.value
                part = logs[:, first:first + model.shape[1]]
                for row, g in enumerate(grams):
                    for i in range(0, len(g), 1 << 16):
                        part[row] += model[g[i:i + (1 << 16)]].sum(axis=0, dtype=np.float64)
                first += model.shape[1]
                if len(blocks) > HELD_BLOCKS:   # read again from the worker's disk
                    del model
                    ref.__dict__.pop("_value", None)
            logs /= TEMPER
            each = np.exp(logs - logs.max(axis=1, keepdims=True))
            each /= each.sum(axis=1, keepdims=True)
            offsets = pa.array(np.arange(len(logs) + 1) * logs.shape[1], pa.int32())
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(letters, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(logs.ravel())),
                 pa.ListArray.from_arrays(offsets, pa.array(each.ravel()))],
                names=[*rest.schema.names, "letters", "logs", "posterior"])

    return run


def _sums(df: DataFrame, n: int, *by: str) -> DataFrame:
    if n <= BLOCK + 1:
        return df.groupBy(*by).agg(F.array(*[F.sum(F.col("posterior")[i]) for i in range(n)])
                                   .alias("sums"))
    each = df.select(*by, F.posexplode("posterior").alias("at", "p")) \
        .groupBy(*by, "at").agg(F.sum("p").alias("p"))
    return each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias("all")) \
        .select(*by, F.transform("all", lambda s: s["p"]).alias("sums"))


def _whole(df: DataFrame, n: int) -> list[float]:
    row = _sums(df, n).first()
    return [float(x or 0) for x in (row and row.sums) or [0.0] * n]


def _smoothed(sums: Column, parent: Column) -> Column:
    total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.array(total), lambda t: F.zip_with(
        sums, parent, lambda s, p: (s + PULL * p) / (t + PULL)))[0]


def identify(df: DataFrame, model: dict, keys: list[str], text: str = "text",
             declared: Column | None = None, host: Column | None = None,
             domain: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """Language of every row from its text and, where given, its declared language,
    host, domain and address suffix.

    Returns ``keys``, ``lang`` (null for ``und``), ``posterior``, ``text_lang`` (by
    the text alone), ``letters`` (trigrams seen) and ``accepted``: a known language
    has at least ``MIN_POSTERIOR``.  Other columns are left out, so none can clash
    (``keys`` must not name these).  A null declaration is no evidence; null hosts
    share one prior.  Null texts, empty texts and texts without letters are not
    accepted.  Ties go to the first language by name.  Repeated rows come out
    repeatedly; an empty table gives no rows.
    """
    names = model["names"]
    n = len(names)
    blocks = model.get("blocks") or [df.sparkSession.sparkContext.broadcast(model["model"])]
    none = F.lit(None).cast("string")

    def given(c: Column | None) -> Column:
        return F.coalesce((none if c is None else c).cast("string"), F.lit(""))

    narrow = df.select(
        *[F.col(k) for k in keys], text_or_empty(text).alias("text"),
        label(given(declared)).alias("declared"), given(host).alias("host"),
        given(domain).alias("domain"), given(suffix).alias("suffix"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in narrow.schema.fields if f.name != "text")
    rows = store(map_arrow(narrow, scorer(blocks, n), f"{kinds}, letters long, "
                           "logs array<double>, posterior array<double>"), "language-text")
    # rows without letters say nothing about their host
    seen = rows.where("letters > 0")
    by_host = store(_sums(seen, n, "suffix", "domain", "host"), "language-hosts")
    up = by_host.withColumnRenamed("sums", "posterior")
    whole = _whole(up, n)
    top = [(x + 1) / (sum(whole) + n) for x in whole]
    above = F.array(*[F.lit(x) for x in top])
    suffixes = _sums(up, n, "suffix").select(
        "suffix", _smoothed(F.col("sums"), above).alias("of_suffix"))
    domains = _sums(up, n, "suffix", "domain").join(suffixes, "suffix").select(
        "suffix", "domain", _smoothed(F.col("sums"), F.col("of_suffix")).alias("of_domain"))
    hosts = by_host.join(domains, ["suffix", "domain"]) \
        .withColumnRenamed("sums", "host_sums")
    hosts = store(hosts, "language-priors")
    said = store(_sums(seen.where("declared <> ''"), n, "declared")
                 .withColumnRenamed("sums", "said_sums"), "language-declared")
    n_said = _whole(said.withColumnRenamed("said_sums", "posterior"), n)
    n_values = float(said.count())

    joined = rows.join(hosts, ["suffix", "domain", "host"], "left") \
        .join(said, "declared", "left") \
        .select(*keys, "letters", "logs", F.col("posterior").alias("own"),
                (F.col("declared") != "").alias("is_declared"), "host_sums", "of_domain",
                "said_sums")
    kept = ", ".join(f"`{k}` {joined.schema[k].dataType.simpleString()}" for k in keys)
    return map_arrow(joined, fuser(names, keys, top, n_said, n_values),
                     f"{kept}, lang string, posterior double, text_lang string, letters long, "
                     "accepted boolean")


def fuser(names: list[str], keys: list[str], top: list[float], n_said: list[float],
          n_values: float):
    """Batch function: multiplies the evidence of each row and names the language."""
    n = len(names)

    def wide(column: pa.Array, missing) -> np.ndarray:
        """Rows of ``n`` numbers; ``missing`` where the array is null."""
        out = np.tile(np.asarray(missing, float), (len(column), 1))
        held = column.is_valid().to_numpy(zero_copy_only=False)
        if held.any():
            out[held] = column.drop_null().flatten().to_numpy().reshape(-1, n)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 17) // n)
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            letters = batch.column("letters").to_numpy()
            seen = letters > 0
            text = wide(batch.column("own"), [0.0] * n)
            own = text * seen[:, None]
            known_host = batch.column("host_sums").is_valid().to_numpy(zero_copy_only=False)
            sums = np.maximum(wide(batch.column("host_sums"), [0.0] * n) - own, 0)
            prior = (sums + PULL * wide(batch.column("of_domain"), top)) \
                / (sums.sum(axis=1, keepdims=True) + PULL)
            prior[~known_host] = top
            # P(declared | language), one pseudo-row for each value that is declared
            spoken = (np.maximum(wide(batch.column("said_sums"), [0.0] * n) - own, 0) + 1) \
                / (np.maximum(np.array(n_said) - own, 0) + n_values + 1)
            spoken[~batch.column("is_declared").to_numpy(zero_copy_only=False)] = 1
            total = wide(batch.column("logs"), [0.0] * n) + np.log(prior) + np.log(spoken)
            best, by_text = total.argmax(axis=1), text.argmax(axis=1)
            sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            known = seen & (best < n - 1)
            label = [names[b] if k else None for b, k in zip(best.tolist(), known.tolist())]
            text_label = [names[b] if k else None for b, k in zip(
                by_text.tolist(), (seen & (by_text < n - 1)).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(label, pa.string()),
                 pa.array(np.where(seen, sure, 0.0)), pa.array(text_label, pa.string()),
                 batch.column("letters"), pa.array(known & (sure >= MIN_POSTERIOR))],
                names=[*keys, "lang", "posterior", "text_lang", "letters", "accepted"])

    return run


def identify_documents(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Documents: ``lang`` is what is declared, ``source`` stands for the host.  The
    text model is fitted on the table's own labels."""
    return identify(docs, fit(docs), keys, declared=F.col("lang"), host=F.col("source"))


_HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|"
                     # a quote opens a value after an equals sign only
                     r"<[a-z/!?](?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*>?")
_TAG_LANG = r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})"""


def visible_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        at = batch.schema.names.index("text")
        out = [html.unescape(_HIDDEN.sub(" ", t)) for t in batch.column("text").to_pylist()]
        yield batch.set_column(at, "text", pa.array(out, pa.string()))


def identify_pages(pages: DataFrame, model: dict) -> DataFrame:
    """Pages: text outside of the markup, the language declared on the html element
    (null where none is), and the address split into suffix, domain and host.

    Returns one row a page: ``page_id`` and what ``identify`` gives.  Null and empty
    pages and pages without letters are not accepted; null URLs and URLs without a host
    share one prior; null ids are kept.  Repeated rows come out repeatedly, an empty
    table gives no rows; other columns are left out, so none can clash.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#:]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.nullif(F.regexp_extract(text_or_empty("html"), _TAG_LANG, 1), F.lit(""))
        .alias("declared"), host.alias("host"), text_or_empty("html").alias("text"))
    rows = map_arrow(rows, visible_text,
                     "page_id long, declared string, host string, text string")
    return identify(rows, model, ["page_id"], declared=F.col("declared"), host=F.col("host"),
                    domain=F.substring_index("host", ".", -2),
                    suffix=F.substring_index("host", ".", -1))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; ``kept``: it is accepted."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return identify_documents(docs, ["doc_id"]).withColumnRenamed("accepted", "kept")


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of web pages, with the text model of the labelled documents."""
    model = fit(table(spark, sf_dir, "documents", "text", "lang"))
    return identify_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"), model)
