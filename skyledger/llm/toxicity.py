"""Toxicity of whole texts by a bidirectional gated recurrent network.

The network (``gated_net``) is fitted on the driver in numpy, on a bounded sample of
the labelled rows, and broadcast (its size is fixed by its tables).  Texts are scored
in Arrow batches without a shuffle: every text is cut into overlapping windows of
``WINDOW`` words, a new one each ``STRIDE`` words, up to its end; all of them are
scored, and the highest decides.  Distinct words of a slice are embedded and projected
once, and windows of many texts go through the network together.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gated_net as G
from .common import map_arrow, slices, table, text_or_empty

WINDOW = 24
STRIDE = 12
FIT_ROWS = 3000       # labelled documents in the fit sample: up to a third toxic, the rest not
FIT_WINDOWS = 32      # windows of a document in the fit sample, spread over its whole text
FIT_WORD_CHARS = 64   # longer words are left out of the fit sample
CHUNK = 2048          # windows scored together
TEXT_BYTES = 2 * 1024 ** 2
FOLDS = 5
PRIOR = (1.0, 10.0)   # toxic and all documents added to the class counts
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    net: dict[str, np.ndarray] | None   # None where not both classes were there to learn from
    known: dict[str, int]               # rows of the words that the network knows
    prior: float                        # log odds of the class among all training rows
    shift: float                        # log odds of the class there over those of the sample


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is a multiple of ``FOLDS``; null keys are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def starts(n_words: int, stride: int = STRIDE, window: int = WINDOW) -> range:
    """First words of the windows of a text: the last one reaches its end."""
    return range(0, max(n_words - window + stride, 1) if n_words else 0, stride)


def _fit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        out = []
        for text in batch.column("text").to_pylist():
            words = [w for w in _WORD.findall(text.lower()) if len(w) <= FIT_WORD_CHARS]
            first = starts(len(words), WINDOW)
            if len(first) > FIT_WINDOWS:
                first = [first[i * len(first) // FIT_WINDOWS] for i in range(FIT_WINDOWS)]
            out.append([" ".join(words[i:i + WINDOW]) for i in first])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("toxic"), pa.array(out, pa.list_(pa.string()))],
            names=["key", "toxic", "windows"])


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[list, dict]:
    """At most ``rows`` / 3 toxic and twice as many other documents with the windows to
    learn from, and the number of labelled documents by class.  Rows of ``labels``: key, toxic."""
    classes = labels.where("key IS NOT NULL AND toxic IS NOT NULL") \
        .groupBy("key").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in classes.groupBy("toxic").count().collect()}
    draw = F.xxhash64(F.lit(17), "key")
    ids = [classes.where(F.col("toxic") == c).orderBy(draw, "key").limit(rows * n // 3)
           for c, n in ((0, 2), (1, 1))]
    chosen = docs.join(F.broadcast(ids[0].unionAll(ids[1])), "key") \
        .groupBy("key", "toxic").agg(F.min("text").alias("text"))   # one row a key
    found = map_arrow(chosen.select("key", "toxic", "text"), _fit_windows,
                      "key bigint, toxic int, windows array<string>")
    return sorted((r for r in found.collect() if r.windows), key=lambda r: r.key), sizes


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Learn from ``labels`` (key, label 0/1) of the texts of ``docs``; hold rows out
    before calling.  Null keys and labels teach nothing; of several labels of a key the
    highest counts, of several texts the first in code point order.  Without documents
    of both classes there is no network, and all texts get the prior."""
    sample, sizes = fit_sample(
        docs.select(F.col(key).cast("bigint").alias("key"), text_or_empty(text).alias("text")),
        labels.select(F.col(key).cast("bigint").alias("key"),
                      (F.col(label) > 0).cast("int").alias("toxic")), rows)
    toxic, total = sizes.get(1, 0) + PRIOR[0], sum(sizes.values()) + PRIOR[1]
    prior = math.log(toxic / (total - toxic))
    marks = np.array([r.toxic for r in sample], np.int64)
    if len(set(marks.tolist())) < 2:
        return Model(None, {}, prior, 0.0)
    places: defaultdict = defaultdict()
    places.default_factory = places.__len__
    bags = []
    for r in sample:
        index = np.zeros((len(r.windows), WINDOW), np.int64)
        filled = np.zeros(index.shape, bool)
        for i, w in enumerate(r.windows):
            ids = [places[x] for x in w.split(" ")]
            index[i, :len(ids)], filled[i, :len(ids)] = ids, True
        bags.append((index, filled))
    net, known = G.train(bags, marks, list(places))
    return Model(net, known, prior, prior - math.log(marks.sum() / (len(marks) - marks.sum())))


def _windows_of(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window positions of texts that lie one after another: (windows, WINDOW) indices,
    which of them are filled, each window's text and its first word within the text."""
    text = np.repeat(np.arange(len(sizes)), [len(starts(n)) for n in sizes])
    counts = np.bincount(text, minlength=len(sizes))
    first = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    ends = np.cumsum(sizes)
    index = (np.concatenate([[0], ends])[text] + first)[:, None] + np.arange(WINDOW)
    filled = index < ends[text][:, None]
    return np.where(filled, index, 0), filled, text, first


def score_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of windows and first word of the highest window of each text."""
    empty = 1 / (1 + math.exp(-model.prior))
    score = np.full(len(texts), empty)
    n_windows, top = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int64)
    places: defaultdict = defaultdict()
    places.default_factory = places.__len__
    found = [np.fromiter(map(places.__getitem__, _WORD.findall(t.lower())), np.int64) for t in texts]
    if model.net is None or not places:
        return score, n_windows, top
    words = list(places)
    projected = G.project(model.net, G.inputs(model.net, G.word_rows(model.known, words),
                                              *G.char_buckets(words)))
    ids = np.concatenate(found)
    best = np.full(len(texts), -np.inf)
    sizes, done = [len(f) for f in found], 0
    # texts in runs of about ``CHUNK`` windows; a longer one goes through in chunks
    run, held = [], 0
    for i, n in enumerate(sizes + [None]):
        if n is None or held > CHUNK * STRIDE:
            index, filled, text, first = _windows_of([sizes[j] for j in run])
            for at in range(0, len(text), CHUNK):
                part = slice(at, at + CHUNK)
                logit = G.forward(model.net, projected, ids[done:][index[part]], filled[part])
                own = np.asarray(run)[text[part]]
                begin = np.flatnonzero(np.diff(own, prepend=-1))
                high = np.maximum.reduceat(logit, begin)
                for k, (b, e) in enumerate(zip(begin, np.append(begin[1:], len(own)))):
                    if high[k] > best[own[b]]:
                        best[own[b]] = high[k]
                        top[own[b]] = first[part][b + int(logit[b:e].argmax())]
                n_windows += np.bincount(own, minlength=len(texts))
            done += sum(sizes[j] for j in run)
            run, held = [], 0
        if n is not None:
            run.append(i)
            held += n
    some = n_windows > 0
    score[some] = 1 / (1 + np.exp(-np.clip(best[some] + model.shift, -500, 500)))
    return score, n_windows, top


def _scorer(model_ref):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            score, n, top = score_texts(model_ref.value, batch.column("text").to_pylist())
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(np.round(score, 6)), pa.array(n),
                 pa.array(top, mask=top < 0)],
                names=[*rest.schema.names, "score", "n_windows", "top_word"])
    return run


def score(df: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``score`` (0 to 1, six decimals), ``n_windows`` and ``top_word`` (number
    of the first word of the highest window, from 0) of every row.

    Null and empty texts and texts without words have no windows and get the prior;
    equal texts get equal scores to within rounding, repeated rows come out repeatedly, an empty table gives
    none.  Other columns are left out, so none can clash.
    """
    ref = df.sparkSession.sparkContext.broadcast(model)
    narrow = df.select(*[F.col(k) for k in keys], text_or_empty(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in narrow.schema.fields if f.name != "text")
    return map_arrow(narrow, _scorer(ref), f"{kinds}, score double, n_windows bigint, top_word bigint")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out(F.col("doc_id")))
    return score(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows", "top_word")
