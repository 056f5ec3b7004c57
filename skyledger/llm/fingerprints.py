"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over a window of 7 bytes ends a chunk wherever it meets the block
size; each chunk gives one character of the signature.  A fingerprint holds the
signatures at a block size that suits the length and at twice that size.  Two
fingerprints are compared at the block sizes that they share, by the edit distance
(insertions and deletions) of their signatures, once these have a run of
characters in common.  Whole texts are hashed; signatures have no largest length.

The next document in key order is found without a global window: rows are
range-partitioned and sorted by key, each task pairs the rows that it streams, and
only the first and last row of each partition meet afterwards.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, slices, store, table, text_or_empty

WINDOW = 7
LEAST_BLOCK = 3
LENGTH = 64            # characters aimed at; below half, the block size is halved
COMMON = 7             # run of characters that compared signatures share
REPEATS = 3            # longest run of one character that is compared
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_POWERS = [pow(0x01000193, j, 1 << 32) for j in range(WINDOW)]


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the (up to) 7 bytes that end at each byte."""
    wide = raw.astype(np.uint32) + np.uint32(1)
    out = wide.copy()
    for j in range(1, min(WINDOW, len(wide))):
        out[j:] += wide[:-j] * np.uint32(_POWERS[j])
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    return out


def _signature(data: bytes, ends: np.ndarray) -> str:
    view, begin, out = memoryview(data), 0, []
    for end in (ends + 1).tolist():
        out.append(ALPHABET[zlib.crc32(view[begin:end]) & 63])
        begin = end
    if begin < len(data):
        out.append(ALPHABET[zlib.crc32(view[begin:]) & 63])
    return "".join(out)


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``; equal texts agree."""
    data = text.encode("utf-8", "surrogatepass")
    hashes = rolling(np.frombuffer(data, np.uint8))
    block = LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    ends = np.flatnonzero(hashes % np.uint32(block) == block - 1)
    while block > LEAST_BLOCK and len(ends) < LENGTH // 2:
        block //= 2
        ends = np.flatnonzero(hashes % np.uint32(block) == block - 1)
    # an end at twice the block is also one at the block
    twice = ends[hashes[ends] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(data, ends)}:{_signature(data, twice)}"


def _fewer_repeats(signature: str) -> str:
    out: list[str] = []
    for c in signature:
        if out[-REPEATS:] != [c] * REPEATS:
            out.append(c)
    return "".join(out)


def _common_length(a: str, b: str) -> int:
    """Longest common subsequence, one bit a character of ``a``."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        held = state & at.get(c, 0)
        state = (state + held | state - held) & full
    return len(a) - state.bit_count()


def _alike(a: str, b: str) -> float:
    a, b = _fewer_repeats(a), _fewer_repeats(b)
    if not a or not b:
        return 0.0
    run = min(COMMON, max(1, min(len(a), len(b)) // 2))
    runs = {a[i:i + run] for i in range(len(a) - run + 1)}
    if not any(b[i:i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common_length(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """1 less the edit distance over the lengths, at compatible block sizes; 1 for
    equal fingerprints and 0 where no block size is shared."""
    if x == y:
        return 1.0
    (p, a1, a2), (q, b1, b2) = x.split(":"), y.split(":")
    p, q = int(p), int(q)
    if p == q:
        return max(_alike(a1, b1), _alike(a2, b2))
    if p == 2 * q:
        return _alike(a1, b2)
    if q == 2 * p:
        return _alike(a2, b1)
    return 0.0


RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
          ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
          ("near_edited", pa.float64()), ("near_next", pa.float64())]
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
_PLACED = pa.schema([*RESULT, ("part", pa.int32()), ("place", pa.string()),
                     ("text", pa.string())])


def _result(key, text: str, own: str, after: str, of_after: str) -> tuple:
    n = len(text)
    cut = n // 4
    edited = text[:n - cut] + after[:cut]
    of_edited = fingerprint(edited) if cut else own
    return (key, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own,
            of_edited, likeness(own, of_edited), likeness(own, of_after))


def pair_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in key order -> results of all but the last row, and the ends of the
    partition: its first row once more, and its last row, with their texts."""
    part = TaskContext.get().partitionId()
    last = None

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _PLACED)], schema=_PLACED)

    def end(place: str, key, text: str, own: str) -> tuple:
        return (key, len(text), None, own, None, None, None, part, place, text)

    for batch in slices(batches, "text"):
        rows = []
        for key, text in zip(batch.column("doc_id").to_pylist(),
                             batch.column("text").to_pylist()):
            own = fingerprint(text)
            if last is None:
                rows.append(end("head", key, text, own))
            else:
                rows.append((*_result(*last, text, own), part, "row", None))
            last = (key, text, own)
        if rows:
            yield table_of(rows)
    if last is not None:
        yield table_of([end("tail", *last)])


def pair_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [_result(r["doc_id"], r["text"], r["fingerprint"], r["after"], r["of_after"])
                for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(zip(*rows), RESULT)],
            names=[n for n, _ in RESULT])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every whole text, of its edited text (the last quarter of its
    code points replaced by the first as many of the next document's), and the
    likeness of its fingerprint to the edited text's and to the next document's.

    Returns one row per input row with the columns of ``SCHEMA``; other columns are
    left out, so none can clash.  The key is a long; null keys come first, and rows
    that share a key are ordered by text.  The last document is followed by the
    first, so a lone document follows itself.  Null texts count as empty; an empty
    text has the fingerprint ``3::``.  An empty table gives no rows.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    placed = store(map_arrow(ordered, pair_in_order,
                             f"{SCHEMA}, part int, place string, text string"), "fingerprints")
    heads = placed.where("place = 'head'")
    # one row for each partition passes this window
    order = W.orderBy("part")
    following = heads.select("part", F.coalesce(
        F.lead("part").over(order),
        F.min("part").over(W.partitionBy())).alias("next_part"))
    after = heads.select(F.col("part").alias("next_part"), F.col("text").alias("after"),
                         F.col("fingerprint").alias("of_after"))
    tails = placed.where("place = 'tail'").select("part", "doc_id", "text", "fingerprint") \
        .join(following, "part").join(after, "next_part") \
        .select("doc_id", "text", "fingerprint", "after", "of_after")
    return placed.where("place = 'row'").select(*[n for n, _ in RESULT]) \
        .unionByName(map_arrow(tails, pair_ends, SCHEMA))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
