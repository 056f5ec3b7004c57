"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a slice of the partition lie one after another in one
symbol array.  An index maps the rank of each adjacent pair that can be merged
to all of its positions.  Active ranks are applied in ascending order: every
position of the pair is merged at once, and the lists of the pairs that the
merges create beside them are updated.  A rank leaves the index when it has been
applied, so the work follows the number of merges, not the number of ranks times
the number of words.

The vocabulary file (JSON of the public ``tokenizers`` library: lower-casing
normaliser, split pattern, byte-level alphabet, word-end suffix) is read once on
the driver, checked against a size bound and broadcast.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, slices, table, text_or_empty

MAX_VOCAB_BYTES = 64 * 1024 ** 2   # bound of the broadcast vocabulary file
MERGE_BYTES = 2 * 1024 ** 2       # text of one index
CACHE_CHUNKS = 200_000             # chunks remembered by a task before it starts anew


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    visible Latin-1 characters stand for themselves, the others follow from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Parse a ``tokenizers`` JSON file into plain tables for the workers."""
    if os.path.getsize(path) > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCAB_BYTES} bytes: {path}")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    if (model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"]
            or split["behavior"] != "Removed" or not split["invert"]):
        raise ValueError(f"unsupported tokenizer file: {path}")
    vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
    tokens = {i: t for t, i in vocab.items()}
    results = []
    for merge in model["merges"]:
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        results.append((vocab[a], vocab[b], vocab[a + b]))
    pairs = np.array([a << 32 | b for a, b, _ in results], np.int64)
    order = np.argsort(pairs)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens.update({i: t for t, i in added.items()})
    letters = byte_alphabet()
    return {"pattern": split["pattern"]["Regex"], "added": added, "tokens": tokens,
            "results": results, "pairs": pairs[order], "rank": order,
            "inner": np.array([vocab[c] for c in letters], np.int64),
            "last": np.array([vocab[c + end] for c in letters], np.int64)}


def merge_words(words: list[bytes], vocab: dict) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of ``words``, one after another, and the number of each word's
    tokens, by the pair occurrence index over all of them."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    ends = np.cumsum(lengths)
    # slot n stands before the first and after the last symbol of every word
    symbols = np.append(vocab["inner"][raw], -1)
    symbols[ends - 1] = vocab["last"][raw[ends - 1]]
    following = np.arange(1, n + 2)
    following[ends - 1] = n
    before = np.arange(-1, n)
    before[ends - lengths] = n
    pairs, results = vocab["pairs"], vocab["results"]
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(places: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Add places to the lists of their pairs, where a merge exists."""
        keys = left << 32 | right
        at = np.searchsorted(pairs, keys)
        known = pairs[np.minimum(at, len(pairs) - 1)] == keys
        if not known.all():
            places, at = places[known], at[known]
        if not len(at):
            return
        ranks = vocab["rank"][at]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(places, cuts)):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    start = np.flatnonzero(following[:n] < n)
    note(start, symbols[start], symbols[start + 1])
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        left, right, whole = results[rank]
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        after = following[places]
        held = (symbols[places] == left) & (symbols[after] == right)
        if not held.all():  # a lower rank took one of the two
            places, after = places[held], after[held]
        if left == right and len(places) > 1:
            places = _leftmost(places, after)
            after = following[places]
        if not len(places):
            continue
        symbols[places], symbols[after] = whole, -1
        after = following[after]
        following[places] = after
        before[after] = places
        inside = after < n
        note(places[inside], symbols[places[inside]], symbols[after[inside]])
        earlier = before[places]
        inside = earlier < n
        inside[inside] = symbols[earlier[inside]] != whole  # else noted from its own place
        note(earlier[inside], symbols[earlier[inside]], symbols[places[inside]])
    alive = symbols[:n] >= 0
    counts = np.add.reduceat(alive, ends - lengths, dtype=np.int64) if n else lengths
    return symbols[:n][alive].astype(np.int32), counts


def _leftmost(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping places of a pair of equal symbols, those taken from the left."""
    taken, used = [], -1
    for p, q in sorted(zip(places.tolist(), after.tolist())):
        if p != used:
            taken.append(p)
            used = q
    return np.array(taken)


def normalise(text: str) -> str:
    """NFC, then lower case of each character by itself (no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Places(dict):
    """Number of each chunk, given at its first lookup; ``new`` lists those."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        at = self[chunk] = len(self)
        return at


class ChunkTable:
    """Chunks (text between white space) met by a task, with their token ids in
    one flat array.  No match of the split pattern holds white space, and neither
    does a merge or a canonical composition."""

    def __init__(self, vocab: dict):
        self.vocab = vocab
        # a space between two chunks is found as a word of its own
        self.find = regex.compile(f"(?:{vocab['pattern']})| ").findall
        self.added = vocab["added"]
        self.cut = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") \
            if self.added else None
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        if not any(t in text for t in self.added):
            return _chunks(text)
        chunks: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            chunks.extend([part] if i % 2 else _chunks(part))
        return chunks

    def tokens(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``docs``, one after another, and where each ends."""
        place = self.place
        at = np.array([place[c] for doc in docs for c in doc], np.int64)
        self._learn(place.new)
        place.new = []
        tokens, lengths = gather(self.flat, self.start, at)
        ends = np.cumsum(np.fromiter(map(len, docs), np.int64, len(docs)))
        return tokens, np.append(0, np.cumsum(lengths))[ends]

    def _learn(self, new: list[str]) -> None:
        """Token ids of new chunks, in the order of their numbers."""
        if not new:
            return
        words = self.find(normalise(" ".join(
            [c if c not in self.added else "" for c in new])))
        distinct = list(dict.fromkeys(words))
        if " " in distinct:
            distinct.remove(" ")
        flat, counts = merge_words([w.encode() for w in distinct], self.vocab)
        number = {w: i for i, w in enumerate(distinct)}
        number[" "] = -1
        at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        chunk = np.cumsum(at < 0)[at >= 0]  # spaces before a word count its chunk
        tokens, lengths = gather(flat, np.append(0, np.cumsum(counts)), at[at >= 0])
        sizes = np.bincount(chunk, lengths, len(new)).astype(np.int64)
        special = [i for i, c in enumerate(new) if c in self.added]
        tokens = np.insert(tokens, np.cumsum(sizes)[special], [self.added[new[i]] for i in special])
        sizes[special] = 1
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, tokens.astype(np.int32)])


def _chunks(text: str) -> list[str]:
    """``str.split`` also cuts at U+001C to U+001F, which are not white space to
    the vocabulary's pattern."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return regex.split(r"\s+", text)
    return text.split()


def gather(flat: np.ndarray, start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``at`` of ``flat``, one after another, and their lengths."""
    begin = start[at]
    lengths = start[at + 1] - begin
    total = int(lengths.sum())
    shift = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
    return flat[shift + np.arange(total)], lengths


def token_strings(tokens: dict[int, str]) -> pa.Array:
    """The token strings, each at the place of its id; null where there is no id."""
    return pa.array(map(tokens.get, range(max(tokens, default=-1) + 1)), pa.string())


def encoder(vocab_ref):
    """Batch function: (ids..., text) -> (ids..., tokens array<int>, decoded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocab_ref.value
        chunks, names = ChunkTable(vocab), token_strings(vocab["tokens"])
        for batch in slices(batches, "text", MERGE_BYTES):
            if len(chunks.place) > CACHE_CHUNKS:
                chunks.clear()
            tokens, ends = chunks.tokens([chunks.split(t) for t in batch.column("text").to_pylist()])
            offsets = pa.array(np.append(0, ends), pa.int32())
            ids = pa.array(tokens, pa.int32())
            rest = batch.drop_columns(["text"])
            shown = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(ids)), " ")
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.ListArray.from_arrays(offsets, ids), shown],
                names=[*rest.schema.names, "tokens", "decoded"])

    return run


def encode(df: DataFrame, vocab_path: str, keys: list[str], text: str = "text") -> DataFrame:
    """Token ids and decoded text of every whole ``text``.

    Returns ``keys``, ``tokens array<int>`` and ``decoded string`` for each input row;
    other columns are left out, so none can clash.  Null and empty texts
    give an empty array and an empty string; repeated rows come out repeatedly;
    an empty table gives none.  Runs without a shuffle.
    """
    vocab = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path))
    narrow = df.select(*[F.col(k) for k in keys], text_or_empty(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in narrow.schema.fields if f.name != "text")
    return map_arrow(narrow, encoder(vocab), f"{kinds}, tokens array<int>, decoded string")


def decode(df: DataFrame, vocab_path: str, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """Text of ``tokens``: their strings joined by one space (the file names no
    decoder).  Null arrays give an empty text; ids outside the vocabulary raise."""
    names = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocab_path)["tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = names.value
        for batch in batches:
            out = [" ".join([shown[i] for i in ids or ()])
                   for ids in batch.column("tokens").to_pylist()]
            rest = batch.drop_columns(["tokens"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(out, pa.string())],
                                             names=[*rest.schema.names, "decoded"])

    narrow = df.select(*[F.col(k) for k in keys], F.col(tokens).alias("tokens"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in narrow.schema.fields if f.name != "tokens")
    return map_arrow(narrow, run, f"{kinds}, decoded string")


def digests(encoded: DataFrame, *keys: str) -> DataFrame:
    """``n_tokens`` and the digests of ids and decoded text."""
    return encoded.select(
        *keys, F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str, vocab_path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digests(encode(docs, vocab_path or default_vocabulary(), ["doc_id"]), "doc_id")
