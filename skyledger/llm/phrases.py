"""Phrase collocations from a weighted de Bruijn graph of words.

The longest phrases (four words) are the edges of a graph whose nodes are the
phrases of one word less: an edge leads from its first three words to its last
three and weighs as often as it occurs.  Only edges are counted over the corpus:
every word position gives one record, the longest phrase that starts there, which
falls short of four words at the end of a piece.  All shorter counts follow from
the flow through the nodes: a node occurs as often as its outgoing edges, plus the
records that end with it (the piece-end correction), and so on down to words.

A run of nodes through which all flow passes on unbranched is compacted into one
path.  Every edge of a path has the path's weight, and every node inside it occurs
exactly as often, so the three-word phrases that longer ones contain are read off
the paths.

Before edges are counted, the word pairs and then the triples that can't be frequent are
found by counting them in ``2 ** BUCKET_BITS`` hashed buckets: a bucket below ``min_count``
holds no frequent one, and no phrase across such a pair or triple can reach
``min_count``.  The records of the positions before it end there, which is one more end
to correct for, so the counts of all frequent phrases stay exact; pairs that share a
bucket only cost work.  The tables' size is fixed whatever the corpus (32 MB each); a
corpus with very many more rare pairs than buckets is counted without their help.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, slices, store, table, text_or_empty

LONGEST = 4           # words of an edge
MIN_COUNT = 30
CONTAINED_PERCENT = 80
TOP = 2000
SCORE_SCALE = 2_000_000
BUCKET_BITS = 28      # of the buckets of pairs and of triples: 32 MB broadcast each
BLOCK_BITS = 16       # of the buckets counted together: a row a block
HELD = 1 << 23        # bucket numbers that a task holds before it passes them on: 32 MB
PART_BYTES = 1024 ** 2   # text worked on at a time where buckets are counted
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_MARK = bytes.maketrans(PIECE_ENDS + b"\t", b"." * len(PIECE_ENDS) + b" ")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))   # odd mixing constants


def _blobs(batch: pa.RecordBatch, limit: int = 4 * 1024 ** 2) -> Iterator[tuple[str, bytes]]:
    """Texts by language, lower-cased, with ``.`` for every piece end, in parts of about
    ``limit`` bytes cut at piece ends."""
    texts = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(),
                          batch.column("text").cast(pa.binary()).to_pylist()):
        texts[lang].append(text)
    for lang, own in texts.items():
        blob = b".".join(own).lower().translate(_MARK)
        at = 0
        while at < len(blob):
            end = len(blob)
            if end - at > limit:
                end = blob.rfind(b".", at, at + limit) + 1 or blob.find(b".", at + limit) + 1 or end
            yield lang, blob[at:end]
            at = end


def _word_ids(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Ids of the words one after another, 0 for a piece end, and the words."""
    places: defaultdict = defaultdict()
    places.default_factory = places.__len__
    places[b"."]
    words = blob.replace(b".", b" . ").split()
    ids = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
    places.default_factory = None   # it refers to ``places``, which would stay till garbage is collected
    return np.append(ids, 0), list(places)


def _buckets(lang: str, ids: np.ndarray, words: list[bytes], most: int, bits: int) \
        -> list[np.ndarray]:
    """Buckets of the phrases of 2 to ``most`` words that start at each position."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    h = hashes[ids] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))
    out = []
    for k in range(2, most + 1):
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _MIX[0] + hashes[ids[k - 1:]]
        last = (h ^ (h >> np.uint64(32))) * _MIX[1]
        out.append((last >> np.uint64(64 - bits)).astype(np.int64))
    return out


def _reach(lang: str, ids: np.ndarray, words: list[bytes], maps: list[np.ndarray], most: int,
           bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For 1 to ``most`` words, whether a phrase of that length may start at each
    position: its words lie in one piece, and all shorter phrases that ``maps`` know
    are frequent.  And the buckets."""
    buckets = _buckets(lang, ids, words, min(most, len(maps) + 2), bits)
    reach = [ids > 0]
    for k in range(2, most + 1):
        longer = np.zeros(len(ids), bool)
        longer[:-1] = reach[-1][:-1] & reach[-1][1:]
        if k - 2 < len(maps):
            b = buckets[k - 2]
            longer[:len(b)] &= (maps[k - 2][b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1
        reach.append(longer)
    return reach, buckets


def _bucket_counter(maps_refs, bits: int):
    """Batch function: counts of the buckets of the phrases one word longer than
    those that the maps know, a row a block of buckets (``_bucket_rows``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(m.value, np.uint8) for m in maps_refs]
        size = len(maps) + 2
        held, n = np.empty(HELD, np.uint32), 0
        for batch in slices(batches, "text", PART_BYTES):
            for lang, blob in _blobs(batch, PART_BYTES):
                reach, buckets = _reach(lang, *_word_ids(blob), maps, size, bits)
                new = buckets[-1][reach[-1][:len(buckets[-1])]]
                while len(new):
                    fits = new[:HELD - n]
                    held[n:n + len(fits)] = fits
                    n, new = n + len(fits), new[len(fits):]
                    if n == HELD:
                        yield from _bucket_rows(held)
                        n = 0
        if n:
            yield from _bucket_rows(held[:n])
    return run


def _bucket_rows(held: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each block (their last ``BLOCK_BITS`` bits) and how often each
    is there; ``held`` is sorted.  A block or bucket at a cut comes in two rows."""
    held.sort()
    for i in range(0, len(held), 1 << 18):
        part = held[i:i + (1 << 18)]
        first = _changes(part)
        n = np.diff(first, append=len(part)).astype("<u4")
        every = part[first]
        block = every >> np.uint32(BLOCK_BITS)
        start = _changes(block)
        low = (every & np.uint32((1 << BLOCK_BITS) - 1)).astype("<u2")
        yield pa.RecordBatch.from_arrays([pa.array(block[start].astype(np.int32)),
                                          _binaries(low, start), _binaries(n, start)],
                                         names=["block", "buckets", "n"])


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def _binaries(values: np.ndarray, start: np.ndarray) -> pa.Array:
    """The bytes of ``values`` from each start to the next."""
    ends = (np.append(start, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start),
                                 [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _block_bits(min_count: int, bits: int):
    """Batch function: of rows in the order of their blocks, a bitmap of the buckets that
    reach ``min_count`` for each block that has one.  A task holds one block's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = -1, np.zeros(1 << min(bits, BLOCK_BITS), np.int64)

        def finished() -> Iterator[pa.RecordBatch]:
            often = total >= min_count
            if often.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()),
                     pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())],
                    names=["block", "bits"])

        for batch in batches:
            for b, buckets, n in zip(*(batch.column(c).to_pylist() for c in ("block", "buckets", "n"))):
                if b != block:
                    yield from finished()
                    block = b
                    total[:] = 0
                total[np.frombuffer(buckets, "<u2")] += np.frombuffer(n, "<u4")  # distinct in a row
        yield from finished()
    return run


def frequent_buckets(docs: DataFrame, min_count: int, shorter: list,
                     bits: int = BUCKET_BITS) -> bytes:
    """Bitmap of the buckets that reach ``min_count`` (2^bits / 8 bytes): of word pairs, or
    of the phrases one word longer than those of the last of the ``shorter`` bitmaps
    (broadcast)."""
    counted = map_arrow(docs, _bucket_counter(shorter, bits), "block int, buckets binary, n binary")
    found = map_arrow(counted.repartition("block").sortWithinPartitions("block"),
                      _block_bits(min_count, bits), "block int, bits binary")
    whole = bytearray((1 << bits) // 8 or 1)
    for row in found.collect():   # at most 2^(bits - BLOCK_BITS) rows, together as large as the bitmap
        at = row.block << (BLOCK_BITS - 3)
        whole[at:at + len(row.bits)] = row.bits
    return bytes(whole)


def _gram_records(maps_refs, bits: int):
    """Batch function: the longest phrase that starts at each word, counted a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(m.value, np.uint8) for m in maps_refs]
        for batch in slices(batches, "text"):
            for lang, blob in _blobs(batch):
                ids, words = _word_ids(blob)
                reach, _ = _reach(lang, ids, words, maps, LONGEST, bits)
                yield from _counted(lang, ids, words, reach)
    return run


def _counted(lang: str, ids: np.ndarray, words: list[bytes], chain: list[np.ndarray]) \
        -> Iterator[pa.RecordBatch]:
    shown = pa.array([w.decode() for w in words], pa.string())
    size = len(words)
    alone = (ids > 0) & ~chain[1]
    n = np.bincount(ids[alone], minlength=size)
    once = np.flatnonzero(n)
    if len(once):
        yield _records(lang, shown.take(pa.array(once)), np.ones(len(once), np.int8), n[once])
    start = np.flatnonzero(chain[1])
    if not len(start):
        return
    # -1 where the phrase has ended; pairs of words, then pairs of pairs, as numbers
    at = [np.where(chain[j][start], ids[np.minimum(start + j, len(ids) - 1)], -1)
          for j in range(LONGEST)]
    front, first = np.unique(at[0] * size + at[1], return_inverse=True)
    back, second = np.unique((at[2] + 1) * (size + 1) + at[3] + 1, return_inverse=True)
    key, n = np.unique(first * len(back) + second, return_counts=True)
    f, b = front[key // len(back)], back[key % len(back)]
    columns = [f // size, f % size, b // (size + 1) - 1, b % (size + 1) - 1]
    for i in range(0, len(n), 1 << 17):
        part = slice(i, i + (1 << 17))
        text = [shown.take(pa.array(c[part], mask=c[part] < 0)) for c in columns]
        joined = pc.binary_join_element_wise(*text, " ", null_handling="skip")
        lengths = sum((c[part] >= 0).astype(np.int8) for c in columns)
        yield _records(lang, joined, lengths.astype(np.int8), n[part])


def _records(lang: str, phrase: pa.Array, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64))), phrase,
         pa.array(words, pa.int8()), pa.array(n, pa.int64())], names=["lang", "phrase", "words", "n"])


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang",
                  min_count: int = MIN_COUNT, bits: int = BUCKET_BITS) \
        -> tuple[DataFrame, DataFrame]:
    """Counts (lang, phrase, words, f) of all phrases of one to ``LONGEST`` words with
    ``f >= min_count``, and the number of words ``n`` of each language."""
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                     text_or_empty(text).alias("text"))
    maps: list = []
    for _ in range(2, LONGEST):
        found = frequent_buckets(docs, min_count, maps, bits)
        maps.append(docs.sparkSession.sparkContext.broadcast(found))
    records = store(
        map_arrow(docs, _gram_records(maps, bits),
                  "lang string, phrase string, words tinyint, n bigint")
        .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")), "phrase-records")
    level = records.where(F.col("words") == LONGEST)
    found = [level.where(F.col("f") >= min_count)]
    for k in range(LONGEST - 1, 0, -1):
        # flow out of the nodes of k words, and the records that end with them
        flow = level.select("lang", F.substring_index("phrase", " ", k).alias("phrase"), "f")
        ends = records.where(F.col("words") == k).select("lang", "phrase", "f")
        level = store(flow.unionAll(ends).groupBy("lang", "phrase").agg(F.sum("f").alias("f")),
                      "phrase-flow")
        found.append(level.where(F.col("f") >= min_count)
                     .select("lang", "phrase", F.lit(k).cast("tinyint").alias("words"), "f"))
    counts = found[0]
    for part in found[1:]:
        counts = counts.unionByName(part)
    totals = level.groupBy("lang").agg(F.sum("f").alias("n"))
    return store(counts, "phrase-counts"), totals


def compact_paths(counts: DataFrame) -> DataFrame:
    """Unary paths of the graph: (lang, phrase, n_words, f); a path of one edge is that
    edge.  Every edge lies in exactly one path.

    Two edges are joined at a node where all flow comes in by the one and goes out by
    the other.  Paths are found by pointer doubling over the edges, in rounds that follow
    the logarithm of the longest path.  Every occurrence of a path runs along all of it,
    so a path is never longer than a piece of a text.
    """
    nodes = counts.where(F.col("words") == LONGEST - 1).select(
        "lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    edges = counts.where(F.col("words") == LONGEST).select("lang", "phrase", "f")
    whole = F.col("f") == F.col("flow")   # at most one edge a node
    enters = edges.withColumn("node", F.substring_index("phrase", " ", 1 - LONGEST)) \
        .join(nodes, ["lang", "node"]).where(whole).select("lang", "node", F.col("phrase").alias("before"))
    leaves = edges.withColumn("node", F.substring_index("phrase", " ", LONGEST - 1)) \
        .join(nodes, ["lang", "node"]).where(whole).select("lang", "node", "phrase")
    links = leaves.join(enters, ["lang", "node"]).select("lang", "phrase", "before")
    # each edge points to one before it, ``steps`` back; heads point to themselves
    state = store(edges.join(links, ["lang", "phrase"], "left").select(
        "lang", "phrase", "f", F.coalesce("before", "phrase").alias("head"),
        F.col("before").isNotNull().cast("int").alias("steps"),
        F.col("before").isNull().alias("done")), "paths")
    while not state.where("NOT done").isEmpty():
        seen = state.select("lang", F.col("phrase").alias("head"), F.col("head").alias("next"),
                            F.col("steps").alias("more"), F.col("done").alias("at_head"))
        moved = state.where("NOT done").join(seen, ["lang", "head"]).select(
            "lang", "phrase", "f", F.col("next").alias("head"),
            (F.col("steps") + F.col("more")).alias("steps"), F.col("at_head").alias("done"))
        state = store(state.where("done").unionByName(moved), "paths")
    last = F.substring_index("phrase", " ", -1)
    ordered = F.array_sort(F.collect_list(F.when(F.col("steps") > 0, F.struct("steps", last.alias("w")))))
    return state.groupBy("lang", "head").agg(ordered.alias("tail"), F.max("f").alias("f")).select(
        "lang", F.concat_ws(" ", "head", F.col("tail")["w"]).alias("phrase"),
        (F.size("tail") + LONGEST).alias("n_words"), "f")


def _inside(phrases: DataFrame, width: int, n_words: str) -> DataFrame:
    """Phrases of ``width`` words inside each phrase, with its count as ``longer``."""
    parts = F.transform(F.sequence(F.lit(1), F.col(n_words).cast("int") - width + 1),
                        lambda i: F.array_join(F.slice("_w", i, F.lit(width)), " "))
    return phrases.withColumn("_w", F.split("phrase", " ")) \
        .select("lang", F.explode(parts).alias("phrase"), F.col("f").alias("longer"))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang",
                 min_count: int = MIN_COUNT, contained_percent: int = CONTAINED_PERCENT,
                 bits: int = BUCKET_BITS) -> DataFrame:
    """Scored phrases of each language: lang, phrase, words, a, l, r, n, score.

    Candidates are phrases of 2 to ``LONGEST`` words that occur ``min_count`` times or
    more; those inside a longer candidate with ``contained_percent`` % of their count
    or more are dropped.  The score is that of the lowest-scoring cut, with its counts
    ``l`` and ``r``.  Null languages are ``und``, null texts empty; an empty table
    gives no rows, repeated rows count each.  Other columns are left out, so none can
    clash.  Texts are read whole; a task holds about 4 MB of text, or the longest
    piece.
    """
    counts, totals = phrase_counts(df, text, lang, min_count, bits)
    paths = store(compact_paths(counts), "compact")
    of = counts.where(F.col("words") > 1)
    by_edges = _inside(paths, LONGEST - 1, "n_words")
    shorter = [_inside(of.where(F.col("words") == k), k - 1, "words") for k in range(3, LONGEST)]
    covered = by_edges
    for part in shorter:
        covered = covered.unionByName(part)
    covered = covered.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    dec = "CAST({} AS DECIMAL(20, 0))".format
    kept = store(of.join(covered, ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR {dec('longer')} * 100 < {dec('f')} * {contained_percent}"))
        .select("lang", "phrase", "words", F.col("f").alias("a")), "candidates")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1))) \
        .withColumn("left", F.expr("substring_index(phrase, ' ', cut)")) \
        .withColumn("right", F.expr("substring_index(phrase, ' ', cut - words)"))
    of_part = counts.where(F.col("words") < LONGEST)
    left = of_part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = of_part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn(
        "score", F.expr(f"({dec('a')} * {SCORE_SCALE}) DIV ({dec('l')} + {dec('r')})"))
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.join(totals, "lang").select("lang", "phrase", "words", "a", "low.l", "low.r", "n",
                                              "low.score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return collocations(table(spark, sf_dir, "documents", "lang", "text")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP) \
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# Independent counting of every phrase of every length, no graph.
ORACLE = rf"""WITH pieces AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
         lambda i: array_to_string(list_slice(ws, i, i + k - 1), ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cand AS (SELECT lang, k, phrase, c, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
sub AS (
  SELECT lang, unnest(list_transform(range(1, k - m + 2),
         lambda i: array_to_string(list_slice(ws, i, i + m - 1), ' '))) AS phrase, c
  FROM cand, (SELECT unnest([2, 3]) AS m) WHERE m < k),
longest AS (SELECT lang, phrase, max(c) AS c FROM sub GROUP BY ALL),
kept AS (
  SELECT d.* FROM cand d LEFT JOIN longest s ON s.lang = d.lang AND s.phrase = d.phrase
  WHERE s.c IS NULL OR 100 * CAST(s.c AS HUGEINT) < {CONTAINED_PERCENT} * CAST(d.c AS HUGEINT)),
cuts AS (
  SELECT lang, phrase, c AS a, k, ws, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT u.lang, u.phrase, u.a, u.cut, x.c AS l, y.c AS r,
         CAST(({SCORE_SCALE} * CAST(u.a AS HUGEINT)) // (CAST(x.c AS HUGEINT) + y.c) AS BIGINT) AS score
  FROM cuts u
  JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(list_slice(u.ws, 1, u.cut), ' ')
  JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(list_slice(u.ws, u.cut + 1, u.k), ' ')),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS t FROM scored)
  WHERE t = 1),
ranked AS (
  SELECT l.lang, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l.l, r, t.n, score
  FROM lowest l JOIN totals t ON t.lang = l.lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}"""
