"""Near duplicates: b-bit MinHash signatures under a multi-index Hamming join.

A signature has ``INDEX`` symbols of 16 bits for the index and ``SKETCH`` symbols
of 8 bits that only sharpen the distance.  The index symbols are split into
``CHUNKS`` chunks of ``WIDTH``.  Two signatures that differ in at most
``CHUNKS * (ERRORS + 1) - 1`` index symbols agree, by the pigeonhole principle, on
some chunk but for ``ERRORS`` symbols.  Enumerating the allowed errors (each
symbol of each chunk left out in turn) gives ``CHUNKS * WIDTH`` keys a document,
and every pair within that distance shares a key; nothing is capped.

At Jaccard similarity 0.8 a symbol differs with probability 0.2, so a pair has
more than 13 of 21 index symbols differing with probability 1e-5, and more than
``MAX_DISTANCE`` of all 64 with probability 1e-5.

Documents with equal shingle sets are one node.  In each key's bucket pairs are
compared by signature in blocks inside the task; only the documents of close
pairs go on, each pair in the first key that it shares.  Their whole texts then
meet in the same groups, where full shingle sets confirm links.  A pair already
connected within its group is skipped, so a group gives fewer links than it has
members.  In buckets above ``BLOCK`` members first link to a pivot, and only what
that leaves apart is compared, in pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, addressed, map_arrow, slices, store, table, text_or_empty
from .components import components

SHINGLE = 4            # words (the query's contract)
PERCENT = 80           # similarity of a link, in hundredths
CHUNKS, WIDTH, ERRORS = 7, 3, 1
INDEX = CHUNKS * WIDTH
SKETCH = 43
MAX_INDEX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
MAX_DISTANCE = 27
BLOCK = 512            # documents of one block of a large bucket
BLOCK_SHINGLES = 2 ** 21   # and their shingles: 16 MB of sets, some 14 MB of text
WORD_CACHE = 100_000

_rng = np.random.Generator(np.random.PCG64(7))
FLIPS = _rng.integers(0, 2 ** 63, INDEX + SKETCH, np.uint64) * np.uint64(2)
FACTORS = _rng.integers(0, 2 ** 63, INDEX + SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes.  Words are split at
    ASCII white space, and only A-Z is lower-cased, as ``bytes`` methods do."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.width, len(words))
        total = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            total = _mixed(total * MIX + h[i:len(h) - n + 1 + i])
        return np.unique(total)


def signature(shingles: np.ndarray) -> bytes:
    least = np.full(INDEX + SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = (shingles[i:i + 2048, None] ^ FLIPS) * FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    bits = _mixed(least)
    return ((bits[:INDEX] >> np.uint64(48)).astype("<u2").tobytes()
            + (bits[INDEX:] >> np.uint64(56)).astype(np.uint8).tobytes())


def unpack(signatures: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, 2 * INDEX + SKETCH)
    return np.ascontiguousarray(raw[:, :2 * INDEX]).view("<u2"), raw[:, 2 * INDEX:]


def keys_of(index: np.ndarray) -> np.ndarray:
    """All index keys of each signature: number of the key, then the chunk's
    symbols but for the one left out."""
    out = np.empty((len(index), INDEX), np.int64)
    symbols = index.astype(np.int64)
    for k in range(INDEX):
        chunk, omitted = divmod(k, WIDTH)
        a, b = [chunk * WIDTH + i for i in range(WIDTH) if i != omitted]
        out[:, k] = k << 32 | symbols[:, a] << 16 | symbols[:, b]
    return out


def close_pairs(index, sketch, side, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a bucket within the distances whose first shared key is ``key``,
    with their agreements.  ``side``: the block of each member; members of two
    blocks are compared across them only."""
    n = len(index)
    across = side[0] != side[-1]
    if side[0] < 0 and not across:
        return (np.zeros(0, np.int64),) * 3
    cut = int(np.searchsorted(side, side[-1])) if across else 0
    found = [], [], []
    step = max(1, 2 ** 21 // n)
    for lo in range(0, cut if across else n, step):
        hi = min(lo + step, cut if across else n)
        first = cut if across else lo
        same = np.zeros((hi - lo, n - first), np.uint8)
        for s in range(INDEX):
            same += index[lo:hi, s, None] == index[None, first:, s]
        near = same >= INDEX - MAX_INDEX_DISTANCE
        if not across:
            near &= np.arange(lo, hi)[:, None] < np.arange(first, n)[None, :]
        i, j = np.nonzero(near)
        agree = same[i, j].astype(np.int64)
        i, j = i + lo, j + first
        for at in range(0, len(i), 2 ** 18):
            part = slice(at, at + 2 ** 18)
            agree[part] += (sketch[i[part]] == sketch[j[part]]).sum(axis=1)
        held = agree >= INDEX + SKETCH - MAX_DISTANCE
        i, j, agree = i[held], j[held], agree[held]
        if len(i):
            held = first_shared(index, i, j) == key
            for out, x in zip(found, (i[held], j[held], agree[held])):
                out.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def first_shared(index, i, j) -> np.ndarray:
    """Number of the first key that each pair shares (INDEX if none)."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 2 ** 18):
        part = slice(at, at + 2 ** 18)
        equal = (index[i[part]] == index[j[part]]).reshape(-1, CHUNKS, WIDTH)
        missing = WIDTH - equal.sum(axis=2)
        shares = np.empty(equal.shape, bool)
        for omitted in range(WIDTH):
            shares[:, :, omitted] = (missing - ~equal[:, :, omitted]) == 0
        flat = shares.reshape(-1, INDEX)
        out[part] = np.where(flat.any(axis=1), flat.argmax(axis=1), INDEX)
    return out


def signer(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in slices(batches, "text"):
            counts, digests, signatures = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text)
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                signatures.append(signature(found) if len(found) else None)
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())],
                names=[*rest.schema.names, "n_shingles", "digest", "signature"])
    return run


def index_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, signature, weight) -> a row for each index key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = keys_of(unpack(batch.column("signature").to_pylist())[0])
        rows = pa.array(np.repeat(np.arange(batch.num_rows), INDEX))
        wide = batch.take(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), wide.column("node"), wide.column("signature"),
             wide.column("weight")], names=["key", "node", "signature", "weight"])


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Consecutive rows with equal ``names`` as tables; a run may span batches.
    Runs of one row are passed over."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        change = np.zeros(batch.num_rows, bool)
        change[0] = last is None or any(c[0] != x for c, x in zip(columns, last))
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        if held and (not len(starts) or starts[0] > 0):
            held.append(batch.slice(0, int(starts[0]) if len(starts) else batch.num_rows))
        if len(starts):
            if sum(b.num_rows for b in held) > 1:
                yield pa.Table.from_batches(held)
            ends = np.append(starts[1:], batch.num_rows)
            for a in np.flatnonzero(ends[:-1] - starts[:-1] > 1):
                yield pa.Table.from_batches([batch.slice(int(starts[a]),
                                                         int(ends[a] - starts[a]))])
            held = [batch.slice(int(starts[-1]))]
        last = [c[-1] for c in columns]
    if sum(b.num_rows for b in held) > 1:
        yield pa.Table.from_batches(held)


GROUP = ["key", "pair"]
MEMBERS = "key long, pair long, side long, node long, signature binary"


def close_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets in order of (key, pair, side) -> the members of close pairs."""
    for run in _runs(batches, GROUP):
        index, sketch = unpack(run.column("signature").to_pylist())
        i, j, _ = close_pairs(index, sketch, run.column("side").to_numpy(),
                              run.column("key")[0].as_py() >> 32)
        if len(i):
            members = run.take(pa.array(np.union1d(i, j)))
            yield from members.combine_chunks().to_batches()


def _with_sets(batches: Iterator[pa.RecordBatch], shingles: Shingler) \
        -> Iterator[pa.RecordBatch]:
    """Batches with the shingle sets in place of the texts."""
    for batch in slices(batches, "text"):
        sets = [shingles(t).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.large_binary())],
                                         names=[*rest.schema.names, "shingles"])


def confirmer(width: int, percent: int):
    """Groups in order of (key, pair, side), with texts -> links that connect
    what full shingle sets connect in the group.  A task holds the sets of one group:
    two blocks of ``BLOCK_SHINGLES`` and one document more, at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for group in _runs(_with_sets(batches, shingles), GROUP):
            index, sketch = unpack(group.column("signature").to_pylist())
            i, j, agree = close_pairs(index, sketch, group.column("side").to_numpy(),
                                      group.column("key")[0].as_py() >> 32)
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("shingles")]
            sizes = np.array([len(s) for s in sets])
            a, b = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
            held = 100 * a >= percent * b
            i, j, agree = i[held], j[held], agree[held]
            order = np.argsort(-agree, kind="stable")
            root = list(range(len(sets)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = []
            for x, y in zip(i[order].tolist(), j[order].tolist()):
                p, q = find(x), find(y)
                if p == q:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                    root[q] = p
                    links.append((x, y))
            if links:
                nodes = group.column("node").to_numpy()
                x, y = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[y])],
                                                 names=["a", "b"])
    return run


def near_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, signature, pivot, pivot_signature) -> the pairs within the distances."""
    for batch in batches:
        if not batch.num_rows:
            continue
        (i, a), (j, b) = (unpack(batch.column(c).to_pylist())
                          for c in ("signature", "pivot_signature"))
        agree = (i == j).sum(axis=1)
        held = (agree >= INDEX - MAX_INDEX_DISTANCE) & (
            agree + (a == b).sum(axis=1) >= INDEX + SKETCH - MAX_DISTANCE)
        yield batch.select(["node", "pivot"]).filter(pa.array(held))


def pair_confirmer(width: int, percent: int):
    """(node, pivot, text, pivot_text) -> the links among the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for batch in slices(batches, "text"):
            held = []
            for texts in zip(*[batch.column(c).cast(pa.binary()).to_pylist()
                               for c in ("text", "pivot_text")]):
                x, y = map(shingles, texts)
                both = len(np.intersect1d(x, y, assume_unique=True))
                held.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("pivot")], names=["a", "b"]) \
                .filter(pa.array(held))

    return run


def _texts_of(wanted: DataFrame, rows: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """(node, text) of the ``wanted`` nodes, stored.  Marks of four bytes, small enough to
    broadcast for longest, keep other texts out of the shuffle."""
    places = store(nodes.join(wanted, "node").select("node", ROW), f"{name}-places")
    marks = store(places.select(F.hash(ROW).alias("mark")).distinct(), f"{name}-marks")
    return store(rows.select(ROW, "text", F.hash(ROW).alias("mark"))
                 .join(marks, "mark", "left_semi").join(places, ROW).select("node", "text"),
                 name)


def _large_buckets(keys: DataFrame, large: DataFrame, rows: DataFrame, nodes: DataFrame,
                   width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to pivots and dealt members of the buckets above ``BLOCK`` documents or
    ``BLOCK_SHINGLES`` shingles.

    Every member is first compared with its bucket's pivot, a member by hash: work
    in proportion to the bucket.  A group of near copies falls in many buckets with
    a pivot each, so these links join nearly all of it.  What they joined most of a
    bucket needs no comparison within itself.  The others (minor members) are
    compared with each other and with it, in pairs of blocks.
    """
    members = store(keys.join(large.select("key"), "key"), "large-members")
    pivots = store(members.groupBy("key").agg(
        F.min_by(F.struct("node", "signature"), F.xxhash64("key", "node")).alias("p")), "pivots")
    near = store(map_arrow(
        members.join(pivots, "key").where(F.col("node") != F.col("p.node")).select(
            "node", "signature", F.col("p.node").alias("pivot"),
            F.col("p.signature").alias("pivot_signature")),
        near_pivot, "node long, pivot long").distinct(), "near-pivot")
    wanted = store(near.select("node").unionAll(near.select("pivot")).distinct(), "wanted")
    held = _texts_of(wanted, rows, nodes, "wanted-texts")
    links = store(map_arrow(
        near.join(held, "node").join(held.select(
            F.col("node").alias("pivot"), F.col("text").alias("pivot_text")), "pivot")
        .select("node", "pivot", "text", "pivot_text"),
        pair_confirmer(width, percent), "a long, b long"), "pivot-links")
    rooted = store(members.join(components(links), "node", "left")
                   .withColumn("root", F.coalesce("root", "node")), "large-rooted")
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"),
                                              F.sum("weight").alias("w"))
    top = F.struct("n", "root", "w")
    most = store(sizes.groupBy("key").agg(
        F.max(top).alias("top"), (F.sum("n") - F.max(top)["n"]).alias("n_minor"),
        (F.sum("w") - F.max(top)["w"]).alias("w_minor")).select(
        "key", F.col("top.root").alias("most"), F.col("top.n").alias("n_most"),
        F.col("top.w").alias("w_most"), "n_minor", "w_minor"), "large-most")

    def cut(n: str, w: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / BLOCK),
                          F.when(F.col(n) > 0, F.ceil(F.col(w) / BLOCK_SHINGLES)).otherwise(0))

    blocks, others = cut("n_minor", "w_minor"), cut("n_most", "w_most")
    draw = F.xxhash64("node")
    both = rooted.join(most, "key").withColumns({"blocks": blocks, "others": others}) \
        .where("blocks > 0").withColumn("minor", F.col("root") != F.col("most"))
    minor = both.where("minor").withColumn("side", F.pmod(draw, F.col("blocks")))
    rows = ["key", "pair", "side", "node", "signature"]
    zero = F.lit(0).cast("long")
    among = minor.withColumn("o", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn(
        "pair", F.least("side", "o") * F.col("blocks") + F.greatest("side", "o"))
    # negative sides: minor members and the rest, compared across only
    first = F.col("blocks") * F.col("blocks")
    to_rest = minor.withColumn("o", F.explode(F.sequence(zero, F.col("others") - 1))) \
        .withColumn("pair", first + F.col("side") * F.col("others") + F.col("o")) \
        .withColumn("side", F.lit(-2).cast("long"))
    rest = both.where("NOT minor").withColumn(
        "o", F.explode(F.sequence(zero, F.col("blocks") - 1))) \
        .withColumn("pair", first + F.col("o") * F.col("others") + F.pmod(draw, F.col("others"))) \
        .withColumn("side", F.lit(-1).cast("long"))
    return links, among.select(rows).unionAll(to_rest.select(rows)).unionAll(rest.select(rows))


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition(*GROUP).sortWithinPartitions(*GROUP, "side")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                    carry: tuple[str, ...] = (), width: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """Components of documents linked by Jaccard similarity of word shingles.

    Returns one row per input row: ``carry``, ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest key reachable), ``kept`` (it is the row's own key) and
    ``component`` (number of the component, null without words); other columns are
    left out, so none can clash (``carry`` must not name these).  The key is a long.
    Texts without words (also null) have no shingles and are linked with nothing; with
    fewer than ``width`` words the whole sequence is one shingle.  Rows that share a
    key are linked.  Rows with a null key are compared like all others; a component
    without any key has a null ``component_id``, and all its rows are ``kept``: tell
    them apart by ``component``.  An empty table gives no rows.
    """
    if ROW not in carry:
        df = addressed(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                                 *[c for c in carry if c not in (key, text)]))
        key, text = "doc_id", "text"
    rows = df.select(*carry, *([] if ROW in carry else [ROW]),
                     F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in rows.schema.fields if f.name != "text")
    signed = store(map_arrow(rows, signer(width),
                             f"{kinds}, n_shingles long, digest binary, signature binary"),
                   "signatures")
    # one node a set of shingles, with one of its rows to read the text from
    nodes = store(signed.where("n_shingles > 0").groupBy("digest").agg(
        F.first("signature").alias("signature"), F.first("n_shingles").alias("weight"),
        F.min(ROW).alias(ROW)).withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = map_arrow(nodes.select("node", "signature", "weight"), index_keys,
                     "key long, node long, signature binary, weight long")
    large = store(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
                  .where((F.col("n") > BLOCK) | (F.col("w") > BLOCK_SHINGLES)).where("n > 1"),
                  "large-buckets")
    zero = F.lit(0).cast("long")
    dealt = keys.join(large, "key", "left_anti").select(
        "key", zero.alias("pair"), zero.alias("side"), "node", "signature")
    pivot_links = None
    if not large.isEmpty():
        pivot_links, parts = _large_buckets(keys, large, rows, nodes, width, percent)
        dealt = dealt.unionAll(parts)
    members = store(map_arrow(_grouped(dealt), close_members, MEMBERS), "members")
    # the members are few: only their texts are dealt, once to their groups
    held = _texts_of(members.select("node").distinct(), rows, nodes, "member-texts")
    texts = members.join(held, "node")
    links = map_arrow(_grouped(texts.select("key", "pair", "side", "node", "signature", "text")),
                      confirmer(width, percent), "a long, b long")
    # a key with several texts: link all of their nodes
    at = signed.where("n_shingles > 0 AND doc_id IS NOT NULL") \
        .join(nodes.select("digest", "node"), "digest").select("doc_id", "node")
    several = at.groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")) \
        .where("x <> y").select("doc_id", "x")
    same = at.join(several, "doc_id").select(F.col("x").alias("a"), F.col("node").alias("b"))
    links = links.unionAll(same)
    roots = components(links if pivot_links is None else links.unionAll(pivot_links))
    placed = store(signed.join(
        nodes.select("digest", "node").join(roots, "node", "left").select(
            "digest", F.coalesce("root", "node").alias("component")), "digest", "left").select(
        *carry, "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).alias("component")), "near-placed")
    names = store(placed.where("component IS NOT NULL").groupBy("component")
                  .agg(F.min("doc_id").alias("least")), "near-names")
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return placed.join(names, "component", "left").select(
        *carry, "doc_id", "n_shingles", own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"), "component")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).drop("component")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), d AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN []
         WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 2),
                             lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN d USING (doc_id) GROUP BY w.doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM d a JOIN d b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), e AS (
  SELECT x, y FROM l UNION SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON r.root = e.x
)
SELECT doc_id, n AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM r JOIN n USING (doc_id) GROUP BY doc_id, n
"""
