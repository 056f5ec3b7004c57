"""Vector code compression: a product quantiser trained by Lloyd rounds that
rescan only what can have changed.

A vector of integers is cut into equal parts; each part position has a codebook.
A round assigns every part to the nearest entry of its codebook (squared Euclidean
distance, ties to the lower index) and then replaces each entry by the floored mean
of its parts.  Assignments and exact distances are kept between rounds.  A part
whose entry stayed where it was keeps its stored distance, and so do all entries
that did not move and had already lost against it: it compares only the entries
that moved.  A part whose entry moved rescans the whole codebook.  Both ways give
the same answer as a full scan, ties included.

Spark holds the parts: each round is one pass over the stored rows of the round
before, without a shuffle.  A task adds up the parts of each entry as it goes and
appends one row an entry to its output, so that only codebook-sized sums are
shuffled.  Codebooks (``ENTRIES`` x vector width) are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, store, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Components up to this size keep every squared distance of a vector of up to 256
# components within 64 bits; beyond it the query fails instead of wrapping around.
MAX_COMPONENT = 2 ** 26
MAX_CODEBOOK_BYTES = 16 * 1024 ** 2   # bound of what is collected and broadcast
FLOAT_EXACT = 2 ** 53                 # integers below are exact in double arithmetic

STATE = ("vec_id bigint, label int, vec array<bigint>, codes array<int>, dists array<bigint>, "
         "part int, entry int, n bigint, total array<bigint>")


def integer_components(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; fails beyond ``MAX_COMPONENT``."""
    def one(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) >= F.lit(float(MAX_COMPONENT)),
                      F.raise_error(F.lit("vector component out of range")).cast("bigint")) \
            .otherwise(scaled)
    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``entries`` as int64."""
    if not len(x) or not len(entries):
        return np.zeros((len(x), len(entries)), np.int64)
    top = int(max(np.abs(x).max(), np.abs(entries).max()))
    if 4 * x.shape[1] * top * top < FLOAT_EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
    else:
        a, b = x, entries
    cross = a @ b.T
    return ((a * a).sum(1)[:, None] - 2 * cross + (b * b).sum(1)[None, :]).astype(np.int64)


def assign_part(x: np.ndarray, codebook: np.ndarray, moved: np.ndarray,
                codes: np.ndarray | None, dists: np.ndarray | None) \
        -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and distance of each row of ``x``.

    ``moved`` flags the entries that changed since ``codes`` and ``dists`` were
    taken; without these every row scans the whole codebook.
    """
    if codes is None:
        d = squared_distances(x, codebook)
        best = d.argmin(1)
        return best, d[np.arange(len(x)), best]
    best, least = codes.astype(np.int64), dists.copy()
    again = moved[best]
    if again.any():
        d = squared_distances(x[again], codebook)
        first = d.argmin(1)
        best[again], least[again] = first, d[np.arange(len(first)), first]
    active = np.flatnonzero(moved)
    fixed = np.flatnonzero(~again)
    if len(active) and len(fixed):
        d = squared_distances(x[fixed], codebook[active])
        first = d.argmin(1)   # the lowest index among the nearest moved entries
        near, entry = d[np.arange(len(first)), first], active[first]
        held, kept = least[fixed], best[fixed]
        better = (near < held) | ((near == held) & (entry < kept))
        best[fixed[better]], least[fixed[better]] = entry[better], near[better]
    return best, least


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width),
                                    pa.array(values.reshape(-1), kind))


def _rounder(books_ref, first: bool, sums: bool):
    """Batch function of one round: assigned rows, then one row an entry with the
    number and the sum of its parts in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moved = books_ref.value          # (parts, entries, width), (parts, entries)
        parts, entries, width = books.shape
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            at = batch.schema.get_field_index
            vectors = _matrix(batch.column(at("vec")), rows)
            if vectors.shape[1] != parts * width:
                raise ValueError("vectors differ in length")
            before = None if first else (_matrix(batch.column(at("codes")), rows),
                                         _matrix(batch.column(at("dists")), rows))
            codes = np.empty((rows, parts), np.int64)
            dists = np.empty((rows, parts), np.int64)
            for p in range(parts):
                x = vectors[:, p * width:(p + 1) * width]
                held = (None, None) if before is None else (before[0][:, p], before[1][:, p])
                codes[:, p], dists[:, p] = assign_part(x, books[p], moved[p], *held)
                if sums:
                    count[p] += np.bincount(codes[:, p], minlength=entries)
                    np.add.at(total[p], codes[:, p], x)
            nulls = [pa.nulls(rows, t) for t in (pa.int32(), pa.int32(), pa.int64(),
                                                 pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(at("vec_id")), batch.column(at("label")), batch.column(at("vec")),
                 _lists(codes, pa.int32()), _lists(dists, pa.int64()), *nulls], names=NAMES)
        if sums and count.any():
            p, e = np.nonzero(count)
            blank = [pa.nulls(len(p), t) for t in (pa.int64(), pa.int32(), pa.list_(pa.int64()),
                                                   pa.list_(pa.int32()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(p, pa.int32()), pa.array(e, pa.int32()),
                 pa.array(count[p, e], pa.int64()), _lists(total[p, e], pa.int64())], names=NAMES)

    return run


NAMES = [field.split()[0] for field in STATE.split(", ")]


def _updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with each used entry replaced by the floored mean of its parts.
    At most parts x entries rows reach the driver."""
    width = books.shape[2]
    sums = state.where("part IS NOT NULL").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)])
    new = books.copy()
    for row in sums.collect():
        new[row.part, row.entry] = [row[f"t{i}"] // row.n for i in range(width)]
    return new


def seeds(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks of the ``entries`` smallest ids (then vectors): (parts, entries, width)."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries) \
        .select("vec").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    widths = {len(r.vec) for r in first}
    if len(widths) > 1 or max(widths) % parts:
        raise ValueError(f"vectors must have one length that {parts} divides, not {sorted(widths)}")
    rows = np.array([r.vec for r in first], np.int64)
    if rows.nbytes > MAX_CODEBOOK_BYTES:
        raise ValueError(f"codebooks over {MAX_CODEBOOK_BYTES} bytes")
    return np.ascontiguousarray(rows.reshape(len(first), parts, -1).transpose(1, 0, 2))


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
             label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Codes of the usable vectors and the final codebooks.

    Returns (``vec_id``, ``label``, ``vec``, ``codes``, ``dists``) for each kept row
    and the codebooks as an array (parts, entries, width).  Rows whose vector is
    null, empty or holds a null, NaN or infinite component are dropped.  Null ids
    come after all others when the first entries are chosen, and rows with one id in
    the order of their vectors; repeated rows are coded each.  Fewer rows than entries give
    smaller codebooks, no rows empty ones.  Vectors of different lengths, of a length
    that ``parts`` doesn't divide, or with components of ``MAX_COMPONENT`` or more
    after scaling raise.  Other columns are left out, so none can clash.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(key).cast("bigint").alias("vec_id"),
                        F.col(label).cast("int").alias("label"),
                        F.col(vector).alias("vec")) \
        .where(usable(F.col("vec"))) \
        .withColumn("vec", integer_components(F.col("vec"), scale))
    books = seeds(vectors, parts, entries)
    blank = spark.createDataFrame([], STATE).select(*NAMES[:5])
    if not books.shape[1]:
        return blank, books
    state, moved = vectors, np.ones(books.shape[:2], bool)
    for turn in range(rounds + 1):
        last = turn == rounds
        ref = spark.sparkContext.broadcast((books, moved))
        state = store(map_arrow(state, _rounder(ref, turn == 0, not last), STATE), "codes")
        if not last:
            new = _updated(state, books)
            moved, books = (new != books).any(2), new
            state = state.where("part IS NULL").select(*NAMES[:5])
    return state.select(*NAMES[:5]), books


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    rows = coded.select(
        "vec_id", "label",
        F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
        .alias("code"),
        F.aggregate("dists", F.lit(0).cast("bigint"), lambda a, d: a + d).alias("error"))
    errors = store(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")),
                   "label-errors")
    return rows.join(errors, F.col("label").eqNullSafe(F.col("of"))) \
        .select("vec_id", "code", "error", "label_error",
                F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same by full scans: components, codebooks and distances as plain rows."""
    sql = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, vec) AS r, vec_id, label, vec FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0))""",
           f"""flat AS MATERIALIZED (
  SELECT r, (i - 1) // (n // {parts}) AS part, (i - 1) % (n // {parts}) AS pos, x FROM (
    SELECT r, len(vec) AS n, unnest(range(1, len(vec) + 1)) AS i, unnest(vec) AS x FROM kept))""",
           f"""book0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, pos, x AS c FROM flat WHERE r <= {entries})"""]
    for t in range(rounds + 1):
        sql.append(f"""near{t} AS MATERIALIZED (
  SELECT r, part, entry, d FROM (
    SELECT r, part, entry, d, row_number() OVER (PARTITION BY r, part ORDER BY d, entry) AS k
    FROM (SELECT f.r, f.part, b.entry, CAST(sum((f.x - b.c) * (f.x - b.c)) AS BIGINT) AS d
          FROM flat f JOIN book{t} b ON b.part = f.part AND b.pos = f.pos
          GROUP BY f.r, f.part, b.entry)) WHERE k = 1)""")
        if t < rounds:
            sql.append(f"""mean{t} AS (
  SELECT a.part, a.entry, f.pos, sum(f.x) AS s, CAST(count(*) AS HUGEINT) AS m
  FROM near{t} a JOIN flat f ON f.r = a.r AND f.part = a.part
  GROUP BY a.part, a.entry, f.pos),
book{t + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN m.m IS NULL THEN b.c ELSE
    CAST((m.s - ((m.s % m.m) + m.m) % m.m) // m.m AS BIGINT) END AS c
  FROM book{t} b LEFT JOIN mean{t} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    return "WITH " + ",\n".join(sql) + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h
           FROM book{rounds})
SELECT k.vec_id, c.code, c.error,
       CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT h FROM digest) AS codebooks_sha256
FROM kept k JOIN coded c ON c.r = k.r"""


ORACLE = _oracle()
