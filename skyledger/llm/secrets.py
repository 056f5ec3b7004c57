"""Secret scan with corpus-wide ownership frequency.

Every whole text is scanned for three base kinds and for candidates in further
public credential formats.  Candidate values are counted over the whole corpus by
distinct owners, repositories and texts.  The places of a value are its
repositories, copies of one text counted once.  A value is a widely copied example
when its places, doubled for each owner beyond the first, reach
``EXAMPLE_SPREAD``: many places of one owner, or few places of many owners; any
other value is a live-looking credential.  All spans are reported with their
class; those of the further kinds that are examples stand apart.

Only digests of values and texts leave the scan.  Rows of (value, owner,
repository) and of (value, text) are made distinct and counted with map-side
aggregation, so a value copied into a third of all rows meets as one row a task;
its spans are joined to the stored counts, which the skew join can split.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, slices, store, table, text_or_empty

EXAMPLE_SPREAD = 16    # least places x 2^(owners - 1) of a copied example

# Base kinds (fixed patterns and least lengths).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Further kinds: published credential formats, with a text that each must hold.
FURTHER = [
    ("github", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("slack", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("google", "AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
    ("stripe", "k_live_", re.compile(r"\b[rs]k_live_[A-Za-z0-9]{16,}")),
    ("jwt", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("private_key", "PRIVATE KEY-----", re.compile(
        r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----")),
]
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
OPAQUE_BITS = 4.0      # least entropy of a character of an opaque candidate
KINDS = ["assign", "access", "hex", *[k for k, _, _ in FURTHER], "opaque"]


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base kinds, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)
                  if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def further_spans(text: str, taken: list[tuple[int, int, int, str]]):
    """Candidates of the further kinds that overlap no earlier span."""
    used = bytearray(len(text))
    found = []
    for s, _, e, _ in taken:
        used[s:e] = b"\1" * (e - s)

    def add(kind: int, m: re.Match) -> None:
        s, e = m.span()
        if 1 not in used[s:e]:
            used[s:e] = b"\1" * (e - s)
            found.append((s, kind, e, m[0]))

    for kind, (_, hint, pattern) in enumerate(FURTHER, 3):
        if hint in text:
            for m in pattern.finditer(text):
                add(kind, m)
    for m in OPAQUE.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and any(c.islower() for c in v) \
                and any(c.isupper() for c in v) and _entropy(v) >= OPAQUE_BITS:
            add(len(KINDS) - 1, m)
    return found


SPAN = "struct<start:int,kind:int,end:int,value:binary>"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
                      ("value", pa.binary())])
    for batch in slices(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            rows.append([{"start": s, "kind": k, "end": e, "value": hashlib.blake2b(
                v.encode(), digest_size=16).digest()}
                for s, k, e, v in sorted(base + further_spans(text, base))])
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(rows, pa.list_(kind))],
                                         names=[*rest.schema.names, "found"])


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners, repositories and texts of each ``value`` (value, owner,
    repository, print: the hash of the text)."""
    places = (found.select("value", "owner", "repository").distinct()
              .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("value").agg(F.count(F.lit(1)).alias("owners"),
                                    F.sum("n").alias("repositories")))
    texts = found.select("value", "print").distinct() \
        .groupBy("value").agg(F.count(F.lit(1)).alias("texts"))
    return places.join(texts, "value")


def is_live() -> Column:
    return F.least("repositories", "texts") * F.pow(F.lit(2.0), F.col("owners") - 1) \
        < EXAMPLE_SPREAD


def find_secrets(df: DataFrame, keys: list[str], owner: str, repository: str,
                 text: str = "text") -> DataFrame:
    """Secret spans of every whole text, with the ownership of their values.

    Returns ``keys``, ``spans`` and ``examples``, arrays of (start, kind, end, base,
    owners, repositories, live, texts) in order of start and kind; offsets are code
    points, ends exclusive.  ``examples`` has the spans of the further kinds whose
    value is a copied example, ``spans`` all others.  Other columns are left out, so
    none can clash (``keys`` must not name ``found``, ``spans`` or ``examples``).
    Null and empty texts have no spans.  A null owner or repository counts as one
    more owner or repository.  Repeated rows come out repeatedly, and count once in
    a value's ownership; an empty table gives no rows.
    """
    rows = df.select(*[F.col(k) for k in keys], F.col(owner).cast("string").alias("owner"),
                     F.col(repository).cast("string").alias("repository"),
                     F.monotonically_increasing_id().alias("row"),
                     F.xxhash64(text_or_empty(text)).alias("print"),
                     text_or_empty(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                      for f in rows.schema.fields if f.name != "text")
    scanned = store(map_arrow(rows, scan, f"{kinds}, found array<{SPAN}>"), "secret-spans")
    each = scanned.select("row", "owner", "repository", "print", F.explode("found").alias("s"))
    owners = store(ownership(each.select("s.value", "owner", "repository", "print")),
                   "secret-owners")
    # spans of a text are bounded by its length; they come together again by row
    spans = (
        each.select("row", "s.*").join(owners, "value")
        .withColumn("base", F.col("kind") < 3)
        .withColumn("live", is_live())
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
            "start", "kind", "end", "base", "owners", "repositories", "live", "texts")))
            .alias("_all")))
    none = F.array().cast(spans.schema["_all"].dataType)
    found = F.coalesce("_all", none)
    return scanned.join(spans, "row", "left").select(
        *[F.col(k) for k in keys],
        F.filter(found, lambda s: s["base"] | s["live"]).alias("spans"),
        F.filter(found, lambda s: ~(s["base"] | s["live"])).alias("examples"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the source owns, and each document is a repository.  ``spans`` has
    all spans, and ``classes`` the class, owners and repositories of each."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    found = find_secrets(docs.withColumn("repository", F.col("doc_id")), ["doc_id"],
                         "source", "repository") \
        .withColumn("spans", F.array_sort(F.concat("spans", "examples")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(shown(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_examples"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", F.when(s["live"], "live").otherwise("example"), s["owners"].cast("string"),
            s["repositories"].cast("string"))), ",").alias("classes"))
