"""URL rules by a sort-merge range join over reversed-host keys.

A host's labels in reverse order, each followed by a dot, turn "host and all of its
subdomains" into an interval of keys.  Rules and URLs are sorted together; a sweep
keeps the stack of rules whose interval is open, nested by construction, and gives
each URL the longest rule on the stack whose path its own path starts with.

Keys are dealt to ``parts`` ranges at boundaries taken from a bounded sample; a
rule goes to every range that its interval meets (ranges inside nested intervals
are few levels deep), so each range sweeps by itself.  URL keys end in a hash of
the row: a host or URL with a third of all rows spans many ranges.  The sample
decides balance only, never results.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

DEFAULT_VERDICT = "allow"   # of a URL that no rule fits
SAMPLE_KEYS = 20            # sampled keys for each range

# The rules of the query (fixed values): host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
         ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: str = "url") -> Column:
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")),
                                        r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")),
                            r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """``www.example.org`` -> ``org.example.www.``"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def dealer(bounds: list[str]):
    """Adds ``part``: the range of a URL's key, or each range that a rule's keys meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, parts = [], []
            for i, (key, rule) in enumerate(zip(batch.column("key").to_pylist(),
                                                batch.column("is_rule").to_pylist())):
                low = bisect_right(bounds, key)
                # the interval ends before the prefix with its last dot raised to "/"
                high = max(low, bisect_left(bounds, key[:-1] + "/")) if rule else low
                parts.extend(range(low, high + 1))
                at.extend([i] * (high + 1 - low))
            wide = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*wide.columns, pa.array(parts, pa.int32())],
                                             names=[*wide.schema.names, "part"])

    return run


class Stack:
    """Open intervals, outermost first: prefix, and rules by length of their path."""

    def __init__(self):
        self.open: list[tuple[str, str, dict[int, dict[str, str]]]] = []

    def close(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, prefix: str, host: str, path: str, verdict: str) -> None:
        self.close(prefix)
        if not self.open or self.open[-1][0] != prefix:
            self.open.append((prefix, host, {}))
        paths = self.open[-1][2].setdefault(len(path), {})
        paths[path] = min(verdict, paths.get(path, verdict))

    def find(self, path: str) -> tuple[str | None, str | None]:
        """Rule and verdict of the longest open rule that ``path`` starts with; of
        rules equally long, the one with the longest host."""
        best: tuple[int, int, str, str] | None = None
        for _, host, paths in self.open:
            for n in paths:
                if n <= len(path) and (verdict := paths[n].get(path[:n])) is not None:
                    found = (len(host) + n, len(host), host + path[:n], verdict)
                    best = found if best is None or found[:2] > best[:2] else best
        return best[2:] if best else (None, None)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (part, key, rules first) -> URLs with rule and verdict."""
    stack, part = Stack(), None
    for batch in batches:
        rules, verdicts, held = [], [], []
        columns = [batch.column(c).to_pylist()
                   for c in ("part", "key", "is_rule", "host", "path", "verdict")]
        for i, (now, key, is_rule, host, path, verdict) in enumerate(zip(*columns)):
            if now != part:
                stack, part = Stack(), now
            if is_rule:
                stack.add(key, host, path, verdict)
                continue
            stack.close(key)
            rule, verdict = stack.find(path)
            held.append(i)
            rules.append(rule)
            verdicts.append(verdict)
        urls = batch.take(pa.array(held, pa.int64())) \
            .drop_columns(["part", "key", "is_rule", "verdict"])
        yield pa.RecordBatch.from_arrays(
            [*urls.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=[*urls.schema.names, "rule", "found"])


def judge(df: DataFrame, rules: DataFrame, keys: list[str], url: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """Longest fitting rule of every URL.

    ``rules`` has host, path and verdict; a rule fits its host and all subdomains
    where the URL's path starts with the rule's.  Of repeated rules with several
    verdicts the first by name holds; rules with a null in them are let go.
    Returns ``keys``, ``host``, ``path``, ``rule`` (null where none fits) and
    ``verdict`` (the rule's, else ``default``); other columns are left out, so none
    can clash (``keys`` must not name these).  A null URL, or one without ``://``,
    has an empty host and path.  Repeated rows come out repeatedly; empty tables of
    URLs or rules are valid.
    """
    spark = df.sparkSession
    urls = df.select(*[F.col(k) for k in keys], url_host(url).alias("host"),
                     url_path(url).alias("path"))
    urls = urls.select(
        "*", F.concat(reversed_host(F.col("host")), F.lit("\0"),
                      F.hex(F.xxhash64(*keys, "path"))).alias("key"),
        F.lit(False).alias("is_rule"), F.lit(None).cast("string").alias("verdict"))
    own = rules.select(*[F.col(c).cast("string").alias(c) for c in ("host", "path", "verdict")]) \
        .where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    own = own.select(*[F.lit(None).cast(urls.schema[k].dataType).alias(k) for k in keys],
                     "host", "path", reversed_host(F.col("host")).alias("key"),
                     F.lit(True).alias("is_rule"), "verdict")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = urls.count()
    sample = [] if n == 0 else sorted(
        r.key for r in urls.select("key")
        .sample(min(1.0, parts * SAMPLE_KEYS / n), 1).limit(2 * parts * SAMPLE_KEYS).collect())
    bounds = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    both = urls.unionByName(own)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema.fields)
    dealt = map_arrow(both, dealer(bounds), f"{kinds}, part int") \
        .repartition(parts, "part").sortWithinPartitions("part", "key", F.desc("is_rule"))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                    for f in urls.select(*keys, "host", "path").schema.fields)
    swept = map_arrow(dealt, sweep, f"{out}, rule string, found string")
    return swept.select(*keys, "host", "path", "rule",
                        F.coalesce("found", F.lit(default)).alias("verdict"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages", "page_id", "url"), rules, ["page_id"])


ORACLE = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
         ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fit AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM u LEFT JOIN fit USING (page_id)
"""
