"""Operator 10: URL rules and a blocked Bloom filter of listed canonical URLs.

Host-and-path rules decide first, the longest that fits wins.  Where none
fits, a URL is blocked if its canonical form is listed.  The list's canonical
URLs fill a blocked Bloom filter: a hash chooses a block of eight 64-bit lanes
and sets one bit in each, so a test reads one cache line.  Pages that the
filter turns down are surely not listed; the possible hits go to an exact join
with the list, which removes the false positives.

The filter has about ``BITS_PER_URL`` bits per listed URL, and never more than
``FILTER_BYTES``: that bound covers what the driver gathers and what is
broadcast.  A longer list makes the filter fuller and the exact join larger;
the verdicts are the same.

Canonical form: host without a leading ``www.`` or ``m.`` and without a port,
path without trailing slashes; scheme, query and fragment do not count.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits
no rule, is never listed and is allowed; repeated rows are judged alike; an
empty list allows all that no rule blocks; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm.common import ascii_lower, ship, stage

#: Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LANES = 8
BITS_PER_URL = 16
FILTER_BYTES = 16 << 20

_SALT = (0x44974D91, 0x47B6137B, 0x5C6BFB31, 0x2DF1424B, 0x08824947, 0x1D4C6A29, 0x6F83B5E3, 0x72A1D985)


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url):
    """Then up to ``?``, ``#`` or the end."""
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, canonical (null where there is no host)."""
    out = pages.select("page_id", F.col("url").cast("string").alias("url"))
    out = out.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    bare = F.regexp_replace(F.regexp_replace("host", r":[0-9]*$", ""), r"^(www|m)\.", "")
    canonical = F.concat(bare, F.regexp_replace("path", r"/+$", ""))
    return out.withColumn("canonical", F.when(F.col("host") != "", canonical))


def rule_columns(rules=RULES):
    """(rule, verdict) columns; the longest rule that fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def _block(h, blocks: int):
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))


def bloom(urls: DataFrame, n: int) -> np.ndarray:
    """The filter of distinct (canonical): an array of (blocks, LANES) words.
    Lanes are OR-ed in Spark; the driver gets at most FILTER_BYTES."""
    blocks = int(min(max(1, -(-n * BITS_PER_URL // (64 * LANES))), FILTER_BYTES // (8 * LANES)))
    h = F.xxhash64("canonical")
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    lanes = []
    for i, salt in enumerate(_SALT):
        place = F.pmod(F.shiftrightunsigned(low * F.lit(salt), 16), F.lit(64)).cast("int")
        lanes.append(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias(f"l{i}"))
    rows = urls.select("canonical").groupBy(_block(h, blocks).alias("block")).agg(*lanes)
    out = np.zeros((blocks, LANES), dtype=np.int64)
    got = rows.toPandas()
    if len(got):
        out[got["block"].to_numpy()] = got[[f"l{i}" for i in range(LANES)]].to_numpy()
    return out.view(np.uint64)


def maybe_listed(filter_words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be in the filter."""
    u = h.view(np.uint64)
    word = filter_words[(u >> np.uint64(32)) % np.uint64(len(filter_words))]
    low = u & np.uint64(0xFFFFFFFF)
    bits = np.stack([(low * np.uint64(s) >> np.uint64(16)) % np.uint64(64) for s in _SALT], axis=1)
    return ((word >> bits) & np.uint64(1)).all(axis=1)


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of ``pages``
    (page_id, url); ``listed`` has a column ``canonical``."""
    spark = pages.sparkSession
    ship(spark)
    listed = stage(listed.select("canonical").filter("canonical is not null").distinct(), "listed")
    words = spark.sparkContext.broadcast(bloom(listed, listed.count()))

    @F.pandas_udf("boolean")
    def passes(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = words.value
        for h in hashes:
            yield pd.Series(maybe_listed(own, np.ascontiguousarray(h.to_numpy(dtype=np.int64))))

    rule, verdict = rule_columns(rules)
    rows = with_parts(pages).withColumn("rule", rule).withColumn("verdict", verdict)
    # a rule's page and one without a host need no test
    asked = F.col("verdict").isNull() & F.col("canonical").isNotNull()
    rows = rows.withColumn("maybe", F.when(asked, passes(F.xxhash64(F.coalesce("canonical", F.lit(""))))).otherwise(F.lit(False)))
    # pages that cannot be listed keep no join key: they are dealt out by their id instead of meeting in one task
    key = F.when(F.col("maybe"), F.xxhash64("canonical")).otherwise(F.xxhash64("page_id", "url"))
    rows = rows.withColumn("k", key).withColumn("want", F.when(F.col("maybe"), F.col("canonical")))
    exact = listed.select(F.xxhash64("canonical").alias("lk"), F.col("canonical").alias("lc"), F.lit(True).alias("hit"))
    out = rows.join(exact, (F.col("k") == F.col("lk")) & (F.col("want") == F.col("lc")), "left")
    hit = F.coalesce(F.col("hit"), F.lit(False))
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), hit.alias("listed"))


def syndicated(pages: DataFrame) -> DataFrame:
    """The list of the registered query: canonical URLs of which the table
    holds an address with a feed's tracking parameter; all addresses of such
    an article are then blocked, whatever their scheme, query or fragment."""
    return with_parts(pages.filter(F.col("url").contains("utm_source="))).select("canonical")


def op10(spark, sf_dir: str) -> DataFrame:
    """Every page's URL judged."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, syndicated(pages)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
canon AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(www|m)\\.', '')
      || regexp_replace(path, '/+$', '') END AS canonical
  FROM parts),
listed AS (SELECT DISTINCT canonical FROM canon WHERE contains(url, 'utm_source=') AND canonical IS NOT NULL),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (SELECT DISTINCT host, path FROM canon),
ruled AS (
  SELECT u.host, u.path, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule,
    arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
  FROM urls u, rules r
  WHERE (u.host = r.rhost OR suffix(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
  GROUP BY u.host, u.path)
SELECT c.page_id, c.host, c.path, ruled.rule,
  coalesce(ruled.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN ruled ON c.host = ruled.host AND c.path = ruled.path LEFT JOIN listed l ON c.canonical = l.canonical
"""
