"""URL filter: path rules first, then a list of keys held in a Bloom filter cascade.

The key of a url is its host and path. A list of keys is usually far larger than memory
and a single Bloom filter errs; but when every key that can be asked for is known (here:
all keys of the corpus), a cascade does not. Level 0 encodes the listed keys. Level 1
encodes the unlisted keys that level 0 lets through, level 2 the listed ones that level 1
lets through, and so on until none is left. A key is decided by the first level that
does not hold it.

Keys are dealt by hash to shards of about ``SHARD_KEYS`` keys, each with its own cascade,
built in one group of two hashes a key. Asking needs no join: the cascades are broadcast,
``BROADCAST_BYTES`` at most at a time; larger ones take further passes over the rows.

Cases: a missing url, or one without ``://``, has empty host and path, fits no rule and is
asked for by the empty key; listed keys outside the corpus are never asked for, so they
are left out; repeated rows and ties get the same verdict each; an empty list or table is
allowed; other columns are not read.
"""

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import tables
from txrisk.sources.stages import materialize

# Fixed values: (host, path start, verdict); the longest that fits decides.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Names of hosts on the list, and the mark of urls spread by ad feeds.
LISTED_NAMES = ["spam-farm", "cheap-pills", "casino", "lottery", "free-money"]
FEED_MARK = "utm_source="

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARD_KEYS = 200_000
BROADCAST_BYTES = 64 << 20
MAX_LEVELS = 100


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for at, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name = F.when(fits, at + start).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def _places(h1, h2, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit numbers of each key at a level: one row for each hash."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % 2**64)
    a = (h1 ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
    a ^= a >> np.uint64(32)
    b = ((h2 + salt) * np.uint64(0xC4CEB9FE1A85EC53)) | np.uint64(1)
    b ^= (b >> np.uint64(29)) << np.uint64(1)
    i = np.arange(hashes, dtype=np.uint64)[:, None]
    return (((a + i * b) >> np.uint64(11)) % np.uint64(bits)).astype(np.int64)


def _holds(filter_bits: np.ndarray, bits: int, hashes: int, level: int, h1, h2) -> np.ndarray:
    at = _places(h1, h2, level, bits, hashes)
    return ((filter_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> bytes:
    """The cascade of one shard: keys by two hashes, and which of them are listed."""
    inside = [(h1[listed], h2[listed]), (h1[~listed], h2[~listed])]
    levels, level = [], 0
    while len(inside[0][0]):
        (a, b), (c, d) = inside
        # Level 0 lets through about as many unlisted keys as there are listed ones.
        rate = min(0.5, len(a) * 0.5**0.5 / max(len(c), 1)) if level == 0 else 0.5
        hashes = max(1, round(-np.log2(rate)))
        bits = int(np.ceil(len(a) * hashes / np.log(2))) + 8
        own = np.zeros(bits // 8 + 1, np.uint8)
        at = _places(a, b, level, bits, hashes).ravel()
        np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        through = _holds(own, bits, hashes, level, c, d)
        levels.append(np.array([bits, hashes, len(own)], "<i8").tobytes() + own.tobytes())
        inside, level = [(c[through], d[through]), (a, b)], level + 1
        if level > MAX_LEVELS:
            raise ValueError("a listed and an unlisted key have the same hashes")
    return b"".join(levels)


def ask_cascade(cascade: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys of the shard's universe are listed."""
    answer, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
    at = level = 0
    while at < len(cascade):
        bits, hashes, size = np.frombuffer(cascade, "<i8", 3, at).tolist()
        own = np.frombuffer(cascade, np.uint8, size, at + 24)
        open_ = open_[_holds(own, bits, hashes, level, h1[open_], h2[open_])]
        answer[open_] = level % 2 == 0
        at, level = at + 24 + size, level + 1
    return answer


def _hashed(rows: DataFrame, shards: int) -> DataFrame:
    pair = F.xxhash64("key"), F.xxhash64("key", F.lit(1))
    return rows.withColumns(
        {"h1": pair[0], "h2": pair[1], "shard": F.pmod(F.xxhash64("key", F.lit(2)), F.lit(shards))}
    )


def cascades(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """Cascades of (key, listed), one row a shard, and the number of shards. Every key
    stands once in ``universe``."""
    shards = max(1, -(-universe.count() // shard_keys))

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        pair = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        raw = build_cascade(*pair, keys["listed"].to_numpy(bool))
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "cascade": [raw]})

    hashed = _hashed(universe, shards).select("shard", "h1", "h2", "listed")
    made = hashed.groupBy("shard").applyInPandas(build, "shard bigint, cascade binary")
    return materialize(made, "cascades"), shards


def in_list(rows: DataFrame, made: DataFrame, shards: int, limit: int = BROADCAST_BYTES):
    """``rows`` (with a column ``key``) and ``listed``: whether the cascades hold the key."""
    spark = rows.sparkSession
    sizes = made.select("shard", F.length("cascade").alias("n")).orderBy("shard").collect()
    groups, room = [], 0
    for shard, n in sizes:
        if not groups or n > room:
            groups.append([])
            room = limit
        groups[-1].append(shard)
        room -= n
    out = _hashed(rows, shards).withColumn("listed", F.lit(False))
    for i, group in enumerate(groups):
        chosen = made.filter((F.col("shard") >= group[0]) & (F.col("shard") <= group[-1]))
        held = spark.sparkContext.broadcast({r.shard: r.cascade for r in chosen.collect()})

        def ask(some: dict, held=held) -> dict:
            listed = np.array(some["listed"], bool)
            pair = [np.array(some[c], np.int64).view(np.uint64) for c in ("h1", "h2")]
            shard = np.array(some["shard"])
            for s in np.unique(shard):
                if s in held.value:
                    at = np.flatnonzero(shard == s)
                    listed[at] = ask_cascade(held.value[s], *(x[at] for x in pair))
            return {**some, "listed": listed}

        out = tables.map_slices(out, lambda: ask, out.schema)
        if i + 1 < len(groups):
            out = materialize(out, "asked")
    return out.drop("h1", "h2", "shard")


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules=RULES, shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """page_id, host, path, the rule that fits (else null) and the verdict of every page.
    ``listed`` holds the column ``key``: host and path in a row."""
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    marked = rows.select("key", F.lit(False).alias("listed"), F.lit(True).alias("asked"))
    on_list = listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("asked"))
    universe = (
        marked.union(on_list)
        .groupBy("key")
        .agg(F.max("listed").alias("listed"), F.max("asked").alias("asked"))
        .filter("asked AND key IS NOT NULL")
        .drop("asked")
    )
    made, shards = cascades(materialize(universe, "universe"), shard_keys)
    answered = in_list(rows, made, shards)
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return answered.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict")
    )


def listed_keys(pages: DataFrame) -> DataFrame:
    """The list of the registered query: keys on hosts of a listed name, and keys that any
    url of the corpus shows as spread by an ad feed."""
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    names = functools.reduce(
        lambda a, b: a | b, (F.concat(F.lit("."), host).contains(f".{n}.") for n in LISTED_NAMES)
    )
    rows = pages.filter(names | url.contains(FEED_MARK))
    return rows.select(F.concat(host, path).alias("key")).distinct()


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, listed_keys(pages))


def _sql() -> str:
    names = " OR ".join(f"contains('.' || host, '.{n}.')" for n in LISTED_NAMES)
    cases = []
    for at, start, says in sorted(RULES, key=lambda r: -len(r[0] + r[1])):
        fits = f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{start}')"
        cases.append((fits, at + start, says))
    rule = " ".join(f"WHEN {fits} THEN '{name}'" for fits, name, _ in cases)
    verdict = " ".join(f"WHEN {fits} THEN '{says}'" for fits, _, says in cases)
    return f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0
    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
listed AS (SELECT DISTINCT host || path AS key FROM parts
  WHERE {names} OR contains(url, '{FEED_MARK}'))
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,
  CASE {verdict} WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM parts"""


SQL = _sql()
