"""Pseudo-random numbers from row content.

A row's numbers come from the MD5 of its key and a seed, never from its position, so
a pick is the same under any partitioning, on any cluster, and after a lost task is
run again.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schema import REQUIRED

MISSING = "\x00missing"
BITS = 52
SPAN = 1 << BITS  # the words below are uniform over [0, SPAN)
_HEX = BITS // 4


def row_key(names) -> Column:
    """MD5 of the named columns as texts, each with its length and missing ones marked, so
    that different rows have different texts."""
    parts = []
    for c in names:
        text = F.col(c).cast("string")
        told = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(told, F.lit("-")))
    return F.md5(F.concat(*parts))


def key_of(df, key=None) -> Column:
    """Row key as text: the one named column (missing: a mark), or a hash over several.

    Without names, all data columns: the required ones that are present, which tell
    de-duplicated rows apart; a table with none of them is keyed by all its columns.
    """
    if key is None:
        return row_key([c for c in REQUIRED if c in df.columns] or df.columns)
    names = [key] if isinstance(key, str) else list(key)
    if len(names) == 1:
        return F.coalesce(F.col(names[0]).cast("string"), F.lit(MISSING))
    return row_key(names)


def digest(key: Column, seed) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key))


def word(digest_col: Column, index: int) -> Column:
    """The first (0) or second (1) 52-bit word of a digest, as BIGINT."""
    hexa = F.substring(digest_col, 1 + index * _HEX, _HEX)
    return F.conv(hexa, 16, 10).cast("bigint")


def share_bound(share: float) -> int:
    """Words below this number make up ``share`` of all words."""
    return int(min(max(share, 0.0), 1.0) * SPAN)


def chosen(key: Column, seed, share: float) -> Column:
    """True for about ``share`` of the keys."""
    return word(digest(key, seed), 0) < F.lit(share_bound(share))
