"""Hash codes of word windows, and an exchange that finds which codes occur twice.

Texts are dealt to groups. A group sends each code it has once, sorted and delta-coded,
to the bucket of the code's range; a bucket tells each group which of its codes met
another occurrence. However often a code occurs, a bucket gets it once from each group,
so a frequent code makes no bucket large, and no pair of occurrences is ever formed.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from txrisk.llm import tables

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of two hash families
BYTE_BASE = 0x8EBC6AF09C88C6E3
MULTIPLE, INDEXED = 1, 2  # flags of a code: twice in the group; from the reference side
GROUP_CHARS = 8_000_000
BUCKET_CODES = 2_000_000
SENT = "bucket int, grp bigint, codes binary, extra binary"
REPLY = "grp bigint, codes binary, extra binary"


def words_of(text: str) -> list[bytes]:
    """Maximal runs of other bytes than blank, tab and line controls (0x20, 0x09-0x0D)."""
    return text.encode().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 4096), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        if n <= 1_000_000:
            _powers[base] = held
    return held[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


SEEDS = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)  # of the words in two hash families


def word_hashes(text: str, lower: bool = False, family: int = 0) -> np.ndarray:
    """A hash of each word of ``words_of``, in order, by family. Every eight bytes are
    scrambled with their place in the word, and the sum with the word's length, so words
    that exchange parts get other hashes. ``lower``: A-Z count as a-z."""
    return _word_hashes(text.encode(), lower, family)[0]


def word_hashes_of(texts: list[str], lower: bool = False, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of several texts, one behind the other, and the text each belongs to."""
    data = [t.encode() for t in texts]
    hashes, starts = _word_hashes(b" ".join(data), lower, family)
    sizes = np.fromiter(map(len, data), np.int64, len(data)) + 1
    return hashes, np.searchsorted(np.cumsum(sizes) - sizes, starts, side="right") - 1


def _word_hashes(data: bytes, lower: bool, family: int) -> tuple[np.ndarray, np.ndarray]:
    data += bytes(8)
    if lower:
        data = data.lower()  # of bytes: A-Z only
    blank = _SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.r_[0, edge]
    starts, ends = edge[::2], edge[1::2]
    if len(starts) > len(ends):  # the bytes put behind the text are no part of it
        ends = np.r_[ends, len(data)]
    ends = np.minimum(ends, len(data) - 8)
    if len(starts) and starts[-1] >= len(data) - 8:
        starts, ends = starts[:-1], ends[:-1]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    pieces = (sizes + 7) >> 3
    first = np.cumsum(pieces) - pieces
    place = np.arange(first[-1] + pieces[-1]) - np.repeat(first, pieces)
    at = np.repeat(starts, pieces) + 8 * place
    cut = 64 - 8 * np.minimum(np.repeat(ends, pieces) - at, 8)
    # eight bytes from any place on, without those behind the word
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[at] << cut.astype(np.uint64)
    place = place.astype(np.uint64) * np.uint64(BYTE_BASE) + np.uint64(SEEDS[family])
    sums = np.add.reduceat(mix(eight + place), first, dtype=np.uint64)
    return mix(sums + sizes.astype(np.uint64) * np.uint64(BASES[family])), starts


def window_hashes(hashes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """A hash of every run of ``length`` words: a polynomial modulo 2^64 of their hashes (of
    the same family), from prefix sums."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = BASES[family]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _power(base, len(hashes)), dtype=np.uint64, out=sums[1:])
    inverse = _power(pow(base, -1, 1 << 64), n)
    return mix((sums[length:] - sums[:-length]) * inverse)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences of as few bytes each as they need: the count,
    half a byte of length each, then the bytes."""
    if not len(values):
        return b""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    size = np.ones(len(steps), np.uint8)
    for byte in range(1, 8):
        size += steps >> np.uint64(8 * byte) > 0
    lengths = np.append(size, np.uint8(0)) if len(size) % 2 else size
    data = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[np.arange(8) < size[:, None]]
    head = np.array([len(values)], "<u8").tobytes()
    return head + (lengths[::2] | lengths[1::2] << 4).tobytes() + data.tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    pairs = np.frombuffer(raw, np.uint8, (n + 1) // 2, 8)
    size = np.stack([pairs & 15, pairs >> 4], axis=1).reshape(-1)[:n]
    data = np.frombuffer(raw, np.uint8, offset=8 + len(pairs))
    out = np.zeros((n, 8), np.uint8)
    out[np.arange(8) < size[:, None]] = data
    return np.cumsum(out.view("<u8").reshape(-1), dtype=np.uint64)


def code_bits(chars: int, spare: int = 9) -> int:
    """Bits a code needs so that chance meetings stay rare among so many characters."""
    return min(60, max(24, int(chars).bit_length() + spare - 2))


def layout(docs: DataFrame) -> tuple[int, int, int]:
    """Groups, buckets and code bits for texts like these, from one aggregate."""
    from pyspark.sql import functions as F

    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = min(least, 1 + chars // 100_000)
    groups = max(least, -(-chars // GROUP_CHARS))
    return groups, max(least, -(-chars // (5 * BUCKET_CODES))), code_bits(chars)


def send(group: int, codes, flags, extra, bits: int, buckets: int) -> pd.DataFrame:
    """What a group sends: its distinct codes, a row for each bucket. ``codes`` come in any
    order and with repetitions; ``extra`` (32 bits each, or None) is part of a code."""
    keys = (codes,) if extra is None else (extra, codes)
    order = np.lexsort(keys) if extra is not None else np.argsort(codes, kind="stable")
    codes, flags = codes[order], flags[order]
    first = np.ones(len(codes), bool)
    first[1:] = codes[1:] != codes[:-1]
    if extra is not None:
        extra = extra[order]
        first[1:] |= extra[1:] != extra[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return pd.DataFrame(columns=["bucket", "grp", "codes", "extra"])
    merged = np.bitwise_or.reduceat(flags, at)
    merged |= (np.diff(at, append=len(codes)) > 1) * np.uint64(MULTIPLE)
    codes = codes[at]
    width = np.uint64(-(-(1 << bits) // buckets))
    edges = np.searchsorted(codes, np.arange(buckets + 1).astype(np.uint64) * width)
    edges[-1] = len(codes)
    tagged = codes << np.uint64(2) | merged
    rows = [
        (
            b,
            group,
            pack_sorted(tagged[a:z]),
            b"" if extra is None else extra[at[a:z]].astype("<u4").tobytes(),
        )
        for b, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True))
        if z > a
    ]
    return pd.DataFrame(rows, columns=["bucket", "grp", "codes", "extra"])


def _meet(sent: pd.DataFrame) -> pd.DataFrame:
    """In one bucket: which codes of each group occur twice in all, once as indexed."""
    parts = [unpack_sorted(raw) for raw in sent["codes"]]
    sizes = np.array([len(p) for p in parts])
    tagged = np.concatenate(parts)
    codes, flags = tagged >> np.uint64(2), tagged & np.uint64(3)
    raw = b"".join(sent["extra"])
    extra = np.frombuffer(raw, "<u4") if raw else np.zeros(len(codes), np.uint32)
    order = np.lexsort((extra, codes)) if raw else np.argsort(codes, kind="stable")
    code, more, flag = codes[order], extra[order], flags[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (more[1:] != more[:-1])
    at = np.flatnonzero(first)
    merged = np.bitwise_or.reduceat(flag, at)
    runs = np.diff(at, append=len(code))
    good = ((runs > 1) | (merged & np.uint64(MULTIPLE) > 0)) & (merged & np.uint64(INDEXED) > 0)
    hit = np.zeros(len(code), bool)
    hit[order] = np.repeat(good, runs)
    ends = np.cumsum(sizes)
    rows = []
    for group, a, z in zip(sent["grp"], ends - sizes, ends, strict=True):
        own = np.flatnonzero(hit[a:z]) + a
        if len(own):
            kept = extra[own].astype("<u4").tobytes() if raw else b""
            rows.append((group, pack_sorted(codes[own]), kept))
    return pd.DataFrame(rows, columns=["grp", "codes", "extra"])


def met(sent: DataFrame) -> DataFrame:
    """Replies (grp, codes, extra) to what groups sent."""
    return sent.groupBy("bucket").applyInPandas(_meet, REPLY)


class Met:
    """The codes of one group that met another occurrence."""

    def __init__(self, replies: pd.DataFrame):
        parts = [unpack_sorted(raw) for raw in replies["codes"]]
        codes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        raw = b"".join(replies["extra"])
        extra = np.frombuffer(raw, "<u4") if raw else np.zeros(len(codes), np.uint32)
        order = np.lexsort((extra, codes))
        self.codes, self.extra = codes[order], extra[order]
        same = np.flatnonzero(self.codes[1:] == self.codes[:-1])
        self.longest = 1 if not len(same) else 1 + len(same)  # the longest run, at most

    def holds(self, codes: np.ndarray, extra: np.ndarray | None = None) -> np.ndarray:
        found = np.zeros(len(codes), bool)
        if not len(self.codes):
            return found
        at = np.searchsorted(self.codes, codes)
        for _ in range(self.longest):
            inside = np.minimum(at, len(self.codes) - 1)
            equal = (self.codes[inside] == codes) & (at < len(self.codes))
            found |= equal if extra is None else equal & (self.extra[inside] == extra)
            if extra is None:
                break
            at = at + 1
        return found


def grouped(docs: DataFrame, groups: int) -> DataFrame:
    """doc_id, text and the group of each document."""
    from pyspark.sql import functions as F

    rows = tables.texts(docs)
    return rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
