"""Substring duplicates by fixed-block anchors.

Every text's words are cut into blocks of ``anchor`` words that do not overlap: the index.
Every run of ``anchor`` words, at any position, probes it. A repeat of at least ``window``
words must hold a whole block of one of its copies if window >= 2 * anchor - 1, so the
other copies find it. Hits are then extended to both sides: all runs of ``window`` words
around a hit are compared, by 92-bit hashes, with all others around hits, and those that
occur twice, run together, are the maximal exact repeats.

Both comparisons go through ``codes``: groups of texts send distinct codes to buckets and
learn which of them met. So a passage that a third of all documents share costs a group
one code, not a row for each pair. The texts are shuffled once, by group; later steps use
the same shuffle again.

Cases: a missing or empty text has no words; texts under ``window`` words stay as they
are; every copy of a repeat is removed, the first too; repeats within a document count;
repeated rows count as texts of their own; an empty table gives no rows; a missing doc_id
stays missing; other columns are not read.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import codes as C
from txrisk.llm import tables

WINDOW = 35
OUT = "doc_id string, n_words bigint, n_removed bigint, kept_sha256 string"


def _around(hit: np.ndarray, n: int, anchor: int, window: int) -> np.ndarray:
    """Which runs of ``window`` words hold a hit run of ``anchor`` words."""
    before = np.concatenate([[0], np.cumsum(hit)])
    last = window - anchor + 1
    return before[last : last + n] > before[:n]


def _second(text: str, at: np.ndarray, window: int) -> np.ndarray:
    """32 bits of a hash of the runs from ``at``, of the other family, words and all."""
    hashes = C.window_hashes(C.word_hashes(text, family=1), window, family=1)
    return (hashes[at] >> np.uint64(32)).astype(np.uint32)


def _repeats(text, hashes, near: C.Met, window: int, anchor: int, bits: int):
    """Starts of the runs around hits, with the two hashes of each."""
    short = C.window_hashes(hashes, anchor) >> np.uint64(64 - bits)
    at = np.flatnonzero(_around(near.holds(short), len(hashes) - window + 1, anchor, window))
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    long = C.window_hashes(hashes, window)[at] >> np.uint64(4)
    return at, long, _second(text, at, window)


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``window`` words from one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """For each document: its words, how many lie in runs of ``window`` words that occur
    elsewhere, and a digest of the others (or, if asked for, the others as a text)."""
    anchor = (window + 1) // 2
    rows = tables.texts(docs)
    groups, buckets, bits = C.layout(rows)
    dealt = C.grouped(docs, groups)
    # as text, since pandas has no whole numbers beside missing ones
    dealt = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))

    def probe(key: tuple, texts: pd.DataFrame) -> pd.DataFrame:
        found, flags = [], []
        for text in texts["text"]:
            hashes = C.word_hashes(text)
            if len(hashes) >= window:
                own = C.window_hashes(hashes, anchor) >> np.uint64(64 - bits)
                flag = np.zeros(len(own), np.uint64)
                flag[::anchor] = C.INDEXED
                found.append(own)
                flags.append(flag)
        if not found:
            return pd.DataFrame(columns=["bucket", "grp", "codes", "extra"])
        return C.send(key[0], np.concatenate(found), np.concatenate(flags), None, bits, buckets)

    def extend(key: tuple, texts: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        near, found, more = C.Met(replies), [], []
        for text in texts["text"] if len(near.codes) else ():
            hashes = C.word_hashes(text)
            if len(hashes) >= window:
                _, a, b = _repeats(text, hashes, near, window, anchor, bits)
                found.append(a)
                more.append(b)
        if not found:
            return pd.DataFrame(columns=["bucket", "grp", "codes", "extra"])
        a, b = np.concatenate(found), np.concatenate(more)
        return C.send(key[0], a, np.full(len(a), C.INDEXED, np.uint64), b, 60, buckets)

    def keep(key: tuple, texts: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        twice, out = C.Met(replies), []
        for name, text in zip(texts["doc_id"], texts["text"], strict=True):
            words = C.words_of(text)
            n, gone = len(words), 0
            if n >= window and len(twice.codes):
                hashes = C.word_hashes(text)
                a = C.window_hashes(hashes, window) >> np.uint64(4)
                at = np.flatnonzero(twice.holds(a))
                if len(at):
                    b = _second(text, at, window)
                    cut = covered(n, at[twice.holds(a[at], b)], window)
                    words = [w for w, c in zip(words, cut.tolist(), strict=True) if not c]
                    gone = n - len(words)
            kept = b" ".join(words)
            last = kept.decode() if with_text else hashlib.sha256(kept).hexdigest()
            out.append((name, n, gone, last))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])

    probes = dealt.groupBy("grp").applyInPandas(probe, C.SENT)
    near = C.met(probes)
    by_group = dealt.groupBy("grp")
    around = by_group.cogroup(near.groupBy("grp")).applyInPandas(extend, C.SENT)
    twice = C.met(around)
    out = by_group.cogroup(twice.groupBy("grp")).applyInPandas(keep, OUT)
    out = out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return out.withColumnRenamed("kept_sha256", "kept") if with_text else out


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(tables.read(spark, sf_dir, "documents"))
