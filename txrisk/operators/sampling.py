"""Seeded picks without replacement, by row content.

Every pick compares a hash of the row key with a bound, so it needs no row order and
gives the same rows under any partitioning.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import hashing as H
from txrisk.operators.quantiles import SMALL_GROUP, nth_smallest
from txrisk.operators.ranges import with_first
from txrisk.sources.stages import materialize

OVERSAMPLE = 1.5  # candidates per wanted row, before the exact cut
COPIES = 10_000  # copies of one row numbered by a task at a time


def numbered_copies(df: DataFrame, columns) -> DataFrame:
    """``columns`` and ``_copy``: rows with equal ``columns``, numbered from 0.

    Copies are counted with partial aggregation, then told apart by number alone, since
    nothing else tells them apart; a row with very many copies is numbered by many tasks.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    few, many = counted.where(F.col("_n") <= COPIES), counted.where(F.col("_n") > COPIES)
    last = F.expr(f"CAST((_n - 1) div {COPIES} AS BIGINT)")
    spread = many.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    spread = spread.withColumn("_from", F.col("_from") * COPIES).repartition("_from", *columns)
    both = few.withColumn("_from", F.lit(0).cast("bigint")).unionByName(spread)
    end = F.least(F.col("_n"), F.col("_from") + COPIES) - 1
    return both.select(*columns, F.explode(F.sequence("_from", end)).alias("_copy"))


def tree_candidates(
    df: DataFrame,
    columns,
    share: float,
    *,
    trees: int = S.N_TREES,
    seed: int = S.SEED,
    key=None,
) -> DataFrame:
    """``tree``, ``rank_hash`` and ``columns``: each row is drawn for each tree on its own,
    with probability ``share``.

    The first tree that draws a row has a geometric number, found from one hash word; a row
    whose number is beyond the last tree, nearly every row of a large table, is done with
    that. Only the others are tried for each later tree. ``rank_hash`` is uniform below
    ``share`` of all words and orders a tree's candidates.
    """
    if key is None:
        df = numbered_copies(df, columns)
        key = F.concat_ws("|", H.row_key(columns), F.col("_copy").cast("string"))
    else:
        key = H.key_of(df, key)
    share = min(share, 1.0)
    drawn = df.withColumn("_key", key).withColumn("_u", H.word(H.digest(F.col("_key"), seed), 0))
    if share < 1.0:
        first = F.floor(F.log(1 - F.col("_u") / float(H.SPAN)) / F.lit(math.log(1 - share)))
    else:
        first = F.lit(0)
    drawn = drawn.withColumn("_first", first.cast("bigint")).where(F.col("_first") < trees)
    each = F.explode(F.sequence("_first", F.lit(trees - 1).cast("bigint")))
    tried = drawn.withColumn("tree", each)
    pair = F.concat_ws("|", "_key", F.col("tree").cast("string"))
    tried = tried.withColumn("_h", H.word(H.digest(pair, f"{seed}|trees"), 0))
    is_first = F.col("tree") == F.col("_first")
    kept = tried.where(is_first | (F.col("_h") < F.lit(H.share_bound(share))))
    within = F.floor(F.col("_h").cast("double") * F.lit(float(share))).cast("bigint")
    return kept.select(*columns, "tree", F.when(is_first, within).otherwise(F.col("_h")).alias("rank_hash"))


def tree_samples(
    df: DataFrame,
    rows: int,
    columns=None,
    *,
    trees: int = S.N_TREES,
    size: int = S.SAMPLE_SIZE,
    seed: int = S.SEED,
    key=None,
    oversample: float = OVERSAMPLE,
) -> DataFrame:
    """``min(size, rows)`` rows per tree, drawn for each tree on its own from all rows.

    One scan keeps the candidates, about ``oversample * size`` rows per tree however
    large the table, in a stage; the exact cut, at the lowest ``rank_hash``, is made there.
    Should some tree have too few, the share is raised and the scan repeated. The rule is
    the same at every table size.

    ``key`` names columns that tell all rows apart: then no row is moved before it is drawn.
    Without it, rows with equal ``columns`` are counted first and drawn as so many rows.
    """
    columns = df.columns if columns is None else list(columns)
    size = min(size, rows)
    lowest = Window.partitionBy("tree").orderBy("rank_hash", *columns)
    while True:
        share = min(oversample * size / rows, 1.0) if rows else 1.0
        candidates = tree_candidates(df, columns, share, trees=trees, seed=seed, key=key)
        found = materialize(candidates, "candidates")
        short = trees - found.groupBy("tree").count().where(F.col("count") >= size).count()
        if short == 0 or share >= 1.0:
            break
        oversample *= 2
    ranked = found.withColumn("_rank", F.row_number().over(lowest))
    return ranked.where(F.col("_rank") <= size).drop("_rank")


@dataclass
class ExactPick:
    """Where the ``n`` rows with the lowest hashes end: rows below the cut are all picked,
    ``short`` of the ``on_cut`` rows on it."""

    cut: int
    short: int
    on_cut: int


def exact_pick(hashed: DataFrame, column: str, n: int, rows: int, small=SMALL_GROUP) -> ExactPick:
    """The cut is the n-th smallest hash, found exactly by the quantile scans."""
    hashes = materialize(hashed.select(column), "hashes")  # read several times, 8 bytes a row
    cut = int(nth_smallest(hashes, column, n - 1, rows, small))
    h = F.col(column)
    below, on = hashes.agg(F.count_if(h < cut), F.count_if(h == cut)).first()
    return ExactPick(cut, n - below, on)


def mark_exact(
    df: DataFrame, name: str, hashed: Column, n: int, rows: int, small: int = SMALL_GROUP
) -> DataFrame:
    """``df`` with a column ``name`` that is true on exactly ``n`` of its ``rows`` rows.

    They are those with the lowest hashes: a filter on the scan, no row is sorted or moved.
    Only where part of the rows that share the hash on the cut is wanted, those rows are
    taken apart, counted in the order of their columns over as many tasks as they need, and
    put back.
    """
    if n <= 0 or n >= rows:
        return df.withColumn(name, F.lit(n > 0))
    keyed = df.withColumn("_hash", hashed)
    pick = exact_pick(keyed, "_hash", n, rows, small)
    h = F.col("_hash")
    if pick.short == pick.on_cut:
        return keyed.withColumn(name, h <= pick.cut).drop("_hash")
    rest = keyed.where(h != pick.cut).withColumn(name, h < pick.cut)
    on_cut = keyed.where(h == pick.cut).drop("_hash")
    counted = with_first(on_cut, pick.short, pick.on_cut, name)
    return rest.drop("_hash").unionByName(counted)


def sample_exact(
    df: DataFrame,
    fraction: float,
    *,
    key="transaction_id",
    seed: int = S.SEED,
    rows: int | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Exactly ``floor(rows * fraction)`` rows without replacement, by the hash of ``key``.

    Rows that share the key on the cut, however many, are taken in the order of their columns.
    """
    if rows is None:
        rows = df.count()
    n = min(int(math.floor(rows * fraction)), rows)
    if n == 0:
        return df.limit(0)
    hashed = H.word(H.digest(H.key_of(df, key), seed), 0)
    return mark_exact(df, "_picked", hashed, n, rows, small).where("_picked").drop("_picked")


def sample_share(df: DataFrame, share: float, *, key="transaction_id", seed: int = S.SEED):
    """About ``share`` of the rows, each picked on its own."""
    return df.where(H.chosen(H.key_of(df, key), seed, share))
