"""Exact order statistics and interpolated quantiles, at any size.

Spark's exact ``percentile`` keeps every distinct value of a group in one task. That is
used only for groups proven small. A larger group is narrowed first: each round takes two
cut points around the wanted ranks from a quantile sketch of all its rows, then counts
exactly how many rows lie below, on and between them. A rank either falls on a cut point,
which is then the answer, or strictly between the two, which hold about a percent of the
rows whatever the distribution and however often one value repeats. What is left of a
group once it is small is ranked directly, by running counts over ranges of values.

The sketch (KLL) is mergeable: every task sketches its own rows, the sketches of some tasks
are merged by a salt of the partition, and those by group, so no task sees the rows of a
group, or one sketch of each task. It is randomised and only chooses where to cut; it
never decides a result.

Columns of a whole table are scanned with the cuts as literals, all columns in one
aggregation; the driver holds two cuts a column. For groups the cuts are a table: a row for
each range still open, joined to the rows of its group. That join is broadcast when the
ranges are few, and else left to the planner, where adaptive execution splits a hot group.
"""

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.operators.ranges import running_sum
from txrisk.sources.stages import materialize

SMALL_GROUP = 250_000  # rows of a group whose distinct values one task may hold
BROADCAST_RANGES = 100_000  # open ranges, of a few numbers each, sent to every task
SKETCH_K = 4096  # rank error of a merged sketch: about an eighth of a percent
GRID = 400  # cut points a sketch offers; cuts lie one or two of them from the wanted ranks
SALTS = 64  # merges of a group's sketches that run side by side


@dataclass
class _Rank:
    """One wanted order statistic of a column: the value at 0-based ``rank``."""

    id: int
    group: str  # the column
    rank: int
    rows: int  # rows strictly between the cuts
    below: int = 0  # rows at or below the lower cut
    lower: float | None = None  # open interval; None is unbounded
    upper: float | None = None
    value: float | None = None
    done: bool = False

    def move(self, lo, hi, under, on_lo, inside, on_hi) -> None:
        """Place the rank among: under lo, on lo, inside, on hi, over hi."""
        at = self.rank - self.below
        if lo is not None and at < under:
            self.upper, self.rows = lo, under
        elif lo is not None and at < under + on_lo:
            self.value, self.done = lo, True
        elif at < under + on_lo + inside:
            if lo is not None:
                self.lower, self.below = lo, self.below + under + on_lo
            if hi is not None:
                self.upper = hi
            self.rows = inside
        elif at < under + on_lo + inside + on_hi:
            self.value, self.done = hi, True
        else:
            passed = under + on_lo + inside + on_hi
            self.lower, self.below, self.rows = hi, self.below + passed, self.rows - passed


TALLIES = ("under", "on_lo", "inside", "on_hi")


def _between(value: Column, lower: Column, upper: Column) -> Column:
    return (lower.isNull() | (value > lower)) & (upper.isNull() | (value < upper))


def _tallies(v: Column, lo: Column, hi: Column, within: Column | None = None) -> dict:
    """Exact counts of the rows under, on and between two cuts."""
    tests = {
        "under": v < lo,
        "on_lo": v == lo,
        "inside": _between(v, lo, hi),
        "on_hi": (v == hi) & (lo.isNull() | (lo < hi)),
    }
    return {k: F.count_if(t if within is None else t & within) for k, t in tests.items()}


def _partition_salt() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")


def _cuts(sketch: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Sketched values a step beyond the shares ``low`` and ``high`` of the rows; null where
    there are no rows beyond."""
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    some = F.kll_sketch_get_n_double(sketch) > 0
    points = F.when(some, F.kll_sketch_get_quantile_double(sketch, grid))
    left, right = F.floor(low * GRID) - 1, F.ceil(high * GRID) + 1
    return (
        F.when(left > 0, F.get(points, left.cast("int"))),
        F.when(right < GRID, F.get(points, right.cast("int"))),
    )


# ------------------------------------------------------------------ columns of a table


def _range(r: _Rank) -> Column:
    v, test = F.col(r.group), F.col(r.group).isNotNull()
    if r.lower is not None:
        test = test & (v > F.lit(r.lower))
    return test if r.upper is None else test & (v < F.lit(r.upper))


def _column_cuts(df: DataFrame, wide: list[list[_Rank]]) -> dict:
    """Two cut points for each range, by the id of its first rank: one scan of the columns."""
    names = {t[0].id: f"_s{t[0].id}" for t in wide}
    inside = [F.when(_range(t[0]), F.col(t[0].group)).alias(names[t[0].id]) for t in wide]
    salted = df.select(_partition_salt(), *inside).groupBy("_salt")
    parts = salted.agg(*[F.kll_sketch_agg_double(c, SKETCH_K).alias(c) for c in names.values()])
    merged = parts.agg(*[F.kll_merge_agg_double(c).alias(c) for c in names.values()])
    shares = []
    for t in wide:
        head, sketch = t[0], F.col(names[t[0].id])
        low, high = ((x - head.below) / head.rows for x in (head.rank, t[-1].rank + 1))
        lo, hi = _cuts(sketch, F.lit(low), F.lit(high))
        shares += [lo.alias(f"lo_{head.id}"), hi.alias(f"hi_{head.id}")]
    row = merged.select(*shares).first()
    return {i: (row[f"lo_{i}"], row[f"hi_{i}"]) for i in names}


def _column_counts(df: DataFrame, heads: list[_Rank], cuts: dict) -> dict:
    aggs = []
    for r in heads:
        lo, hi = (F.lit(c).cast("double") for c in cuts[r.id])
        tallies = _tallies(F.col(r.group), lo, hi, _range(r))
        aggs += [c.alias(f"{name}_{r.id}") for name, c in tallies.items()]
    row = df.agg(*aggs).first()
    return {r.id: tuple(row[f"{name}_{r.id}"] for name in TALLIES) for r in heads}


def _ranges(ranks) -> list[list[_Rank]]:
    """Open ranks by the cuts they lie between: one rank, or the two of a quantile."""
    found = {}
    for r in ranks:
        if not r.done:
            found.setdefault((r.group, r.lower, r.upper), []).append(r)
    return list(found.values())


def _rank_columns(df: DataFrame, ranges: list[list[_Rank]]) -> None:
    """Values of ranks in ranges that are small, from one scan."""
    tests, found = [], []
    for t in ranges:
        low, high = (F.lit(r.rank - t[0].below).cast("bigint") for r in (t[0], t[-1]))
        row = F.struct(
            F.lit(t[0].id).alias("_id"), low.alias("_a"), high.alias("_b"), F.col(t[0].group).alias("_v")
        )
        tests.append(_range(t[0]))
        found.append(F.when(tests[-1], row))
    hits = df.where(reduce(or_, tests)).select(F.explode(F.array(*found)).alias("_hit"))
    hits = hits.where(F.col("_hit").isNotNull()).select("_hit.*")
    counted = hits.groupBy("_id", "_a", "_b", "_v").agg(F.count(F.lit(1)).alias("_n"))
    rows = sum(t[0].rows for t in ranges)
    placed = running_sum(counted, ["_id"], ["_v"], rows, weight="_n")
    on = [_holds(F.col(c)) for c in ("_a", "_b")]
    values = {}
    for r in placed.where(on[0] | on[1]).collect():  # at most two rows a range
        for place in {r["_a"], r["_b"]}:
            if r["_upto"] - r["_n"] <= place < r["_upto"]:
                values[r["_id"], place] = r["_v"]
    for t in ranges:
        for r in t:
            r.value = values[t[0].id, r.rank - r.below]


def _holds(place: Column) -> Column:
    """Whether a value that makes up the ranks before ``_upto`` is at this place."""
    return (F.col("_upto") > place) & (F.col("_upto") - F.col("_n") <= place)


def _resolve(df: DataFrame, ranks: list[_Rank], small: int) -> None:
    """Find the value of every rank: narrow its range until that is small, then rank it."""
    columns = sorted({r.group for r in ranks})
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    while wide := [t for t in _ranges(ranks) if t[0].rows > small]:
        cuts = _column_cuts(df, wide)
        counts = _column_counts(df, [t[0] for t in wide], cuts)
        for t in wide:
            head = t[0].id
            for r in t:
                r.move(*cuts[head], *counts[head])
    ranges = _ranges(ranks)
    if ranges:
        _rank_columns(df, ranges)


# ------------------------------------------------------------------------------ groups

STATE = ["_ranks", "_below", "_rows", "_lower", "_upper"]  # of an open range, beside its keys


def _matched(values: DataFrame, by: list[str], table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows beside the ranges of their group, whose keys are ``_k0``, ``_k1``, ..."""
    few = table.count() <= BROADCAST_RANGES
    same = [values[c].eqNullSafe(table[f"_k{i}"]) for i, c in enumerate(by)]
    return values.join(F.broadcast(table) if few else table, same, how)


def _inside(values: DataFrame, by: list[str], table: DataFrame) -> DataFrame:
    joined = _matched(values, by, table)
    return joined.where(_between(F.col("_v"), F.col("_lower"), F.col("_upper")))


def _narrowed(values: DataFrame, by: list[str], wide: DataFrame) -> DataFrame:
    """Where each rank of the open ranges lies after one round of cuts: its value, or the
    range it is in."""
    keys = [f"_k{i}" for i in range(len(by))]
    state = [*keys, *STATE]
    salted = _inside(values, by, wide).select(*state, "_v", _partition_salt())
    parts = salted.groupBy(*state, "_salt").agg(F.kll_sketch_agg_double("_v", SKETCH_K).alias("_s"))
    sketches = parts.groupBy(*state).agg(F.kll_merge_agg_double("_s").alias("_s"))
    rows = F.col("_rows").cast("double")
    low = (F.array_min("_ranks") - F.col("_below")) / rows
    high = (F.array_max("_ranks") - F.col("_below") + 1) / rows
    lo, hi = _cuts(F.col("_s"), low, high)
    cuts = materialize(sketches.select(*state, lo.alias("_lo"), hi.alias("_hi")), "cuts")
    tallies = _tallies(F.col("_v"), F.col("_lo"), F.col("_hi"))
    counted = _inside(values, by, cuts).groupBy(*state, "_lo", "_hi")
    counted = counted.agg(*[c.alias(name) for name, c in tallies.items()])
    each = counted.withColumn("_rank", F.explode("_ranks"))
    at = F.col("_rank") - F.col("_below")
    under, on_lo, inside, on_hi = (F.col(c) for c in TALLIES)
    lo, hi = F.col("_lo"), F.col("_hi")
    part = (
        F.when(lo.isNotNull() & (at < under), 0)
        .when(lo.isNotNull() & (at < under + on_lo), 1)
        .when(at < under + on_lo + inside, 2)
        .when(at < under + on_lo + inside + on_hi, 3)
        .otherwise(4)
    )
    each = each.withColumn("_part", part)
    which, passed = F.col("_part"), under + on_lo + inside + on_hi
    first = F.when(lo.isNotNull(), under + on_lo).otherwise(F.lit(0))
    skipped = F.when(which == 2, first).when(which == 4, passed).otherwise(F.lit(0))
    size = F.when(which == 0, under).when(which == 2, inside).otherwise(F.col("_rows") - passed)
    lower = F.when(which == 2, F.coalesce(lo, "_lower")).when(which == 4, hi).otherwise(F.col("_lower"))
    upper = F.when(which == 0, lo).when(which == 2, F.coalesce(hi, "_upper")).otherwise(F.col("_upper"))
    return materialize(
        each.select(
            *keys,
            "_rank",
            F.when(which == 1, lo).when(which == 3, hi).alias("_value"),
            which.isin(1, 3).alias("_done"),
            (F.col("_below") + skipped).alias("_below"),
            size.alias("_rows"),
            lower.alias("_lower"),
            upper.alias("_upper"),
        ),
        "narrowed",
    )


def _rank_groups(values: DataFrame, by: list[str], ready: DataFrame) -> DataFrame:
    """Keys, ``_rank`` and ``_value`` of the ranks in ranges that are small."""
    keys = [f"_k{i}" for i in range(len(by))]
    state = [*keys, "_lower", "_below", "_ranks"]
    hits = _inside(values, by, ready)
    counted = hits.groupBy(*state, "_v").agg(F.count(F.lit(1)).alias("_n"))
    rows = ready.agg(F.sum("_rows")).first()[0] or 0
    placed = running_sum(counted, [*keys, "_lower"], ["_v"], rows, weight="_n")
    each = placed.withColumn("_rank", F.explode("_ranks"))
    found = each.where(_holds(F.col("_rank") - F.col("_below")))
    return found.select(*keys, "_rank", F.col("_v").alias("_value"))


def _large_groups(
    values: DataFrame, by: list[str], large: DataFrame, q: float, name: str, small: int
) -> DataFrame:
    """The quantile of each group of the table ``large`` (keys and ``_n``), as a frame."""
    keys = [f"_k{i}" for i in range(len(by))]
    position = F.lit(float(q)) * (F.col("_n") - 1)
    first = F.least(F.floor(position).cast("bigint"), F.col("_n") - 1)
    wanted = large.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)],
        "_n",
        first.alias("_first"),
        F.least(first + 1, F.col("_n") - 1).alias("_second"),
        (position - first).alias("_part"),
    )
    wanted = materialize(wanted, "wanted")
    none = F.lit(None).cast("double")
    open_ = wanted.select(
        *keys,
        F.array_distinct(F.array("_first", "_second")).alias("_ranks"),
        F.lit(0).cast("bigint").alias("_below"),
        F.col("_n").alias("_rows"),
        none.alias("_lower"),
        none.alias("_upper"),
    )
    found, ready = [], []
    while True:
        ready.append(open_.where(F.col("_rows") <= small))
        wide = open_.where(F.col("_rows") > small)
        if wide.isEmpty():
            break
        moved = _narrowed(values, by, wide)
        found.append(moved.where("_done").select(*keys, "_rank", "_value"))
        rest = moved.where(~F.col("_done")).groupBy(*keys, *STATE[1:])
        ranks = F.sort_array(F.collect_list("_rank")).alias("_ranks")  # one or two
        open_ = materialize(rest.agg(ranks).select(*keys, *STATE), "open")
    small_ranges = materialize(reduce(DataFrame.unionByName, ready), "ready")
    if not small_ranges.isEmpty():
        found.append(_rank_groups(values, by, small_ranges))
    values_found = materialize(reduce(DataFrame.unionByName, found), "found")
    named = values_found.toDF(*[f"_f{k}" for k in keys], "_rank", "_value")
    same = [wanted[k].eqNullSafe(named[f"_f{k}"]) for k in keys]
    rank = F.col("_rank")
    ends = (
        wanted.join(named, same)
        .groupBy(*keys, "_part")
        .agg(
            F.max(F.when(rank == F.col("_first"), F.col("_value"))).alias("_low"),
            F.max(F.when(rank == F.col("_second"), F.col("_value"))).alias("_high"),
        )
    )
    low, high, part = F.col("_low"), F.col("_high"), F.col("_part")
    value = F.when(low == high, low).otherwise((1 - part) * low + part * high)
    return ends.select(
        *[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], value.alias(name)
    )


# ------------------------------------------------------------------------------ results


def _pairs(sizes: dict, q: float) -> tuple[list[_Rank], dict]:
    """The two ranks on both sides of quantile ``q`` of each group, by group size."""
    ranks, pairs = [], {}
    for group, n in sizes.items():
        position = q * (n - 1)
        first = min(int(math.floor(position)), n - 1)
        low = _Rank(len(ranks), group, first, n)
        high = _Rank(len(ranks) + 1, group, min(first + 1, n - 1), n)
        ranks += [low, high]
        pairs[group] = (low, high, position - first)
    return ranks, pairs


def _interpolate(low: _Rank, high: _Rank, part: float) -> float:
    if low.value == high.value:
        return float(low.value)
    return (1 - part) * low.value + part * high.value


def nth_smallest(df: DataFrame, value: str, rank: int, rows: int, small=SMALL_GROUP):
    """The value at 0-based ``rank`` among the ``rows`` non-null values of a column, as a
    double: whole numbers are exact up to 2^53."""
    wanted = _Rank(0, value, rank, rows)
    _resolve(df, [wanted], small)
    return wanted.value


def column_statistics(
    df: DataFrame, columns, q: float, extra: dict, *, rows=None, small=SMALL_GROUP
) -> tuple[dict, dict]:
    """Quantile of each column over the whole table, and other aggregates of it.

    ``rows`` is an upper bound of the row count, when the caller knows one. A small table
    takes one aggregation; for a larger one a few scans follow, each serving all columns.
    """
    columns = list(columns)
    values = df.select(*columns)
    if rows is None:
        rows = values.count()
    others = [c.alias(name) for name, c in extra.items()]
    first = F.count if rows > small else lambda c: F.percentile(c, q)
    found = values.agg(*[first(c).alias(f"_c_{c}") for c in columns], *others).first()
    extras = {name: found[name] for name in extra}
    by_column = {c: found[f"_c_{c}"] for c in columns}
    if rows <= small:
        return by_column, extras
    ranks, pairs = _pairs({c: n for c, n in by_column.items() if n}, q)
    if ranks:
        _resolve(values, ranks, small)
    return {c: _interpolate(*pairs[c]) if c in pairs else None for c in columns}, extras


def column_quantiles(df: DataFrame, columns, q: float, *, rows=None, small=SMALL_GROUP) -> dict:
    """Quantile of each column over the whole table, as a dict of column to double."""
    return column_statistics(df, columns, q, {}, rows=rows, small=small)[0]


def exact_quantile(
    df: DataFrame,
    value: str,
    q: float,
    by=(),
    *,
    name: str = "quantile",
    rows: int | None = None,
    sizes: DataFrame | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Interpolated quantile of a double column per group; nulls are skipped.

    ``rows`` is an upper bound of the row count, and ``sizes`` the groups with their number
    ``_n`` of values, when the caller knows them. Otherwise they are counted. If no group can
    exceed ``small`` rows the result is a lazy aggregate; otherwise the large groups are
    resolved first, in a few narrow scans. ``df`` should be a stored table then, since it is
    read several times.
    """
    by = list(by)
    values = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if rows is None:
        rows = values.count()
    out = F.percentile("_v", q).alias(name)
    if not by:
        if rows <= small:
            return values.agg(out)
        found = column_quantiles(values, ["_v"], q, rows=rows, small=small)["_v"]
        return df.sparkSession.createDataFrame([(found,)], f"`{name}` double")
    if rows <= small:
        return values.groupBy(*by).agg(out)

    if sizes is None:
        sizes = values.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(sizes.select(*by, "_n").where(F.col("_n") > small), "large")
    if large.isEmpty():
        return values.groupBy(*by).agg(out)
    found = _large_groups(values, by, large, q, name, small)
    marks = large.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)])
    others = _matched(values, by, marks, "left_anti").groupBy(*by).agg(out)
    return others.unionByName(found)
