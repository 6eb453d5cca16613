import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txrisk.operators import quantiles as Q
from txrisk.operators import ranges as R

SHAPES = {
    "even": lambda r, n: r.random(n),
    "heavy tail": lambda r, n: np.exp(r.normal(0, 40, n)),
    "one hot value": lambda r, n: np.where(r.random(n) < 0.4, 7.25, r.normal(0, 100, n)),
    "two hot values": lambda r, n: np.where(r.random(n) < 0.9, r.integers(0, 2, n), r.random(n)),
    "constant": lambda r, n: np.full(n, -3.5),
    "mixed sign": lambda r, n: r.normal(0, 1, n).round(1),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("q", [0.0, 0.02, 0.5, 1.0])
def test_large_path_equals_numpy(spark, shape, q, monkeypatch):
    monkeypatch.setattr(Q, "SKETCH_K", 64)  # rough sketches, so that cuts miss too
    values = SHAPES[shape](np.random.default_rng(5), 3001)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = Q.exact_quantile(df, "v", q, small=20).first()[0]
    assert got == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert Q.exact_quantile(df, "v", q).first()[0] == got


@pytest.mark.parametrize("ranges, part_rows", [(100_000, 1_000_000), (2, 60)])
def test_groups_of_all_sizes(spark, monkeypatch, ranges, part_rows):
    """Also with more large groups than are broadcast, and more rows left than a task sorts."""
    monkeypatch.setattr(Q, "SKETCH_K", 64)
    monkeypatch.setattr(Q, "BROADCAST_RANGES", ranges)
    monkeypatch.setattr(R, "PART_ROWS", part_rows)
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 1)  # one group holds a third of the rows
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 17)
        .alias("g"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 1009) / 8.0).alias("v"),
    )
    small = {r["g"]: r["quantile"] for r in Q.exact_quantile(df, "v", 0.5, ["g"]).collect()}
    large = {
        r["g"]: r["quantile"] for r in Q.exact_quantile(df, "v", 0.5, ["g"], small=100).collect()
    }
    table = df.toPandas()
    con = duckdb.connect()
    con.register("t", table)
    expected = dict(
        con.execute("SELECT g, median(v) FROM t WHERE v IS NOT NULL GROUP BY g").fetchall()
    )
    expected = {None if g is None or g != g else int(g): m for g, m in expected.items()}
    assert small == expected and large == expected


def test_column_quantiles_agree(spark):
    df = spark.range(5000).select(
        (F.col("id") * 37 % 1013).alias("a"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 3).alias("b"),
        F.lit(None).cast("double").alias("c"),
    )
    small = Q.column_quantiles(df, ["a", "b", "c"], 0.5)
    assert Q.column_quantiles(df, ["a", "b", "c"], 0.5, small=50) == small
    assert small["c"] is None


def test_nth_smallest(spark):
    df = spark.range(1000).select((F.col("id") * 617 % 1000).alias("v"))
    for rank in (0, 1, 499, 999):
        assert Q.nth_smallest(df, "v", rank, 1000) == rank
        assert Q.nth_smallest(df, "v", rank, 1000, small=10) == rank


def test_no_task_sorts_more_than_its_share(spark):
    """A third of the rows in one group: its rows lie in several parts, and count on."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("g"),
        (F.col("id") * 7919 % 6007).alias("v"),
        (F.col("id") % 5).alias("w"),
    )
    got = R.running_sum(df, ["g"], ["v"], 6000, weight="w", part_rows=300)
    largest = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 1500
    expected = {}
    for r in sorted(df.collect(), key=lambda r: r.v):
        upto = expected.get((r.g, None), 0) + r.w
        expected[r.g, None] = expected[r.g, r.v] = upto
    found = {(r.g, r.v): r["_upto"] for r in got.collect()}
    assert found == {k: n for k, n in expected.items() if k[1] is not None}
    parts = df.repartitionByRange(20, "g", "v").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] < 1000


def test_equal_rows_are_split_too(spark):
    rows = spark.range(5000).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    got = R.with_first(rows, 1234, 5000, "picked", part_rows=400)
    assert got.where("picked").count() == 1234 and got.count() == 5000
    assert R.with_first(rows, 0, 5000, "p").where("p").isEmpty()
    assert R.with_first(rows, 5000, 5000, "p").where("p").count() == 5000


def test_many_large_groups_narrow_in_a_table(spark, monkeypatch):
    monkeypatch.setattr(Q, "BROADCAST_RANGES", 0)
    monkeypatch.setattr(Q, "SKETCH_K", 32)
    df = spark.range(12_000).select(
        (F.col("id") % 150).alias("a"),
        F.when(F.col("id") % 2 == 0, "x").alias("b"),
        (F.xxhash64("id") % 997 / 16).alias("v"),
    )
    for q in (0.0, 0.37, 1.0):
        got = Q.exact_quantile(df, "v", q, ["a", "b"], small=20).collect()
        expected = Q.exact_quantile(df, "v", q, ["a", "b"]).collect()
        rounded = [sorted((r.a, r.b or "", round(r["quantile"], 9)) for r in x) for x in (got, expected)]
        assert rounded[0] == rounded[1] and len(got) == 150


def test_no_rows(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert Q.exact_quantile(df, "v", 0.5).first()[0] is None
    assert Q.exact_quantile(df, "v", 0.5, ["g"]).count() == 0
    nulls = spark.createDataFrame([(None,)], "v double")
    assert Q.exact_quantile(nulls, "v", 0.5, rows=10, small=1).first()[0] is None


def test_a_cut_that_misses_the_rank_is_put_right():
    rank = Q._Rank(0, "v", rank=10, rows=100)
    rank.move(5.0, 6.0, 40, 1, 3, 1)  # rank lies under the lower cut
    assert (rank.lower, rank.upper, rank.rows, rank.below) == (None, 5.0, 40, 0)
    rank.move(1.0, 2.0, 1, 1, 3, 1)  # rank lies over the upper cut
    assert (rank.lower, rank.upper, rank.rows, rank.below) == (2.0, 5.0, 34, 6)


def tally(values, lo, hi):
    under = sum(1 for v in values if lo is not None and v < lo)
    on_lo = sum(1 for v in values if lo is not None and v == lo)
    inside = sum((lo is None or v > lo) and (hi is None or v < hi) for v in values)
    on_hi = sum(1 for v in values if hi is not None and v == hi and (lo is None or lo < hi))
    return under, on_lo, inside, on_hi


@given(
    st.lists(st.integers(0, 20), min_size=1, max_size=60),
    st.data(),
)
def test_any_cuts_keep_the_rank(values, data):
    ordered = sorted(values)
    rank = Q._Rank(0, "v", data.draw(st.integers(0, len(values) - 1)), len(values))
    for _ in range(6):
        inside = [
            v
            for v in ordered
            if (rank.lower is None or v > rank.lower) and (rank.upper is None or v < rank.upper)
        ]
        assert rank.rows == len(inside)
        assert rank.below == sum(rank.lower is not None and v <= rank.lower for v in ordered)
        assert inside[rank.rank - rank.below] == ordered[rank.rank]
        # any two points between the cuts, right or wrong, or none on a side
        lo, hi = sorted([data.draw(st.sampled_from(inside)) for _ in range(2)])
        lo = None if data.draw(st.booleans()) else lo
        hi = None if data.draw(st.booleans()) else hi
        rank.move(lo, hi, *tally(inside, lo, hi))
        if rank.done:
            assert rank.value == ordered[rank.rank]
            break
