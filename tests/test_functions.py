from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txrisk.functions import hashing as H
from txrisk.functions import money as M
from txrisk.functions import scalars as X


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v")).alias("out")).collect()]


def test_nan_becomes_null(spark):
    assert one(spark, [float("nan"), 1.0, None], "double", X.nan_to_null) == [None, 1.0, None]


def test_missing_words(spark):
    got = one(spark, ["", "NA", "nan", "None", "Nantes", "na"], "string", X.na_to_null)
    assert got == [None, None, None, None, "Nantes", "na"]


def test_clip_keeps_null(spark):
    got = one(spark, [5, 50, 500, None], "bigint", lambda c: X.clip(c, 18, 100))
    assert got == [18, 50, 100, None]
    assert one(spark, [5, 500], "bigint", lambda c: X.clip(c, lower=18)) == [18, 500]


def test_bracket_rounds_down(spark):
    got = one(spark, [-5, 0, 9, 10, 39, None], "bigint", lambda c: X.bracket(c, 10))
    assert got == [-10, 0, 0, 10, 30, None]


def test_dates(spark):
    stamps = [datetime(2026, 2, 7, 0, 0), datetime(2026, 2, 9, 23, 59, 59), None]
    kind = "timestamp_ntz"
    assert one(spark, stamps, kind, X.iso_text) == [
        "2026-02-07 00:00:00",
        "2026-02-09 23:59:59",
        None,
    ]
    assert one(spark, stamps, kind, X.month_text) == ["2026-02", "2026-02", None]
    assert one(spark, stamps, kind, X.weekend_flag) == [1, 0, None]
    assert str(one(spark, stamps, kind, X.month_start)[1]) == "2026-02-01"


def test_key_text(spark):
    got = one(spark, [7, 12345678], "bigint", lambda c: X.key_text("TXN", c, 7))
    assert got == ["TXN0000007", "TXN12345678"]


def test_value_map_and_labels(spark):
    assert one(spark, [0, 1, 2, None], "bigint", X.status_label) == [
        "Normal",
        "Flagged",
        None,
        None,
    ]
    assert one(spark, [0, 1, None], "bigint", X.weekend_label) == ["Weekday", "Weekend", "Weekday"]
    assert one(spark, [1, None], "bigint", X.international_label) == ["International", "Domestic"]


def test_money_is_exact_and_half_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,), (None,)] + [(0.1,)] * 10, "v double")
    row = df.agg(M.total("v"), M.mean("v")).first()
    assert row[0] == 1.03
    assert row[1] == 0.09  # 1.03 / 12
    # 0.005 rounds away from zero, on both sides
    for values, expected in (([0.0, 0.01], 0.01), ([0.0, -0.01], -0.01)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert df.agg(M.mean("v")).first()[0] == expected


def test_amounts_finer_than_a_cent(spark):
    df = spark.createDataFrame([(0.004,)] * 1000, "transaction_amount double")
    assert tuple(df.agg(M.total("transaction_amount"), M.mean("transaction_amount")).first()) == (4.0, 0.0)
    df.createOrReplaceTempView("fine")
    assert tuple(spark.sql(f"SELECT {M.SQL_TOTAL}, {M.SQL_MEAN} FROM fine").first()) == (4.0, 0.0)


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2), (1, 800)], "a bigint, b bigint")
    got = [r[0] for r in df.select(M.percentage(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [33.33, 0.0, 100.0, 0.13]  # 0.125 rounds up


def test_hash_words_are_uniform_and_repeatable(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    share = 0.05
    picked = df.where(H.chosen(F.col("k"), 1, share))
    n = picked.count()
    assert abs(n - 1000) < 5 * (20000 * share * (1 - share)) ** 0.5
    again = df.repartition(13).where(H.chosen(F.col("k"), 1, share))
    assert sorted(r[0] for r in picked.collect()) == sorted(r[0] for r in again.collect())
    other = df.where(H.chosen(F.col("k"), 2, share)).intersect(picked).count()
    assert other < 150  # another seed makes another pick
    words = df.select(H.word(H.digest(F.col("k"), 1), 1).alias("w")).agg(F.min("w"), F.max("w"))
    low, high = words.first()
    assert 0 <= low and high < H.SPAN


@pytest.mark.parametrize("share,bound", [(0, 0), (1, H.SPAN), (2, H.SPAN), (0.5, H.SPAN // 2)])
def test_share_bound(share, bound):
    assert H.share_bound(share) == bound


def test_row_keys_tell_missing_values_apart(spark):
    rows = [("a", None), (None, "a"), ("", "a"), ("a", ""), (None, None), ("1:a", None), ("a-", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = df.select(H.row_key(["x", "y"]), H.key_of(df, ["x", "y"]), H.key_of(df)).collect()
    assert all(len({r[i] for r in keys}) == len(rows) for i in range(3))
    single = df.select(H.key_of(df, "x")).distinct()
    assert single.count() == 5 and single.where(F.col(single.columns[0]).isNull()).isEmpty()
