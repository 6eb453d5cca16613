import pytest
from frames import column, numbered, transactions
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators import cleaning as C
from txrisk.operators import quality as Q
from txrisk.operators import quantiles


def test_duplicates_missing_equals_missing(spark):
    df = transactions(spark, {"city": None}, {"city": None}, {"city": "x"}, {})
    assert C.drop_duplicates(df).count() == 3


def test_duplicates_ignore_the_label_and_keep_one(spark):
    df = transactions(spark, {S.LABEL: 1}, {S.LABEL: 0}, {S.LABEL: None})
    assert [r[S.LABEL] for r in C.drop_duplicates(df).collect()] == [0]


def test_duplicates_first_by_order(spark):
    df = transactions(spark, {S.LABEL: 0}, {S.LABEL: 1}).withColumn("at", 5 - F.col(S.LABEL))
    row = C.drop_duplicates(df, order_by="at").first()
    assert (row[S.LABEL], row["at"]) == (1, 4)
    both = C.drop_duplicates(df).first()  # several extras come from one copy
    assert (both[S.LABEL], both["at"]) in {(0, 5), (1, 4)}


def test_duplicate_key_uses_columns_present(spark):
    df = transactions(spark, {"city": "a"}, {"city": "b"}).drop("city")
    assert C.drop_duplicates(df).count() == 1


def test_positive_amounts_only(spark):
    amounts = [5.0, 0.0, -1.0, None]
    df = numbered(spark, *[{"transaction_amount": a} for a in amounts])
    assert [r["transaction_amount"] for r in C.keep_positive(df).collect()] == [5.0]


def test_income_by_bracket_of_the_unclipped_age(spark):
    df = numbered(
        spark,
        {"customer_age": 31, "customer_income": 100.0},
        {"customer_age": 39, "customer_income": 200.0},
        {"customer_age": 30, "customer_income": None},
        # 12 and 18 would share a value after clipping, but not a bracket
        {"customer_age": 2, "customer_income": 10.0},
        {"customer_age": 18, "customer_income": 30.0},
        {"customer_age": 12, "customer_income": None},
        {"customer_age": 5, "customer_income": None},
    )
    got = column(C.clean(df), "customer_income")
    assert (got["T2"], got["T5"], got["T6"]) == (150.0, 30.0, 10.0)


def test_income_fallback_is_the_median_after_the_first_fill(spark):
    df = numbered(
        spark,
        {"customer_age": 25, "customer_income": 10.0},
        {"customer_age": 25, "customer_income": None},
        {"customer_age": 26, "customer_income": None},
        {"customer_age": 45, "customer_income": 40.0},
        {"customer_age": 55, "customer_income": None},  # bracket without any income
        {"customer_age": None, "customer_income": None},  # no bracket
    )
    got = column(C.impute_income(df), "customer_income")
    # known after the first fill: 10, 10, 10, 40
    assert got["T4"] == got["T5"] == 10.0
    assert got["T1"] == got["T2"] == 10.0


def test_income_all_missing_stays_missing(spark):
    df = numbered(spark, {"customer_income": None}, {"customer_income": None})
    assert set(column(C.impute_income(df), "customer_income").values()) == {None}


@pytest.mark.parametrize("few", [0, 10_000])
def test_income_small_and_large_paths_agree(spark, few, monkeypatch):
    rows = [
        {"customer_age": 20 + i % 40, "customer_income": None if i % 7 == 0 else float(i * i % 911)}
        for i in range(300)
    ]
    df = numbered(spark, *rows)
    expected = column(C.impute_income(df), "customer_income")
    monkeypatch.setattr(quantiles, "BROADCAST_RANGES", few)
    assert column(C.impute_income(df, small=5), "customer_income") == expected


def test_missing_flag_raises_or_passes(spark):
    df = numbered(spark, {"is_weekend": None})
    with pytest.raises(ValueError, match="is_weekend"):
        C.clean(df)
    assert C.clean(df, lenient=True).first()["is_weekend"] is None


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="customer_age"):
        C.clean(numbered(spark, {}).drop("customer_age"))


def test_empty_input(spark):
    empty = numbered(spark, {}).limit(0)
    assert C.clean(empty).count() == 0
    report = Q.profile(empty).first()
    assert report["total_records"] == 0 and report["missing_pct"] == 0.0
    assert report["is_valid_overall"] is True
    assert Q.missing_by_column(empty).count() == 0


def test_profile_and_clean(spark):
    df = transactions(
        spark,
        {},
        {},
        {"transaction_id": "T2", "transaction_amount": -4.0},
        {"transaction_id": "T3", "transaction_amount": None, S.LABEL: None},
        {"transaction_id": "T4", "customer_age": 101, "city": None},
        {"transaction_id": "T5", "customer_age": None},
    )
    report, cleaned = Q.profile_and_clean(df)
    got = report.first().asDict()
    assert got == {
        "total_records": 6,
        "total_columns": 18,
        "total_missing_cells": 4,
        "duplicate_rows": 1,
        "invalid_amount_count": 1,  # a missing amount is not counted, but is removed
        "invalid_age_count": 1,
        "missing_pct": round(400 / 108, 3),
        "is_valid_overall": False,
        "total_records_after_cleaning": 3,
        "records_removed": 3,
    }
    assert Q.profile(df).first().asDict().items() <= got.items()
    missing = {r["column"]: r["missing_count"] for r in Q.missing_by_column(df).collect()}
    assert missing == {"transaction_amount": 1, "city": 1, "customer_age": 1, S.LABEL: 1}
    ages = column(cleaned, "customer_age")
    assert ages == {"T1": 34, "T4": 100, "T5": None}
    assert column(cleaned, "city")["T4"] == "Unknown"
    assert Q.profile(cleaned.where("customer_age is not null")).first()["is_valid_overall"] is True
    actions = {r["action"]: r["row_count"] for r in Q.cleaning_actions(report).collect()}
    assert actions["total_records_removed"] == 3 and actions["duplicate_rows_removed"] == 1


def test_clean_is_the_same_under_any_partitioning(spark):
    rows = [{"customer_age": 20 + i % 50, "customer_income": None if i % 5 else i * 1.0} for i in range(200)]
    df = numbered(spark, *rows)
    one = sorted(C.clean(df.repartition(1)).collect())
    assert sorted(C.clean(df.repartition(16)).collect()) == one
