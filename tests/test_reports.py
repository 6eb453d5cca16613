from datetime import date, datetime

import pytest
from frames import column, numbered, scored

from txrisk import schema as S
from txrisk.operators import aggregates as A
from txrisk.operators import filters as L
from txrisk.operators import summary as Y
from txrisk.plans import reports as R
from txrisk.plans.risk import run_risk
from txrisk.sources.transactions import load_table, write_transactions


def with_flags(df):
    return df.selectExpr("*", f"{S.LABEL} as is_anomaly", "-transaction_amount as anomaly_score")


@pytest.fixture(scope="module")
def rows(spark):
    return numbered(
        spark,
        {"transaction_amount": 1000.0, "transaction_date": datetime(2026, 1, 31, 23, 59, 59)},
        {"transaction_amount": 999.99, "state": "NY", "is_international": 1, S.LABEL: 1},
        {"transaction_amount": 5000.0, "transaction_date": datetime(2026, 4, 2), "is_weekend": 1},
        {"transaction_amount": 0.01, "state": None, "merchant_category": "Travel"},
        {"transaction_amount": 5000.0, "state": "NY", "customer_id": "C2", S.LABEL: 1},
    )


def test_reports(spark, rows):
    load_table(with_flags(rows))
    got = {name: df.collect() for name, df in R.run_all_reports(spark).items()}
    assert list(got) == list(R.REPORTS)
    # months without rows do not appear here
    assert [r["month"] for r in got["monthly_transaction_value"]] == ["2026-01", "2026-04"]
    assert got["monthly_transaction_value"][0]["total_value"] == 7000.0
    assert got["monthly_transaction_value"][0]["avg_value"] == 1750.0
    # a missing state is a group of its own in SQL
    assert [r["state"] for r in got["value_by_state"]] == ["MA", "NY", None]
    assert [r["transaction_id"] for r in got["high_value_transactions"]] == ["T2", "T4", "T0"]
    assert got["anomaly_rate_by_category"][0]["flagged_rate_pct"] == 50.0
    assert [r["customer_id"] for r in got["top_customers_by_value"]] == ["C1", "C2"]
    assert {r["day_type"] for r in got["weekend_vs_weekday"]} == {"Weekend", "Weekday"}
    sizes = column(R.report_sizes(R.run_all_reports(spark)), "row_count", "report")
    assert sizes == {name: len(r) for name, r in got.items()}


def test_reports_without_flags(spark, rows):
    load_table(rows)
    assert set(R.REPORTS) - set(R.run_all_reports(spark)) == {"anomaly_rate_by_category"}
    assert R.run_query(spark, "SELECT count(*) FROM transactions").first()[0] == 5


def test_catalog(spark):
    got = R.report_catalog(spark).collect()
    assert [r["report"] for r in got] == list(R.REPORTS)
    assert all(r["title"] and "transactions" in r["sql"] for r in got)


def test_top_ten_has_a_fixed_order(spark):
    rows = numbered(spark, *[{"customer_id": f"C{i:02d}"} for i in range(30)])
    load_table(rows.repartition(7))
    got = [r["customer_id"] for r in R.run_report(spark, "top_customers_by_value").collect()]
    assert got == [f"C{i:02d}" for i in range(10)]


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_filters(rows):
    df = with_flags(rows)
    keep = L.filter_transactions
    assert ids(keep(df)) == ["T0", "T1", "T2", "T3", "T4"]
    assert ids(keep(df, start=date(2026, 1, 31), end=date(2026, 4, 2))) == ["T0", "T2"]
    assert ids(keep(df, start="2026-04-02", end="2026-04-02")) == ["T2"]
    assert len(ids(keep(df, start="2026-04-02"))) == 5  # half a range is no range
    assert ids(keep(df, states=["NY"], international=False)) == ["T4"]
    assert ids(keep(df, flagged=True)) == ["T1", "T4"]
    assert ids(keep(df, categories=[])) == []
    assert L.has_rows(df) and not L.has_rows(keep(df, card_types=[]))


def test_filters_reach_the_scan(spark, rows, tmp_path, capsys):
    path = str(tmp_path / "table")
    table = load_table(with_flags(rows), path=path)
    found = L.filter_transactions(table, start="2026-04-01", end="2026-04-30", states=["MA"])
    assert ids(found) == ["T2"]
    found.select("transaction_amount").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "In(state, [MA])" in plan or "EqualTo(state,MA)" in plan
    assert "GreaterThanOrEqual(transaction_date" in plan
    assert "customer_id" not in plan.split("ReadSchema")[1]


def test_domains(rows):
    got = [tuple(r) for r in L.value_domains(rows).collect()]
    assert ("state", "MA") in got and ("state", "NY") in got
    assert all(v is not None for _, v in got) and got == sorted(got)
    assert tuple(L.date_domain(rows).first()) == (date(2026, 1, 5), date(2026, 4, 2))


def test_monthly_gaps_are_filled(rows):
    got = [tuple(r) for r in A.monthly_resample(rows).collect()]
    assert got == [
        (date(2026, 1, 1), 4, 7000.0),
        (date(2026, 2, 1), 0, 0.0),
        (date(2026, 3, 1), 0, 0.0),
        (date(2026, 4, 1), 1, 5000.0),
    ]
    assert A.monthly_resample(rows.limit(0)).count() == 0


def test_missing_keys_have_no_group(rows):
    assert [tuple(r) for r in A.state_count(rows).collect()] == [("MA", 2), ("NY", 2)]
    assert [tuple(r) for r in A.state_value(rows).collect()] == [("MA", 6000.0), ("NY", 5999.99)]
    assert A.category_spend(rows).first()["transaction_amount"] == 11999.99
    assert A.category_count(rows).first()["transaction_count"] == 4


def test_shares(rows):
    got = column(A.international_share(rows), "share", "txn_type")
    assert got == {"Domestic": 0.8, "International": 0.2}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 9.99, 10)] + [(None,)], "v double")
    got = A.histogram(df, "v", 5).collect()
    assert [r["transaction_count"] for r in got] == [2, 0, 1, 0, 2]
    assert (got[0]["bin_start"], got[-1]["bin_end"]) == (0.0, 10.0)
    single = A.histogram(df.where("v = 5"), "v", 5).collect()
    assert [tuple(r) for r in single] == [(0, 5.0, 5.0, 1)]
    assert A.histogram(df.where("v > 99"), "v", 5).count() == 0


def test_score_histogram_shares_edges(spark):
    df = scored(spark, (1.0, -1.0, 1), (1.0, 0.0, 0), (1.0, 1.0, 0), (1.0, 0.5, 7))
    got = A.score_histogram(df, bins=2).collect()
    assert [tuple(r) for r in got] == [
        ("Flagged", 0, -1.0, 0.0, 1),
        ("Flagged", 1, 0.0, 1.0, 0),
        ("Normal", 0, -1.0, 0.0, 0),
        ("Normal", 1, 0.0, 1.0, 2),
    ]
    empty = A.score_histogram(df.limit(0))
    assert empty.count() == 0 and set(empty.columns) == set(A.score_histogram(df).columns)


def test_flagged_table(rows):
    df = with_flags(rows)
    assert [r["transaction_id"] for r in A.flagged_table(df).collect()] == ["T4", "T1"]
    assert A.flagged_table(df, limit=1).count() == 1
    assert A.high_value_count(df).first()[0] == 3
    assert sum(r["transaction_count"] for r in A.amount_histogram(df).collect()) == 3


def test_anomaly_summary(spark):
    got = Y.anomaly_summary(scored(spark, (10.0, 0.2, 0), (30.01, -0.1, 1), (20.0, 0.3, 0))).first()
    assert tuple(got) == (3, 1, 33.333, 0.1333, 15.0, 30.01)


def test_anomaly_summary_edges(spark):
    none = Y.anomaly_summary(scored(spark, (10.0, 0.2, 0))).first()
    assert (none["anomaly_count"], none["avg_amount_anomaly"]) == (0, 0.0)
    every = Y.anomaly_summary(scored(spark, (10.0, -0.2, 1))).first()
    assert every["avg_amount_normal"] is None and every["anomaly_rate_pct"] == 100.0
    empty = Y.anomaly_summary(scored(spark, (10.0, -0.2, 1)).limit(0)).first()
    assert (empty["total_transactions"], empty["anomaly_rate_pct"]) == (0, 0.0)
    assert (empty["avg_amount_anomaly"], empty["avg_amount_normal"]) == (0.0, None)


def test_kpis(rows):
    got = Y.kpi_cards(with_flags(rows)).first()
    assert tuple(got) == (5, 12000.0, 2400.0, 40.0)


def test_whole_run(spark, tmp_path, rows):
    from txrisk import read_transactions

    path = str(tmp_path / "csv")
    write_transactions(rows, path, "csv")
    run = run_risk(read_transactions(spark, path), path=str(tmp_path / "t"), trees=5)
    assert run.quality.first()["total_records_after_cleaning"] == run.scored.count() == 5
    assert run.reports["anomaly_rate_by_category"].count() == 2
    assert set(run.reports) == set(R.REPORTS)
