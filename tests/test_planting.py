import pytest
from frames import numbered
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators import planting as P
from txrisk.operators import ranges as R
from txrisk.operators.forest import detect_anomalies
from txrisk.operators.quality import profile_and_clean
from txrisk.operators.sampling import sample_exact, sample_share
from txrisk.operators.summary import anomaly_summary, planted_recall
from txrisk.sources.stages import materialize

N = 4000


@pytest.fixture(scope="module")
def rows(spark):
    base = numbered(spark, {}).drop("transaction_id")
    keys = spark.range(N).select(F.concat(F.lit("K"), "id").alias("transaction_id"))
    return keys.join(F.broadcast(base)).select(
        "transaction_id", *[c for c in base.columns if c != "transaction_id"]
    )


def near(count, share):
    return abs(count - N * share) < 5 * (N * share * (1 - share)) ** 0.5 + 1


def test_outliers(rows):
    got = P.plant_outliers(rows, exact=False)
    planted = got.where(f"{S.LABEL} = 1")
    assert near(planted.count(), P.OUTLIER_SHARE) and got.count() == N
    low = planted.agg(
        F.min("transaction_amount"), F.max("transaction_amount"),
        F.min("transaction_hour"), F.max("transaction_hour"),
        F.min("distance_from_home_km"), F.max("distance_from_home_km"),
        F.min("is_international"),
    ).first()
    assert 1500 <= low[0] and low[1] <= 9000 and (low[2], low[3]) == (1, 4)
    assert 2000 <= low[4] and low[5] <= 12000 and low[6] == 1
    same = ["previous_transaction_amount", "customer_income", "city"]
    assert planted.select(same).distinct().count() == 1
    rest = got.where(f"{S.LABEL} = 0").drop("transaction_id").distinct()
    assert rest.count() == 1 and rest.first()["transaction_amount"] == 10.0


def test_defects(rows):
    got = P.plant_defects(rows, exact=False)
    assert near(got.where("city is null").count(), P.MISSING_SHARE)
    assert near(got.where("customer_income is null").count(), P.MISSING_SHARE)
    assert near(got.where("transaction_amount = -10").count(), P.INVALID_SHARE)
    assert got.where("city is null and customer_income is null").count() < 8


def test_same_rows_under_any_partitioning(rows):
    first = sorted(P.plant_all(rows, exact=False).collect())
    assert sorted(P.plant_all(rows.repartition(11), exact=False).collect()) == first
    assert near(len(first) - N, P.DUPLICATE_SHARE)


@pytest.mark.parametrize("small", [1_000_000, 50])
def test_exact_sample(rows, small):
    got = sample_exact(rows, 0.0123, small=small)
    assert got.count() == got.distinct().count() == 49
    assert got.columns == rows.columns
    usual = sample_exact(rows.repartition(9), 0.0123)
    assert sorted(got.collect()) == sorted(usual.collect())
    assert sample_exact(rows, 0.0).count() == 0 and sample_exact(rows, 1.0).count() == N


def test_exact_sample_of_rows_that_share_a_key(rows):
    shared = rows.withColumns(
        {"city": F.col("transaction_id"), "transaction_id": F.lit("one key")}
    )
    got = sample_exact(shared, 0.01)
    assert got.count() == 40
    assert sorted(got.collect()) == sorted(sample_exact(shared.repartition(5), 0.01).collect())


@pytest.mark.parametrize("part_rows", [1_000_000, 200])
def test_a_third_of_the_rows_on_one_key(spark, monkeypatch, part_rows):
    monkeypatch.setattr(R, "PART_ROWS", part_rows)
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id")).alias("x"),  # half of them equal
    )
    for share in (0.05, 0.3, 0.62, 0.9):
        got = sorted(sample_exact(rows, share, key="k", small=50).collect())
        assert len(got) == int(3000 * share)
        again = sample_exact(rows.repartition(7, "x"), share, key="k").collect()
        assert got == sorted(again)


def test_planting_is_exact_when_keys_repeat(rows):
    shared = rows.withColumn("state", (F.length("transaction_id") % 3).cast("string"))
    assert P.plant_outliers(shared, key="state").where(f"{S.LABEL} = 1").count() == 80
    defects = P.plant_defects(shared, key="state")
    assert defects.where("city is null").count() == 40
    assert defects.where("customer_income is null").count() == 40
    assert defects.where("transaction_amount < 0").count() == 12
    assert defects.columns == shared.columns and defects.count() == N
    assert P.plant_duplicates(shared, key="state").count() == N + 20


def test_share_sample(rows):
    assert near(sample_share(rows, 0.1).count(), 0.1)


def test_exact_planting(rows):
    counted = {}
    for name, df in (("soft", P.plant_all(rows, exact=False)), ("exact", P.plant_all(rows))):
        counted[name] = (
            df.count() - N,
            df.where(f"{S.LABEL} = 1").select("transaction_id").distinct().count(),
        )
    assert counted["exact"] == (20, 80) and counted["soft"] != counted["exact"]


def test_known_counts_of_a_whole_run(spark):
    """20,000 rows with planted outliers, defects and copies: what a run must find."""
    spread = {
        "transaction_amount": F.round(F.lit(20.0) + F.col("id") * 7919 % 30011 / 100, 2),
        "transaction_hour": 8 + F.col("id") * 31 % 15,
        "distance_from_home_km": (F.col("id") * 617 % 4001) / 100,
        "previous_transaction_amount": F.round(20.0 + F.col("id") * 104729 % 30011 / 100, 2),
        "customer_income": 30000.0 + F.col("id") * 48611 % 60013,
        "customer_age": 18 + F.col("id") * 13 % 57,
        "transaction_id": F.concat(F.lit("TXN"), F.lpad(F.col("id").cast("string"), 7, "0")),
    }
    base = spark.range(20000).join(F.broadcast(numbered(spark, {}))).withColumns(spread).drop("id")
    raw = materialize(P.plant_all(materialize(base), exact=True), "raw")
    report, cleaned = profile_and_clean(raw)
    found = report.first()
    assert found["total_records"] == 20100
    assert found["duplicate_rows"] == 100
    assert found["total_columns"] == 18
    assert raw.select("transaction_id").distinct().count() == 20000
    assert found["total_records_after_cleaning"] == 19940
    assert found["records_removed"] == 160
    assert 400 <= found["total_missing_cells"] <= 420
    assert 60 <= found["invalid_amount_count"] <= 63
    scored = detect_anomalies(cleaned)
    result = anomaly_summary(scored).first()
    assert result["anomaly_count"] == 399 and result["anomaly_rate_pct"] == 2.001
    caught, planted = planted_recall(scored).first()
    assert planted >= 390 and caught / planted > 0.9
