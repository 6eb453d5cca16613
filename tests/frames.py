"""Small hand-made transactions."""

from datetime import datetime

from txrisk import schema as S

SCHEMA = ", ".join(f"{c} {t.simpleString()}" for c, t in S.COLUMN_TYPES.items())
LABELLED = f"{SCHEMA}, {S.LABEL} bigint"

DEFAULTS = {
    "transaction_id": "T1",
    "transaction_date": datetime(2026, 1, 5, 10, 30),
    "customer_id": "C1",
    "merchant_id": "M1",
    "merchant_category": "Fuel",
    "transaction_amount": 10.0,
    "city": "Boston",
    "state": "MA",
    "payment_method": "Chip",
    "card_type": "Gold",
    "customer_age": 34,
    "customer_income": 50000.0,
    "transaction_hour": 10,
    "is_international": 0,
    "is_weekend": 0,
    "previous_transaction_amount": 9.5,
    "distance_from_home_km": 3.0,
    S.LABEL: 0,
}


def row(**changes):
    unknown = set(changes) - set(DEFAULTS)
    assert not unknown, unknown
    return tuple({**DEFAULTS, **changes}.values())


def transactions(spark, *changes):
    """One row per dict of changes to the default row."""
    return spark.createDataFrame([row(**c) for c in changes], LABELLED)


def numbered(spark, *changes):
    return transactions(
        spark, *[{"transaction_id": f"T{i}", **c} for i, c in enumerate(changes)]
    )


def scored(spark, *rows):
    """Rows as (amount, score, flag)."""
    schema = "transaction_amount double, anomaly_score double, is_anomaly bigint"
    return spark.createDataFrame(list(rows), schema)


def column(df, name, key="transaction_id"):
    return {r[key]: r[name] for r in df.collect()}
