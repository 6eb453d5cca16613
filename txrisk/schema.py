"""Column names, types and fixed settings of the transactions data model."""

from pyspark.sql import types as T

# The data model's columns in file order.
COLUMN_TYPES = {
    "transaction_id": T.StringType(),
    "transaction_date": T.TimestampNTZType(),
    "customer_id": T.StringType(),
    "merchant_id": T.StringType(),
    "merchant_category": T.StringType(),
    "transaction_amount": T.DoubleType(),
    "city": T.StringType(),
    "state": T.StringType(),
    "payment_method": T.StringType(),
    "card_type": T.StringType(),
    "customer_age": T.LongType(),
    "customer_income": T.DoubleType(),
    "transaction_hour": T.LongType(),
    "is_international": T.LongType(),
    "is_weekend": T.LongType(),
    "previous_transaction_amount": T.DoubleType(),
    "distance_from_home_km": T.DoubleType(),
}
LABEL = "ground_truth_unusual"
OPTIONAL_TYPES = {
    LABEL: T.LongType(),
    "anomaly_score": T.DoubleType(),
    "is_anomaly": T.LongType(),
}

REQUIRED = list(COLUMN_TYPES)
SCHEMA = T.StructType([T.StructField(c, t) for c, t in COLUMN_TYPES.items()])

# The six model inputs, the flagged share, seed and forest size.
FEATURES = [
    "transaction_amount",
    "transaction_hour",
    "distance_from_home_km",
    "previous_transaction_amount",
    "customer_income",
    "is_international",
]
CONTAMINATION = 0.02
SEED = 42
N_TREES = 200
SAMPLE_SIZE = 256

# Cleaning bounds and report limits.
AGE_MIN, AGE_MAX = 18, 100
AGE_BRACKET = 10
UNKNOWN_CITY = "Unknown"
HIGH_VALUE = 1000
TOP_N = 10
HIGH_VALUE_ROWS = 100
AMOUNT_BINS = 30
SCORE_BINS = 50


def check_columns(df, names):
    """Raise an error naming the columns of ``names`` that ``df`` lacks."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
