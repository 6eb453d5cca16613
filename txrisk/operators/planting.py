"""Planting known outliers, defects and copies into a transactions table.

For checking a cleaning or scoring run on one's own data: the planted rows are known by
the row key and a seed, so they can be found again. Each row is picked on its own, so
about the given share is planted, row by row and without a shuffle. With ``exact`` the
rows with the lowest hashes are picked, exactly ``floor(rows * share)`` of them; that reads
the keys a few times to find the cut. Of rows that share the key on the cut, as many as are
wanted are taken in the order of their columns.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import hashing as H
from txrisk.operators.sampling import mark_exact

KEY = "transaction_id"

# Shares and ranges of what is planted.
OUTLIER_SHARE = 0.02
OUTLIER_AMOUNT = (1500, 9000)
OUTLIER_HOURS = (1, 4)
OUTLIER_DISTANCE = (2000, 12000)
MISSING_SHARE = 0.01
INVALID_SHARE = 0.003
DUPLICATE_SHARE = 0.005


def _picked(df: DataFrame, shares: dict, key, seed, exact: bool) -> DataFrame:
    """``df`` with a true or false column ``_<purpose>`` for each purpose and its share."""
    k = H.key_of(df, key)
    if not exact:
        marks = {f"_{p}": H.chosen(k, f"{seed}/{p}", share) for p, share in shares.items()}
        return df.withColumns(marks)
    rows, out = df.count(), df
    for p, share in shares.items():
        hashed = H.word(H.digest(k, f"{seed}/{p}"), 0)
        out = mark_exact(out, f"_{p}", hashed, int(rows * share), rows)
    return out


def _hundredths(key: Column, seed: str, low: int, high: int) -> Column:
    """A number in [low, high], in steps of 0.01, from the key."""
    steps = (high - low) * 100 + 1
    return (H.word(H.digest(key, seed), 0) % steps + low * 100) / F.lit(100.0)


def plant_outliers(
    df: DataFrame, share=OUTLIER_SHARE, *, key=KEY, seed=S.SEED, exact: bool = True
) -> DataFrame:
    """Make some rows stand out (amount, hour, distance, abroad) and label them.

    The previous amount is left alone.
    """
    k = H.key_of(df, key)
    hours = OUTLIER_HOURS[1] - OUTLIER_HOURS[0] + 1
    hour = H.word(H.digest(k, f"{seed}/hour"), 0) % hours + OUTLIER_HOURS[0]
    values = {
        "transaction_amount": _hundredths(k, f"{seed}/amount", *OUTLIER_AMOUNT),
        "transaction_hour": hour,
        "distance_from_home_km": _hundredths(k, f"{seed}/distance", *OUTLIER_DISTANCE),
        "is_international": F.lit(1).cast("bigint"),
    }
    marked = _picked(df, {"outlier": share}, key, seed, exact)
    hit = F.col("_outlier")
    marked = marked.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})
    return marked.withColumn(S.LABEL, hit.cast("bigint")).drop("_outlier")


def plant_defects(
    df: DataFrame,
    missing=MISSING_SHARE,
    invalid=INVALID_SHARE,
    *,
    key=KEY,
    seed=S.SEED,
    exact: bool = True,
) -> DataFrame:
    """Remove some cities and incomes and make some amounts negative, independently."""
    shares = {"city": missing, "income": missing, "invalid": invalid}
    marked = _picked(df, shares, key, seed, exact)
    amount = F.col("transaction_amount")
    changed = {
        "city": F.when(~F.col("_city"), F.col("city")),
        "customer_income": F.when(~F.col("_income"), F.col("customer_income")),
        "transaction_amount": F.when(F.col("_invalid"), -F.abs(amount)).otherwise(amount),
    }
    return marked.withColumns(changed).drop(*[f"_{p}" for p in shares])


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """All rows of both tables, by column name; nothing is de-duplicated."""
    return df.unionByName(extra)


def plant_duplicates(
    df: DataFrame, share=DUPLICATE_SHARE, *, key=KEY, seed=S.SEED, exact: bool = True
) -> DataFrame:
    """Append a copy of some rows."""
    again = _picked(df, {"duplicate": share}, key, seed, exact).where("_duplicate")
    return append_rows(df, again.select(*df.columns))


def plant_all(df: DataFrame, *, key=KEY, seed=S.SEED, exact: bool = True) -> DataFrame:
    """Outliers, then defects, then copies."""
    options = {"key": key, "seed": seed, "exact": exact}
    return plant_duplicates(plant_defects(plant_outliers(df, **options), **options), **options)
