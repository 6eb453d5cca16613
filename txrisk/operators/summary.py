"""One-row summaries of scored transactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.money import mean, percentage, round_half_up, total


def _flagged():
    return F.coalesce(F.sum("is_anomaly"), F.lit(0)).cast("bigint")


def anomaly_summary(df: DataFrame) -> DataFrame:
    """Counts, rate, mean score, and mean amount of normal and of flagged rows.

    One conditional aggregation. No rows give a rate of 0.0 and no flagged rows a mean
    flagged amount of 0.0; no normal rows leave their mean missing.
    """
    amount, flag = F.col("transaction_amount"), F.col("is_anomaly")
    summary = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _flagged().alias("anomaly_count"),
        F.avg("anomaly_score").alias("_score"),
        mean(F.when(flag == 0, amount)).alias("avg_amount_normal"),
        mean(F.when(flag == 1, amount)).alias("_flagged_mean"),
    )
    n, flagged = F.col("total_transactions"), F.col("anomaly_count")
    return summary.select(
        "total_transactions",
        "anomaly_count",
        percentage(flagged, n, 3).alias("anomaly_rate_pct"),
        round_half_up(F.col("_score"), 4).alias("avg_anomaly_score"),
        "avg_amount_normal",
        F.when(flagged == 0, F.lit(0.0)).otherwise(F.col("_flagged_mean")).alias(
            "avg_amount_anomaly"
        ),
    )


def kpi_cards(df: DataFrame) -> DataFrame:
    """Headline numbers: row count, total and mean amount, anomaly rate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(total("transaction_amount"), F.lit(0.0)).alias("total_value"),
        mean("transaction_amount").alias("avg_value"),
        percentage(_flagged(), F.count(F.lit(1)), 3).alias("anomaly_rate_pct"),
    )


def planted_recall(df: DataFrame) -> DataFrame:
    """How many labelled outliers were flagged, of how many."""
    both = (F.col(S.LABEL) == 1) & (F.col("is_anomaly") == 1)
    return df.agg(
        F.count_if(both).alias("caught"),
        F.coalesce(F.sum(S.LABEL), F.lit(0)).cast("bigint").alias("planted"),
    )
