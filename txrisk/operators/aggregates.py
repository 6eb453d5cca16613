"""Aggregates over (filtered) transactions: trends, breakdowns, histograms, tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import scalars as X
from txrisk.functions.money import total

FLAGGED_COLUMNS = [
    "transaction_id",
    "transaction_date",
    "customer_id",
    "merchant_id",
    "merchant_category",
    "transaction_amount",
    "transaction_hour",
    "distance_from_home_km",
    "is_international",
    "anomaly_score",
]


def monthly_resample(df: DataFrame) -> DataFrame:
    """Count and sum of amounts per month start, with a row for every month between.

    Each month present is stretched up to the month before the next one, so gaps fill
    without joining to a calendar. The window sees one row per month, not per
    transaction.
    """
    month = X.month_start(F.col("transaction_date"))
    present = (
        df.where(F.col("transaction_date").isNotNull())
        .groupBy(month.alias("_first"))
        .agg(
            F.count("transaction_amount").alias("_count"),
            F.coalesce(total("transaction_amount"), F.lit(0.0)).alias("_sum"),
        )
    )
    last = F.add_months(F.lead("_first").over(Window.orderBy("_first")), -1)
    month_step = F.expr("interval 1 month")
    stretched = present.withColumn("_last", F.coalesce(last, F.col("_first"))).select(
        "*", F.explode(F.sequence("_first", "_last", month_step)).alias("month_start")
    )
    real = F.col("month_start") == F.col("_first")
    return stretched.select(
        "month_start",
        F.when(real, F.col("_count")).otherwise(0).alias("transaction_count"),
        F.when(real, F.col("_sum")).otherwise(0.0).alias("total_value"),
    ).orderBy("month_start")


def sum_by(df: DataFrame, key: str) -> DataFrame:
    """Sum of amounts per value of ``key``, largest first; a missing key has no group."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(total("transaction_amount"), F.lit(0.0)).alias("transaction_amount"))
        .orderBy(F.desc("transaction_amount"), key)
    )


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Number of rows per value of ``key``, largest first; a missing key has no group."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("transaction_count"))
        .orderBy(F.desc("transaction_count"), key)
    )


def category_spend(df: DataFrame) -> DataFrame:
    return sum_by(df, "merchant_category")


def category_count(df: DataFrame) -> DataFrame:
    return count_by(df, "merchant_category")


def state_count(df: DataFrame) -> DataFrame:
    return count_by(df, "state")


def state_value(df: DataFrame) -> DataFrame:
    return sum_by(df, "state")


def international_summary(df: DataFrame) -> DataFrame:
    """Count and sum of amounts for international and domestic transactions."""
    label = X.international_label(F.col("is_international"))
    return (
        df.groupBy(label.alias("txn_type"))
        .agg(
            F.count("transaction_amount").alias("transaction_count"),
            F.coalesce(total("transaction_amount"), F.lit(0.0)).alias("total_value"),
        )
        .orderBy("txn_type")
    )


def international_share(df: DataFrame) -> DataFrame:
    """Share of the transactions in each of the two groups."""
    summary = international_summary(df)
    everything = F.sum("transaction_count").over(Window.partitionBy())  # two rows
    return summary.select(
        "txn_type", "transaction_count", (F.col("transaction_count") / everything).alias("share")
    )


def high_value(df: DataFrame, threshold: float = S.HIGH_VALUE) -> DataFrame:
    return df.where(F.col("transaction_amount") >= threshold)


def high_value_count(df: DataFrame, threshold: float = S.HIGH_VALUE) -> DataFrame:
    return high_value(df, threshold).agg(F.count(F.lit(1)).alias("high_value_count"))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width histogram over the column's range, empty bins included.

    The top edge belongs to the last bin; a single distinct value makes one bin. With
    ``by`` the groups share the edges. Two narrow scans: range, then counts.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    names = [by] if by else []
    if low is None:
        low, high, df = 0.0, 0.0, df.limit(0)
    low, high = float(low), float(high)
    bins = bins if high > low else 1
    width = (high - low) / bins
    position = F.floor((F.col(column) - low) / width) if width > 0 else F.lit(0)
    bin_of = F.least(position, F.lit(bins - 1)).cast("bigint").alias("bin")
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(*names, bin_of).agg(F.count(F.lit(1)).alias("n"))
    # a group's counts by bin, at most one entry per bin, laid beside the list of all bins
    by_bin = F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts")
    grouped = counts.groupBy(*names).agg(by_bin).where(F.size("_counts") > 0)
    all_bins, bin_ = F.array(*[F.lit(i).cast("bigint") for i in range(bins)]), F.col("bin")
    return (
        grouped.withColumn("bin", F.explode(all_bins))
        .select(
            *names,
            "bin",
            (F.lit(low) + bin_ * F.lit(width)).alias("bin_start"),
            (F.lit(low) + (bin_ + 1) * F.lit(width)).alias("bin_end"),
            F.coalesce(F.try_element_at("_counts", bin_), F.lit(0)).alias("transaction_count"),
        )
        .orderBy(*names, "bin")
    )


def amount_histogram(df: DataFrame, bins: int = S.AMOUNT_BINS) -> DataFrame:
    """Distribution of the high-value amounts."""
    return histogram(high_value(df), "transaction_amount", bins)


def score_histogram(df: DataFrame, bins: int = S.SCORE_BINS) -> DataFrame:
    """Distribution of anomaly scores, split by status."""
    labelled = with_status(df).where(F.col("status").isNotNull())
    return histogram(labelled, "anomaly_score", bins, by="status")


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", X.status_label(F.col("is_anomaly")))


def flagged_table(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Flagged transactions, most unusual first; all of them unless a limit is asked.

    Ordered by a range-partitioned sort; the id breaks ties, so equal scores may spread
    over several tasks.
    """
    out = (
        df.where(F.col("is_anomaly") == 1)
        .select(*FLAGGED_COLUMNS)
        .orderBy(F.asc_nulls_last("anomaly_score"), "transaction_id")
    )
    return out if limit is None else out.limit(limit)
