"""Raw transactions derived from the order tables of the test data.

One transaction per order that has line items. The supplier plays the merchant; the
defects, outliers and copies a cleaning run should find sit at fixed order keys. The
same mapping is written a second time, in SQL for another engine, in ``oracles.py``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import scalars as X


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw transactions, duplicates included. Joins carry no hints: the planner
    broadcasts a side by its measured size and splits hot keys otherwise."""

    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    merchant_of = (
        table("lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("s_suppkey"))
    )
    base = (
        table("orders")
        .join(merchant_of, "o_orderkey")
        .join(table("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
        .join(table("supplier"), "s_suppkey")
        .join(table("nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    )
    k = F.col("o_orderkey")
    cents = F.floor(F.col("o_totalprice")).cast("bigint")
    amount = cents / F.lit(100.0)
    planted, abroad = k % 50 == 7, k % 14 == 0
    day = F.col("o_orderdate").cast("date")
    at = day.cast("timestamp_ntz") + F.make_dt_interval(secs=k * 7919 % 86400)
    # current amount times 0.50 to 1.50, plus -10.00 to 10.00, at least 1.00
    noisy = F.call_function("div", cents * (50 + k * 31 % 101), F.lit(100)) + (
        k * 17 % 2001 - 1000
    )
    previous = F.greatest(noisy, F.lit(100)) / F.lit(100.0)
    away = (
        F.abs(F.col("c_nationkey") - F.col("s_nationkey")).cast("bigint")
        + F.when(planted, 2000 + k % 10000).when(abroad, 500 + k % 7500).otherwise(0)
    )
    rows = base.select(
        X.key_text("TXN", k, 9).alias("transaction_id"),
        at.alias("transaction_date"),
        X.key_text("CUST", F.col("o_custkey"), 6).alias("customer_id"),
        X.key_text("MERCH", F.col("s_suppkey"), 5).alias("merchant_id"),
        F.concat(F.lit("CAT_"), (F.col("s_suppkey") % 12).cast("string")).alias(
            "merchant_category"
        ),
        F.when(k % 333 == 5, -amount)
        .when(planted, amount + 6000.0)
        .otherwise(amount)
        .alias("transaction_amount"),
        F.when(k % 100 != 17, F.concat(F.lit("CITY_"), F.col("s_nationkey").cast("string"))).alias(
            "city"
        ),
        F.col("n_name").alias("state"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("c_mktsegment").alias("card_type"),
        (16 + F.col("o_custkey") % 90).alias("customer_age"),
        F.when(k % 100 != 43, F.col("c_acctbal")).alias("customer_income"),
        F.when(planted, 1 + k % 4)
        .otherwise((k * 13 + F.col("o_custkey")) % 24)
        .alias("transaction_hour"),
        (planted | abroad).cast("bigint").alias("is_international"),
        X.weekend_flag(day).alias("is_weekend"),
        previous.alias("previous_transaction_amount"),
        away.cast("double").alias("distance_from_home_km"),
        planted.cast("bigint").alias(S.LABEL),
        (k % 200 == 9).alias("_copied"),
    )
    # a copied row appears twice; exploding avoids a second pass over the joins
    copies = F.when(F.col("_copied"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copied", "_copy")
