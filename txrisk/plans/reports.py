"""The catalog of named SQL reports over the view ``transactions``.

Money is summed in cents (see ``functions.money``). Every ordered report ends its sort
with a natural key, so a limit always keeps the same rows.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.money import SQL_MEAN, SQL_TOTAL


@dataclass(frozen=True)
class Report:
    title: str
    sql: str


def _grouped(keys: dict, measures: dict, order: str = "", limit: int | None = None) -> str:
    """SELECT of key expressions and measures over the view, by name to expression."""
    columns = [f"{e} AS {c}" if e != c else c for c, e in {**keys, **measures}.items()]
    text = f"SELECT {', '.join(columns)}\nFROM transactions\nGROUP BY {', '.join(keys.values())}"
    if order:
        text += f"\nORDER BY {order}"
    return text if limit is None else f"{text}\nLIMIT {limit}"


_COUNT = {"transaction_count": "COUNT(*)"}
_VALUE = {"total_value": SQL_TOTAL, "avg_value": SQL_MEAN}
_FLAGGED = "CAST(SUM(is_anomaly) AS BIGINT)"

# Report names, titles and column names.
REPORTS = {
    "monthly_transaction_value": Report(
        "Monthly Transaction Value",
        _grouped(
            {"month": "date_format(transaction_date, 'yyyy-MM')"}, {**_COUNT, **_VALUE}, "month"
        ),
    ),
    "transaction_count_by_category": Report(
        "Transaction Count by Category",
        _grouped(
            {"merchant_category": "merchant_category"},
            _COUNT,
            "transaction_count DESC, merchant_category",
        ),
    ),
    "spend_by_category": Report(
        "Average Transaction Value by Category",
        _grouped(
            {"merchant_category": "merchant_category"},
            {"total_spend": SQL_TOTAL, "avg_spend": SQL_MEAN},
            "total_spend DESC, merchant_category",
        ),
    ),
    "top_customers_by_value": Report(
        "Top 10 Customers by Transaction Value",
        _grouped(
            {"customer_id": "customer_id"},
            {**_COUNT, "total_spend": SQL_TOTAL},
            "total_spend DESC, customer_id",
            S.TOP_N,
        ),
    ),
    "top_merchants_by_value": Report(
        "Top 10 Merchants by Transaction Value",
        _grouped(
            {"merchant_id": "merchant_id", "merchant_category": "merchant_category"},
            {**_COUNT, "total_value": SQL_TOTAL},
            "total_value DESC, merchant_id, merchant_category",
            S.TOP_N,
        ),
    ),
    "weekend_vs_weekday": Report(
        "Weekend vs Weekday Transactions",
        _grouped(
            {"day_type": "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"},
            {**_COUNT, **_VALUE},
        ),
    ),
    "international_vs_domestic": Report(
        "International vs Domestic Transactions",
        _grouped(
            {"txn_type": "CASE WHEN is_international = 1 THEN 'International' ELSE 'Domestic' END"},
            {**_COUNT, **_VALUE},
        ),
    ),
    "high_value_transactions": Report(
        "High-Value Transactions (≥ $1,000)",
        f"""SELECT transaction_id, transaction_date, customer_id, merchant_id,
  merchant_category, transaction_amount, state, is_international
FROM transactions
WHERE transaction_amount >= {S.HIGH_VALUE}
ORDER BY transaction_amount DESC, transaction_id
LIMIT {S.HIGH_VALUE_ROWS}""",
    ),
    "value_by_state": Report(
        "Transaction Value by State",
        _grouped({"state": "state"}, {**_COUNT, **_VALUE}, "total_value DESC, state"),
    ),
    "anomaly_rate_by_category": Report(
        "Anomaly Rate by Merchant Category",
        _grouped(
            {"merchant_category": "merchant_category"},
            {
                **_COUNT,
                "flagged_count": _FLAGGED,
                "flagged_rate_pct": (
                    f"CAST(({_FLAGGED} * 20000 + COUNT(*)) div (COUNT(*) * 2) AS DOUBLE) / 100D"
                ),
            },
            "flagged_rate_pct DESC, merchant_category",
        ),
    ),
}


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Run one SQL text against the loaded table."""
    return spark.sql(sql)


def run_report(spark: SparkSession, name: str) -> DataFrame:
    return run_query(spark, REPORTS[name].sql)


def run_all_reports(spark: SparkSession) -> dict[str, DataFrame]:
    """Every report that the loaded table has the columns for, as lazy frames."""
    has_flags = "is_anomaly" in spark.table("transactions").columns
    names = [n for n, r in REPORTS.items() if has_flags or "is_anomaly" not in r.sql]
    return {name: run_report(spark, name) for name in names}


def report_sizes(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of each report, in long form."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("report"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def report_catalog(spark: SparkSession) -> DataFrame:
    """Names, titles and SQL texts of the reports."""
    rows = [(name, r.title, r.sql) for name, r in REPORTS.items()]
    return spark.createDataFrame(rows, "report string, title string, sql string")
