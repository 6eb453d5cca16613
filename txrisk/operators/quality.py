"""Data-quality profile of raw transactions and the report on a cleaning run."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.money import percentage
from txrisk.operators.cleaning import (
    CLEANED,
    clean_distinct,
    data_columns,
    distinct_summary,
    distinct_transactions,
    record_counts,
)
from txrisk.operators.quantiles import SMALL_GROUP
from txrisk.sources.stages import materialize

SUMS = [
    "total_records",
    "total_missing_cells",
    "duplicate_rows",
    "invalid_amount_count",
    "invalid_age_count",
]

def _profile(counted: DataFrame, n_columns: int) -> DataFrame:
    """One row of sums as a quality profile."""
    cells = F.col("total_records") * F.col("total_columns")
    faults = ["duplicate_rows", "invalid_amount_count", "invalid_age_count", "total_missing_cells"]
    return counted.select(
        "total_records",
        F.lit(n_columns).cast("bigint").alias("total_columns"),
        "total_missing_cells",
        "duplicate_rows",
        "invalid_amount_count",
        "invalid_age_count",
    ).withColumns(
        {
            "missing_pct": percentage(F.col("total_missing_cells"), cells, 3),
            "is_valid_overall": reduce(add, [F.col(c) for c in faults]) == 0,
        }
    )


def profile_distinct(distinct: DataFrame) -> DataFrame:
    """Quality profile from a table of distinct transactions, in one aggregation."""
    counted = distinct.agg(*[c.alias(n) for n, c in record_counts(distinct).items()])
    return _profile(counted, len(data_columns(distinct)))


def profile_summary(summary: DataFrame, n_columns: int) -> DataFrame:
    """The same from the sums by age bracket that cleaning reads too."""
    names = [c for c in SUMS if c in summary.columns]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]
    return _profile(summary.agg(*sums), n_columns)


def profile(df: DataFrame) -> DataFrame:
    """Quality profile of raw transactions: one row, from one scan and one shuffle."""
    S.check_columns(df, ["transaction_amount", "customer_age"])
    return profile_distinct(distinct_transactions(df))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with missing cells and how many; a single aggregation, no row shuffle."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "missing_count").where("missing_count > 0")


def with_removed(report: DataFrame, records_after: int) -> DataFrame:
    """Add the row count after cleaning and the number of rows removed."""
    return report.withColumns(
        {
            "total_records_after_cleaning": F.lit(records_after).cast("bigint"),
            "records_removed": F.col("total_records") - F.lit(records_after),
        }
    )


def profile_and_clean(
    df: DataFrame,
    *,
    lenient: bool = False,
    row_key: str | None = None,
    small: int = SMALL_GROUP,
) -> tuple[DataFrame, DataFrame]:
    """Quality report and cleaned table from one shuffle of the raw rows.

    The distinct transactions are staged with copy counts; one aggregate over that stage, by
    age bracket, gives the profile, the checks and what the filling steps need. ``row_key``
    names a column to add that tells the cleaned rows apart.
    """
    S.check_columns(df, CLEANED)
    distinct = materialize(distinct_transactions(df), "distinct")
    summary = distinct_summary(distinct, small)
    cleaned, rows = clean_distinct(
        distinct, summary=summary, row_key=row_key, lenient=lenient, small=small
    )
    report = profile_summary(summary, len(data_columns(distinct)))
    return with_removed(report, rows), cleaned


def cleaning_actions(report: DataFrame) -> DataFrame:
    """The report's row counts in long form, one row per cleaning action."""
    return report.select(
        F.col("duplicate_rows").alias("duplicate_rows_removed"),
        F.col("invalid_amount_count").alias("invalid_amounts_removed"),
        F.col("total_records").alias("records_before_cleaning"),
        F.col("total_records_after_cleaning").alias("records_after_cleaning"),
        F.col("records_removed").alias("total_records_removed"),
    ).unpivot(
        [],
        [
            "duplicate_rows_removed",
            "invalid_amounts_removed",
            "records_before_cleaning",
            "records_after_cleaning",
            "total_records_removed",
        ],
        "action",
        "row_count",
    )
