"""Row filters of the interactive report, and the values they offer."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOMAIN_COLUMNS = ["merchant_category", "state", "card_type", "payment_method"]


def date_domain(df: DataFrame) -> DataFrame:
    """First and last transaction date, one row."""
    day = F.to_date("transaction_date")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def value_domains(df: DataFrame, columns=tuple(DOMAIN_COLUMNS)) -> DataFrame:
    """Sorted distinct values of the filter columns, in long form.

    One scan; only distinct (field, value) pairs are shuffled.
    """
    columns = list(columns)
    return (
        df.select(*columns)
        .unpivot([], columns, "field", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("field", "value")
    )


def _date_conditions(df, start, end):
    """Date bounds, both ends inclusive. A range with one end only is no range."""
    if start is None or end is None:
        return []
    day = F.to_date("transaction_date")
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    out = [day >= first, day <= last]
    if "month" in df.columns:  # a table written by month skips other folders
        out += [F.col("month") >= str(start)[:7], F.col("month") <= str(end)[:7]]
    return out


def filter_transactions(
    df: DataFrame,
    *,
    start=None,
    end=None,
    categories=None,
    states=None,
    card_types=None,
    payments=None,
    international: bool | None = None,
    flagged: bool | None = None,
) -> DataFrame:
    """Rows that meet all given conditions; ``None`` sets no condition.

    An empty list of values selects no rows. All conditions are plain comparisons that
    reach the Parquet scan. The anomaly score of a row never changes by filtering.
    """
    conditions = _date_conditions(df, start, end)
    chosen = {
        "merchant_category": categories,
        "state": states,
        "card_type": card_types,
        "payment_method": payments,
    }
    conditions += [F.col(c).isin(list(v)) for c, v in chosen.items() if v is not None]
    for column, wanted in (("is_international", international), ("is_anomaly", flagged)):
        if wanted is not None:
            conditions.append(F.col(column) == int(wanted))
    return df.where(reduce(and_, conditions)) if conditions else df


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()
