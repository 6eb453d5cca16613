"""Scalar column expressions used by the operators."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a CSV reader of the pandas family takes as missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def na_to_null(text: Column, na_values=NA_VALUES) -> Column:
    return F.when(~text.isin(list(na_values)), text)


def clip(col: Column, lower=None, upper=None) -> Column:
    """Bound a value on one or both sides; null stays null."""
    out = col
    if lower is not None:
        out = F.when(col < lower, F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(col > upper, F.lit(upper)).otherwise(out)
    return out


def bracket(col: Column, width: int) -> Column:
    """Lower edge of the value's bracket; rounds toward minus infinity."""
    return (F.floor(col / F.lit(float(width))) * width).cast("bigint")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def weekend_flag(ts: Column) -> Column:
    """1 for Saturday and Sunday, else 0."""
    return (F.weekday(F.to_date(ts)) >= 5).cast("bigint")


def key_text(prefix: str, number: Column, width: int) -> Column:
    """Prefix and number, the number padded with zeros; wider numbers stay whole."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def map_values(col: Column, mapping: dict) -> Column:
    """Look the value up in a small mapping; values not in it become null."""
    return reduce(
        lambda acc, kv: F.when(col == F.lit(kv[0]), F.lit(kv[1])).otherwise(acc),
        mapping.items(),
        F.lit(None),
    )


def international_label(col: Column) -> Column:
    return F.when(col == 1, "International").otherwise("Domestic")


def weekend_label(col: Column) -> Column:
    return F.when(col == 1, "Weekend").otherwise("Weekday")


def status_label(col: Column) -> Column:
    return map_values(col, {0: "Normal", 1: "Flagged"})
