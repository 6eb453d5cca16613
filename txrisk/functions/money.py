"""Exact money arithmetic.

Sums of doubles depend on the order in which partitions finish, so an amount is taken
to the millionth of a unit and summed as two BIGINTs, its whole cents and the rest. The
two make one DECIMAL at the end, rounded half away from zero to cents once: totals of
amounts finer than a cent lose nothing on the way. A sum too large raises (ANSI mode) and
is never silently wrong.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000  # steps in a unit
CENT = MICRO // 100


def micros(amount) -> Column:
    """Amount in millionths, as BIGINT, rounded half away from zero."""
    x = F.col(amount) if isinstance(amount, str) else amount
    size = F.floor(F.abs(x) * F.lit(float(MICRO)) + F.lit(0.5)).cast("bigint")
    return F.when(x < 0, -size).otherwise(size)


def _sum(amount) -> Column:
    """Aggregate: exact sum in millionths, as DECIMAL(38, 0)."""
    x = micros(amount)
    whole = F.sum(F.call_function("div", x, F.lit(CENT))).cast("decimal(38,0)")
    return (whole * F.lit(CENT) + F.sum(x % CENT)).cast("decimal(38,0)")


def total(amount) -> Column:
    """Aggregate: sum in currency units, to the cent; null when there is no amount."""
    cents = int_div_half_up(_sum(amount), F.lit(CENT).cast("decimal(38,0)"))
    return cents.cast("double") / F.lit(100.0)


def int_div_half_up(num: Column, den: Column) -> Column:
    """num / den rounded half away from zero, integers only; null when den is 0."""
    size = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(den > 0, F.when(num < 0, -size).otherwise(size))


def mean(amount) -> Column:
    """Aggregate: mean of the non-null amounts, rounded to 2 places."""
    rows = F.count(micros(amount)).cast("decimal(28,0)") * CENT
    return int_div_half_up(_sum(amount), rows.cast("decimal(38,0)")).cast("double") / F.lit(100.0)


def percentage(num: Column, den: Column, places: int) -> Column:
    """100 * num / den of two counts, rounded to ``places``; 0.0 when den is 0."""
    scale = 10**places
    scaled = int_div_half_up(num.cast("bigint") * (100 * scale), den.cast("bigint"))
    return F.coalesce(scaled.cast("double") / F.lit(float(scale)), F.lit(0.0))


def round_half_up(value: Column, places: int) -> Column:
    """Round a double by floor(x * 10^p + 0.5), the same operations in any engine."""
    scale = float(10**places)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


# The same rules as SQL text, for the report catalog.
_X = "transaction_amount"
_MICROS = f"CAST(SIGN({_X}) * FLOOR(ABS({_X}) * {float(MICRO)}D + 0.5D) AS BIGINT)"
_SUM = (
    f"(CAST(SUM({_MICROS} div {CENT}) AS DECIMAL(38,0)) * {CENT} + SUM({_MICROS} % {CENT}))"
)


def _sql_half_up(num: str, den: str) -> str:
    return f"CAST(SIGN({num}) * ((ABS({num}) * 2 + {den}) div NULLIF(({den}) * 2, 0)) AS DOUBLE) / 100D"


SQL_TOTAL = _sql_half_up(_SUM, str(CENT))
SQL_MEAN = _sql_half_up(_SUM, f"COUNT({_X}) * {CENT}")
