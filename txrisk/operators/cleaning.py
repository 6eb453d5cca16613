"""Cleaning: de-duplicate, drop invalid amounts, fill, impute, clip, cast."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions import hashing as H
from txrisk.functions import scalars as X
from txrisk.operators.quantiles import SMALL_GROUP, exact_quantile
from txrisk.sources.stages import materialize

COPIES = "_copies"
FLOATS = [
    "transaction_amount",
    "previous_transaction_amount",
    "distance_from_home_km",
    "customer_income",
]
INTEGERS = ["is_international", "is_weekend", "transaction_hour"]
CLEANED = ["transaction_amount", "city", "customer_age", *FLOATS, *INTEGERS]  # columns it needs


def missing_mark(column: str) -> str:
    return f"_missing_{column}"


def data_columns(distinct: DataFrame) -> list[str]:
    """Columns of the raw table, in a table of distinct transactions."""
    helpers = {COPIES, *(missing_mark(c) for c in distinct.columns)}
    return [c for c in distinct.columns if c not in helpers]


def distinct_transactions(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row per distinct set of required columns, with its number of copies.

    Missing equals missing. Copies collapse before the shuffle, so a row repeated many
    times is no hot spot. Columns outside the key (the label) are taken together from
    one copy: the first by ``order_by``, or else the lowest. Their null counts are kept
    too, so the table holds all that the quality profile needs.
    """
    keys = [c for c in S.REQUIRED if c in df.columns]
    extras = [c for c in df.columns if c not in keys]
    aggs = [F.count(F.lit(1)).alias(COPIES)]
    aggs += [F.count_if(F.col(c).isNull()).alias(missing_mark(c)) for c in extras]
    if order_by is not None and extras:
        aggs.append(F.min_by(F.struct(*extras), order_by).alias("_extra"))
    elif len(extras) == 1:
        aggs.append(F.min(extras[0]).alias(extras[0]))
    elif extras:
        aggs.append(F.min(F.struct(*extras)).alias("_extra"))
    out = df.groupBy(*keys).agg(*aggs)
    if "_extra" in out.columns:
        out = out.select("*", "_extra.*").drop("_extra")
    return out.select(*df.columns, COPIES, *[missing_mark(c) for c in extras])


def drop_duplicates(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Keep one row of each set of copies over the required columns that are present."""
    return distinct_transactions(df, order_by).select(*df.columns)


def keep_positive(df: DataFrame) -> DataFrame:
    """Keep rows with an amount above zero; a missing amount is dropped too."""
    return df.where(F.col("transaction_amount") > 0)


def fill_city(df: DataFrame) -> DataFrame:
    return df.fillna({"city": S.UNKNOWN_CITY})


def _attach(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Left join of bracket medians. They are written first, so that the planner knows their
    size: it broadcasts few, as for real ages, and splits hot brackets of many."""
    return df.join(materialize(medians, "medians"), "_bracket", "left")


def _with_bracket(df: DataFrame) -> DataFrame:
    return df.withColumn("_bracket", X.bracket(F.col("customer_age"), S.AGE_BRACKET))


def _bracket_counts(df: DataFrame, kept: Column) -> dict:
    """What the filling steps must know of the rows ``kept``, in an age bracket: rows, known and
    missing incomes, and missing integers."""
    income = F.col("customer_income")
    counts = {"_rows": F.count_if(kept), "_n": F.count_if(kept & income.isNotNull())}
    counts["_gaps"] = F.count_if(kept & income.isNull())
    for c in INTEGERS:
        if c in df.columns:
            counts[missing_mark(c)] = F.count_if(kept & F.col(c).isNull())
    return counts


def bracket_counts(df: DataFrame) -> DataFrame:
    """Counts by age bracket, from one scan; stored, being read twice."""
    aggs = [c.alias(n) for n, c in _bracket_counts(df, F.lit(True)).items()]
    return materialize(_with_bracket(df).groupBy("_bracket").agg(*aggs), "brackets")


def record_counts(distinct: DataFrame) -> dict:
    """The sums behind a quality profile, as aggregates over distinct transactions."""
    amount, age, copies = F.col("transaction_amount"), F.col("customer_age"), F.col(COPIES)

    def weighted(condition):
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0)).cast("bigint")

    cells = []
    for c in data_columns(distinct):
        mark = missing_mark(c)
        known = mark in distinct.columns
        cells.append(F.coalesce(F.sum(mark), F.lit(0)) if known else weighted(F.col(c).isNull()))
    return {
        "total_records": F.coalesce(F.sum(copies), F.lit(0)).cast("bigint"),
        "total_missing_cells": reduce(add, cells).cast("bigint"),
        "duplicate_rows": F.coalesce(F.sum(copies - 1), F.lit(0)).cast("bigint"),
        "invalid_amount_count": weighted(amount <= 0),
        "invalid_age_count": weighted((age < S.AGE_MIN) | (age > S.AGE_MAX)),
    }


def distinct_summary(distinct: DataFrame, small: int = SMALL_GROUP) -> DataFrame:
    """All that profile and cleaning must know of a stored table of distinct transactions,
    by age bracket, from one scan; stored.

    The sums of the profile over all rows, the counts of the rows that are kept, and, when
    the table is small, their median incomes.
    """
    kept = F.coalesce(F.col("transaction_amount") > 0, F.lit(False))
    aggs = {**record_counts(distinct), **_bracket_counts(distinct, kept)}
    if distinct.count() <= small:  # from the files' footers
        aggs["_median"] = F.percentile(F.when(kept, F.col("customer_income").cast("double")), 0.5)
    grouped = _with_bracket(distinct).groupBy("_bracket")
    return materialize(grouped.agg(*[c.alias(n) for n, c in aggs.items()]), "summary")


def bracket_totals(counts: DataFrame) -> dict:
    """Over all brackets: ``rows``, ``left`` (whether an income stays missing after the
    brackets' medians), and the integer columns with missing values."""
    bracket, known = F.col("_bracket"), F.col("_n")
    # a null is left only where a bracket has no income at all, or an age is missing
    unfilled = (bracket.isNull() | (known == 0)) & (F.col("_gaps") > 0)
    marks = [c for c in INTEGERS if missing_mark(c) in counts.columns]
    found = counts.agg(
        F.sum("_rows").alias("rows"),
        F.max(unfilled).alias("left"),
        *[F.sum(missing_mark(c)).alias(c) for c in marks],
    ).first()
    bad = [c for c in marks if found[c]]
    return {"rows": found["rows"] or 0, "left": bool(found["left"]), "bad": bad}


def impute_income(
    df: DataFrame,
    *,
    counts: DataFrame | None = None,
    totals: dict | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Fill income with the median of the age bracket, then with the overall median.

    Brackets come from the age as given, before clipping. The overall median is taken
    after the first fill. Reads two columns of ``df`` a few times: pass a stored table.
    A missing bracket has no median, and matches none. ``counts`` are the table's
    ``bracket_counts`` (which may hold the medians as ``_median``) and ``totals`` their
    ``bracket_totals``, if at hand.
    """
    keyed = _with_bracket(df)
    counts = bracket_counts(df) if counts is None else counts
    totals = bracket_totals(counts) if totals is None else totals
    bracket, rows = F.col("_bracket"), totals["rows"]
    if "_median" in counts.columns:
        medians = counts.where(bracket.isNotNull()).select("_bracket", "_median")
    else:
        medians = exact_quantile(
            keyed.where(bracket.isNotNull()),
            "customer_income",
            0.5,
            ["_bracket"],
            name="_median",
            rows=rows,
            sizes=counts.where(bracket.isNotNull()),
            small=small,
        )
    income = F.coalesce("customer_income", "_median")
    filled = _attach(keyed, medians).withColumn("customer_income", income).select(*df.columns)
    if not totals["left"]:
        return filled
    overall = exact_quantile(filled, "customer_income", 0.5, rows=rows, small=small).first()[0]
    return filled if overall is None else filled.fillna({"customer_income": overall})


def clip_age(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_age", X.clip(F.col("customer_age"), S.AGE_MIN, S.AGE_MAX))


def check_integers(totals: dict) -> None:
    """Raise when a column that must be an integer has missing values."""
    if totals["bad"]:
        raise ValueError(f"missing values in integer column(s): {', '.join(totals['bad'])}")


def cast_types(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Cast the four amounts to double and the three flags to bigint.

    Text that is no number raises, or becomes null when ``lenient``.
    """
    kinds = {**dict.fromkeys(FLOATS, "double"), **dict.fromkeys(INTEGERS, "bigint")}
    return df.withColumns(
        {c: F.col(c).try_cast(k) if lenient else F.col(c).cast(k) for c, k in kinds.items()}
    )


def clean_distinct(
    distinct: DataFrame,
    *,
    summary: DataFrame | None = None,
    row_key: str | None = None,
    lenient: bool = False,
    small: int = SMALL_GROUP,
) -> tuple[DataFrame, int]:
    """The steps after de-duplication, over a stored table of distinct transactions.

    Returns the cleaned table and its row count. ``row_key`` adds a column of that name which
    tells its rows apart: a hash of the columns they were distinct in, before any is changed.
    """
    summary = distinct_summary(distinct, small) if summary is None else summary
    totals = bracket_totals(summary)
    if not lenient:
        check_integers(totals)
    names = data_columns(distinct)
    keys = [c for c in S.REQUIRED if c in names]
    key = [] if row_key is None else [H.row_key(keys).alias(row_key)]
    kept = fill_city(keep_positive(distinct.select(*names, *key)))
    filled = impute_income(kept, counts=summary, totals=totals, small=small)
    return cast_types(clip_age(filled), lenient), totals["rows"]


def clean(
    df: DataFrame,
    *,
    lenient: bool = False,
    order_by: str | None = None,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """The whole cleaning run.

    The distinct rows are written to a stage once: that is the only shuffle of whole
    rows. Counts and medians then scan a few columns of the stage, and the returned frame
    is a projection over it.
    """
    S.check_columns(df, CLEANED)
    distinct = materialize(distinct_transactions(df, order_by), "distinct")
    return clean_distinct(distinct, lenient=lenient, small=small)[0]
