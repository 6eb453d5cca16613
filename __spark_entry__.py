"""

Every query maps the whole test tables to transactions (``orders_fixture``) and runs one
operator over them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txrisk import oracles as O  # noqa: E402
from txrisk import schema as S  # noqa: E402
from txrisk.functions import money  # noqa: E402
from txrisk.functions import scalars as X  # noqa: E402
from txrisk.operators import (  # noqa: E402
    aggregates,
    cleaning,
    features,
    filters,
    forest,
    planting,
    quality,
    sampling,
    summary,
)
from txrisk.plans import reports, streaming  # noqa: E402
from txrisk.plans.risk import run_risk  # noqa: E402
from txrisk.sources import transactions as sources  # noqa: E402
from txrisk.sources.orders_fixture import raw_transactions  # noqa: E402
from txrisk.sources.stages import materialize, new_path  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from txrisk.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "txrisk.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _text_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_date", X.iso_text(F.col("transaction_date")))


def _kept(spark, sf_dir) -> DataFrame:
    """De-duplicated rows with a positive amount and a city."""
    raw = raw_transactions(spark, sf_dir)
    return cleaning.fill_city(cleaning.keep_positive(cleaning.drop_duplicates(raw)))


def _ledger(spark, sf_dir) -> DataFrame:
    """The report table: cleaned but for income, which no report reads, with the label
    as flag and a score that is the same in any engine."""
    rows = cleaning.cast_types(cleaning.clip_age(_kept(spark, sf_dir)))
    score = -(F.col("distance_from_home_km") * 100 + F.col("transaction_amount"))
    return rows.withColumns({"is_anomaly": F.col(S.LABEL), "anomaly_score": score})


def _cleaned(spark, sf_dir) -> DataFrame:
    return cleaning.clean(raw_transactions(spark, sf_dir))


def _on(table, operator) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir))


def _brief(df: DataFrame) -> DataFrame:
    return _text_dates(df.select("transaction_id", "transaction_date", "transaction_amount"))


# ------------------------------------------------------------------- sources and sinks


def _scan_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    sources.write_transactions(raw_transactions(spark, sf_dir), path, "csv")
    return _text_dates(sources.read_transactions(spark, path, "csv"))


def _table_roundtrip(spark, sf_dir):
    table = sources.load_table(_ledger(spark, sf_dir), path=new_path(spark, "table"))
    return _text_dates(table.drop("month"))


def _load_or_build(spark, sf_dir):
    path = new_path(spark, "dataset")
    sources.load_or_build(spark, path, lambda: raw_transactions(spark, sf_dir))
    stored = sources.load_or_build(spark, path, lambda: spark.range(0).toDF("never_built"))
    return _text_dates(stored)


# ------------------------------------------------------------------- quality, cleaning


def _dq_report(spark, sf_dir):
    return quality.profile_and_clean(raw_transactions(spark, sf_dir))[0]


def _income(spark, sf_dir):
    rows = materialize(_kept(spark, sf_dir), "kept")
    return cleaning.impute_income(rows).select("transaction_id", "customer_age", "customer_income")


def _income_large(spark, sf_dir):
    """Brackets beyond what one task may hold, which a few hundred rows are here."""
    rows = materialize(_kept(spark, sf_dir), "kept")
    filled = cleaning.impute_income(rows, small=O.FEW)
    return filled.select("transaction_id", "customer_age", "customer_income")


def _income_fallback(spark, sf_dir):
    age = F.col("customer_age")
    emptied = F.when((age < 30) | (age >= 40), F.col("customer_income"))
    rows = materialize(_kept(spark, sf_dir).withColumn("customer_income", emptied), "kept")
    return cleaning.impute_income(rows).select("transaction_id", "customer_age", "customer_income")


# --------------------------------------------------------------------- anomaly scoring


def _features(df):
    names = features.project_features(df).columns
    return df.select("transaction_id", *[F.col(c).cast("double").alias(c) for c in names])


def _standardize(df):
    scaled = features.standardize(_features(df))
    rounded = {c: F.floor(F.col(c) * 1e6 + 0.5).cast("double") / 1e6 for c in S.FEATURES}
    return scaled.withColumns(rounded)


def _forest_samples(spark, sf_dir):
    rows = materialize(_kept(spark, sf_dir).select("transaction_id"), "keys")
    return sampling.tree_samples(rows, rows.count(), key="transaction_id")


def _sample_copies(spark, sf_dir):
    """How often each tree draws each city, from rows that only their city tells apart."""
    rows = materialize(_kept(spark, sf_dir).select("city"), "cities")
    drawn = sampling.tree_samples(rows, rows.count())
    return drawn.groupBy("tree").agg(F.count("*").alias("n"))


def _forest_nodes(spark, sf_dir):
    # the id is unique after cleaning; as the key it lets other engines draw the same rows
    return forest.fit_trees(_cleaned(spark, sf_dir), key="transaction_id").node_table(spark)


# A small given forest: (tree, node, feature, split, left, right, size, depth).
FIXED_NODES = [
    (0, 0, 0, 3000.0, 1, 2, 8, 0),
    (0, 1, 2, 100.0, 3, 4, 5, 1),
    (0, 2, 0, 7000.0, 5, 6, 3, 1),
    (0, 3, -1, 0.0, -1, -1, 3, 2),
    (0, 4, -1, 0.0, -1, -1, 2, 2),
    (0, 5, -1, 0.0, -1, -1, 2, 2),
    (0, 6, -1, 0.0, -1, -1, 1, 2),
    (1, 0, 2, 1500.0, 1, 2, 8, 0),
    (1, 1, 4, 0.0, 3, 4, 5, 1),
    (1, 2, 1, 4.0, 5, 6, 3, 1),
    (1, 3, -1, 0.0, -1, -1, 2, 2),
    (1, 4, -1, 0.0, -1, -1, 3, 2),
    (1, 5, -1, 0.0, -1, -1, 1, 2),
    (1, 6, -1, 0.0, -1, -1, 2, 2),
    (2, 0, 5, 0.5, 1, 2, 7, 0),
    (2, 1, -1, 0.0, -1, -1, 3, 1),
    (2, 2, 3, 2500.0, 5, 6, 4, 1),
    (2, 5, -1, 0.0, -1, -1, 2, 2),
    (2, 6, -1, 0.0, -1, -1, 2, 2),
]


def _score_fixed(spark, sf_dir):
    nodes = pd.DataFrame(FIXED_NODES, columns=forest.NODE_COLUMNS)
    model = forest.ForestModel(nodes, list(S.FEATURES), O.FIXED_SIZE)
    scored = model.with_raw_score(_cleaned(spark, sf_dir))
    rounded = F.floor(F.col("raw_score") * 1e9 + 0.5).cast("double") / 1e9
    return scored.select("transaction_id", rounded.alias("raw_score"))


def _scored(spark, sf_dir):
    return forest.detect_anomalies(_cleaned(spark, sf_dir), key="transaction_id")


def _scores(df):
    rounded = F.floor(F.col("anomaly_score") * 1e8 + 0.5) / 1e8
    return df.select("transaction_id", rounded.alias("anomaly_score"), "is_anomaly")


def _save_load_score(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    path = new_path(spark, "model")
    forest.fit_forest(cleaned, key="transaction_id").save(spark, path)
    return _scores(forest.ForestModel.load(spark, path).score(cleaned))


def _own_scores(spark, sf_dir):
    """Rows with the forest's own flags and scores, scored once."""
    rows = _scored(spark, sf_dir)
    rounded = F.floor(F.col("anomaly_score") * 1e8 + 0.5) / 1e8
    return materialize(rows.withColumn("anomaly_score", rounded), "own_scores")


def _own_rates(spark, sf_dir):
    sources.load_table(_own_scores(spark, sf_dir))
    return reports.run_report(spark, "anomaly_rate_by_category")


def _sub_cent_spend(spark, sf_dir):
    """Spend by category, of amounts with four decimals."""
    fine = F.floor(F.abs("transaction_amount") * 37) / F.lit(float(O.FINE))
    rows = _ledger(spark, sf_dir).withColumn("transaction_amount", fine)
    return rows.groupBy("merchant_category").agg(
        money.total("transaction_amount").alias("total_spend"),
        money.mean("transaction_amount").alias("avg_spend"),
    )


def _stream_scored(spark, sf_dir):
    """Rows that arrive in files, in four batches, scored by a forest fitted before."""
    cleaned = materialize(_cleaned(spark, sf_dir), "cleaned")
    model = forest.fit_forest(cleaned, key="transaction_id")
    arriving, table = new_path(spark, "arriving"), new_path(spark, "stream")
    files = max(1, spark.sparkContext.defaultParallelism // 4)  # a batch
    cleaned.repartition(4 * files).write.parquet(arriving)
    rows = streaming.read_stream(spark, arriving, cleaned.schema, files=files)
    query = streaming.score_stream(model, rows, table, checkpoint=new_path(spark, "log"))
    query.awaitTermination()
    return _scores(spark.read.parquet(table))


def _risk(part):
    """A part of the whole run, as a user without a key of their own calls it."""
    return lambda spark, sf_dir: part(spark, run_risk(raw_transactions(spark, sf_dir)))


def _given_scores(spark, sf_dir):
    rows = _ledger(spark, sf_dir).drop("is_anomaly")
    return materialize(rows.withColumnRenamed("anomaly_score", "raw_score"), "scores")


def _threshold(spark, sf_dir):
    scores = _given_scores(spark, sf_dir)
    cut = forest.exact_quantile(scores, "raw_score", S.CONTAMINATION, name="threshold")
    return cut.select((F.floor(F.col("threshold") * 1e6 + 0.5) / 1e6).alias("threshold"))


def _threshold_large(spark, sf_dir):
    cut = forest.score_threshold(_given_scores(spark, sf_dir), small=O.FEW)
    frame = spark.createDataFrame([(cut,)], "threshold double")
    return frame.select((F.floor(F.col("threshold") * 1e6 + 0.5) / 1e6).alias("threshold"))


def _flagged(spark, sf_dir):
    scores = _given_scores(spark, sf_dir)
    return forest.flag_scores(scores, forest.score_threshold(scores))


def _contamination_flag(spark, sf_dir):
    rounded = F.floor(F.col("anomaly_score") * 1e6 + 0.5) / 1e6
    return _flagged(spark, sf_dir).select(
        "transaction_id", rounded.alias("anomaly_score"), "is_anomaly"
    )


# ----------------------------------------------------------------------------- reports


def _report(name):
    def run(spark, sf_dir):
        sources.load_table(_ledger(spark, sf_dir))
        out = reports.run_report(spark, name)
        return _text_dates(out) if "transaction_date" in out.columns else out

    return run


def _all_reports(spark, sf_dir):
    sources.load_table(materialize(_ledger(spark, sf_dir), "ledger"))
    return reports.report_sizes(reports.run_all_reports(spark))


# ---------------------------------------------------------------- filters, dashboards


def _filter(**conditions):
    return _on(_ledger, lambda df: _brief(filters.filter_transactions(df, **conditions)))


_DATES = {"start": O.FILTER_START, "end": O.FILTER_END}
_LISTS = {
    "categories": O.FILTER_CATEGORIES,
    "states": O.FILTER_STATES,
    "card_types": O.FILTER_CARDS,
    "payments": O.FILTER_PAYMENTS,
}


def _has_rows(spark, sf_dir):
    """Whether rows are left, for a choice that leaves some and one that leaves none."""
    df = _ledger(spark, sf_dir)
    chosen = {"some": _LISTS, "none": {"states": ["NOWHERE"]}}
    rows = [
        (name, filters.has_rows(filters.filter_transactions(df, **c))) for name, c in chosen.items()
    ]
    return spark.createDataFrame(rows, "choice string, has_rows boolean")


def _date_domain(df):
    dates = filters.date_domain(df)
    return dates.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in dates.columns])


def _resample(df):
    months = aggregates.monthly_resample(df)
    return months.withColumn("month_start", F.date_format("month_start", "yyyy-MM-dd"))


# ---------------------------------------------------------------------------- planting


def _derive_keys(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        "o_orderkey",
        X.key_text("TXN", F.col("o_orderkey"), 7).alias("transaction_id"),
        X.key_text("CUST", F.col("o_custkey"), 6).alias("customer_id"),
    )


def _sample_exact(spark, sf_dir):
    keys = materialize(_kept(spark, sf_dir).select("transaction_id"), "keys")
    return sampling.sample_exact(keys, 0.01)


def _plant_exact(spark, sf_dir):
    rows = materialize(_kept(spark, sf_dir), "kept")
    planted = planting.plant_defects(planting.plant_outliers(rows))
    return planted.select(
        "transaction_id", S.LABEL, "city", "customer_income", "transaction_amount"
    )


def _sample_shared(spark, sf_dir):
    """Rows picked by a key of which each value is shared by many of them."""
    rows = materialize(_kept(spark, sf_dir).select("transaction_id", "state"), "keys")
    return sampling.sample_exact(rows, 0.1, key="state", small=O.FEW)


def _plant_shared(spark, sf_dir):
    rows = materialize(_kept(spark, sf_dir), "kept")
    planted = planting.plant_defects(rows, key="state")
    return planted.select("transaction_id", "city", "customer_income", "transaction_amount")


def _duplicates_exact(spark, sf_dir):
    rows = materialize(_kept(spark, sf_dir), "kept")
    return planting.plant_duplicates(rows).select("transaction_id", "transaction_amount")


def entry(spark: SparkSession) -> DataFrame:
    """Raw transactions, cleaned, scored and flagged: flagged share by category."""
    run = run_risk(raw_transactions(spark, SMOKE_DIR))
    return run.reports["anomaly_rate_by_category"]


def _training_data() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    raw, ledger, cleaned = raw_transactions, _ledger, _cleaned
    return {
        # sources and sinks
        "scan_csv": _scan_csv,
        "table_roundtrip": _table_roundtrip,
        "iso_dates": _on(raw, lambda df: _text_dates(df).select("transaction_id", "transaction_date")),
        "load_or_build": _load_or_build,
        "all_reports": _all_reports,
        # data quality
        "dq_profile": _on(raw, quality.profile),
        "dq_missing_by_column": _on(raw, quality.missing_by_column),
        "dq_removed": _on(
            _dq_report,
            lambda df: df.select("total_records", "total_records_after_cleaning", "records_removed"),
        ),
        "dq_actions": _on(_dq_report, quality.cleaning_actions),
        # cleaning
        "clean_dedup": _on(raw, lambda df: _text_dates(cleaning.drop_duplicates(df))),
        "clean_positive": _on(
            raw,
            lambda df: cleaning.keep_positive(df).select("transaction_id", "transaction_amount"),
        ),
        "clean_fill_city": _on(
            raw, lambda df: cleaning.fill_city(df).select("transaction_id", "city")
        ),
        "clean_income": _income,
        "clean_income_large": _income_large,
        "clean_income_fallback": _income_fallback,
        "clean_clip_age": _on(
            raw, lambda df: cleaning.clip_age(df).select("transaction_id", "customer_age")
        ),
        "clean_full": _on(cleaned, _text_dates),
        # anomaly scoring
        "features": _on(cleaned, _features),
        "impute_median": _on(raw, features.impute_median),
        "impute_median_large": _on(raw, lambda df: features.impute_median(df, small=O.FEW)),
        "standardize": _on(cleaned, _standardize),
        "forest_samples": _forest_samples,
        "forest_sample_copies": _sample_copies,
        "forest_nodes": _forest_nodes,
        "score_fixed_forest": _score_fixed,
        "score_forest": _on(_scored, _scores),
        "contamination_threshold": _threshold,
        "contamination_threshold_large": _threshold_large,
        "contamination_flag": _contamination_flag,
        "anomaly_summary": _on(ledger, summary.anomaly_summary),
        "forest_summary": _on(_scored, summary.anomaly_summary),
        "planted_recall": _on(_flagged, summary.planted_recall),
        "forest_recall": _on(_scored, summary.planted_recall),
        "save_load_score": _save_load_score,
        "score_stream": _stream_scored,
        "risk_nodes": _risk(lambda spark, run: run.model.node_table(spark)),
        "risk_rate_by_category": _risk(lambda _, run: run.reports["anomaly_rate_by_category"]),
        "forest_rate_by_category": _own_rates,
        "forest_score_histogram": _on(_own_scores, aggregates.score_histogram),
        "forest_flagged_table": _on(
            _own_scores, lambda df: _text_dates(aggregates.flagged_table(df))
        ),
        "sub_cent_spend": _sub_cent_spend,
        # named reports
        **{name: _report(name) for name in reports.REPORTS},
        # filters
        "filter_domains": _on(ledger, filters.value_domains),
        "filter_date_domain": _on(ledger, _date_domain),
        "filter_dates": _filter(**_DATES),
        "filter_in": _filter(**_LISTS),
        "filter_flags": _filter(international=True, flagged=False),
        "filter_has_rows": _has_rows,
        "filter_all": _filter(**_DATES, **_LISTS, international=False, flagged=False),
        # dashboard aggregates
        "kpi_cards": _on(ledger, summary.kpi_cards),
        "monthly_resample": _on(ledger, _resample),
        "monthly_resample_filtered": _on(
            ledger, lambda df: _resample(filters.filter_transactions(df, **O.SPARSE))
        ),
        "category_spend": _on(ledger, aggregates.category_spend),
        "category_count": _on(ledger, aggregates.category_count),
        "state_count": _on(ledger, aggregates.state_count),
        "state_value": _on(ledger, aggregates.state_value),
        "intl_summary": _on(ledger, aggregates.international_summary),
        "intl_share": _on(ledger, aggregates.international_share),
        "high_value_count": _on(ledger, aggregates.high_value_count),
        "amount_histogram": _on(ledger, aggregates.amount_histogram),
        "score_histogram": _on(ledger, aggregates.score_histogram),
        "status_label": _on(
            ledger, lambda df: aggregates.with_status(df).select("transaction_id", "status")
        ),
        "flagged_table": _on(ledger, lambda df: _text_dates(aggregates.flagged_table(df))),
        # scalar functions, planting, set operations
        "derive_weekend": _on(
            raw,
            lambda df: df.select(
                "transaction_id", X.weekend_flag(F.col("transaction_date")).alias("is_weekend")
            ),
        ),
        "derive_keys": _derive_keys,
        "plant_outliers": _on(
            raw, lambda df: _text_dates(planting.plant_outliers(df, exact=False))
        ),
        "plant_defects": _on(
            raw,
            lambda df: planting.plant_defects(df, exact=False).select(
                "transaction_id", "city", "customer_income", "transaction_amount"
            ),
        ),
        "plant_exact": _plant_exact,
        "union_duplicates": _on(
            raw, lambda df: _text_dates(planting.plant_duplicates(df, exact=False))
        ),
        "union_duplicates_exact": _duplicates_exact,
        "sample_exact_n": _sample_exact,
        "sample_exact_shared_key": _sample_shared,
        "plant_exact_shared_key": _plant_shared,
        **_training_data(),
    }


def oracle_sql() -> dict[str, str]:
    fixed = O.fixed_forest_sql(forest.path_constant(O.FIXED_SIZE))
    more = llm.SQL if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        more = {**more, "pipeline": corpus_pipeline.ORACLE_SQL}
    return {**O.SQL, "score_fixed_forest": fixed, **more}
