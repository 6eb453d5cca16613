"""The whole run: raw transactions to quality report, scored table and reports."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txrisk import schema as S
from txrisk.operators.forest import ForestModel, fit_trees, score_and_flag
from txrisk.operators.quality import profile_and_clean
from txrisk.operators.quantiles import SMALL_GROUP
from txrisk.plans.reports import run_all_reports
from txrisk.sources.stages import owned_stages
from txrisk.sources.transactions import load_table, read_transactions

ROW_KEY = "_row_key"


@dataclass
class RiskRun:
    quality: DataFrame
    cleaned: DataFrame
    model: ForestModel
    scored: DataFrame
    reports: dict[str, DataFrame]


def run_cleaning(spark: SparkSession, path: str, fmt: str = "csv", **options):
    """Load, profile and clean a stored dataset: (quality report, cleaned table)."""
    return profile_and_clean(read_transactions(spark, path, fmt, **options))


def run_risk(
    raw: DataFrame,
    *,
    contamination: float = S.CONTAMINATION,
    path: str | None = None,
    **forest_options,
) -> RiskRun:
    """Profile, clean, score, load the table and prepare every report.

    Whole rows are shuffled once (de-duplication) and written twice (distinct rows,
    scored rows), or three times with ``path``, which keeps the table by month. Trees draw
    rows by a key made of the columns the rows are distinct in, so no row moves for that.
    Stages that the results do not read are deleted at the end.
    """
    spark = raw.sparkSession
    with owned_stages(spark) as stages:
        report, keyed = profile_and_clean(raw, row_key=ROW_KEY)
        cleaned = keyed.drop(ROW_KEY)
        rows = cleaned.count()
        options = {"key": ROW_KEY, **forest_options}
        small = options.get("small", SMALL_GROUP)
        model = fit_trees(keyed, rows=rows, **options)
        scored = score_and_flag(model, cleaned, contamination, rows, small)
        scored = load_table(scored, path=path)
        quality = spark.createDataFrame(report.collect(), report.schema)  # one row
        stages.keep(cleaned, scored)
    return RiskRun(quality, cleaned, model, scored, run_all_reports(spark))
