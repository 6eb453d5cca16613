"""Risk and spend analytics over transaction tables, on Spark DataFrames."""

from txrisk.operators.cleaning import clean
from txrisk.operators.filters import filter_transactions
from txrisk.operators.forest import ForestModel, detect_anomalies, fit_forest
from txrisk.operators.quality import profile, profile_and_clean
from txrisk.operators.summary import anomaly_summary
from txrisk.plans.reports import REPORTS, run_all_reports, run_query, run_report
from txrisk.plans.risk import run_cleaning, run_risk
from txrisk.sources.transactions import load_or_build, load_table, read_transactions
from txrisk.sources.transactions import write_transactions

__all__ = [
    "REPORTS",
    "ForestModel",
    "anomaly_summary",
    "clean",
    "detect_anomalies",
    "filter_transactions",
    "fit_forest",
    "load_or_build",
    "load_table",
    "profile",
    "profile_and_clean",
    "read_transactions",
    "run_all_reports",
    "run_cleaning",
    "run_query",
    "run_report",
    "run_risk",
    "write_transactions",
]
