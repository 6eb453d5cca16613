"""Time the headline stages and queries; prints one JSON line.

    BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     timed runs after one warm-up; the median is reported (default 3)

Raw transactions are staged once, as the pipeline would find them stored. Every timed
query ends in a write or in the collection of its (small) result.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txrisk.operators import aggregates, filters, forest, quality, summary  # noqa: E402
from txrisk.plans import reports  # noqa: E402
from txrisk.plans.risk import ROW_KEY  # noqa: E402
from txrisk.sources.orders_fixture import raw_transactions  # noqa: E402
from txrisk.sources.stages import materialize  # noqa: E402
from txrisk.sources.transactions import load_table  # noqa: E402


def session(cpus):
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txrisk-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )


def collected(df):
    return df.collect()


def stages(spark, sf_dir, timed):
    """The chain from raw rows to the loaded table, each step from the stored one before."""
    raw = timed("map_raw", lambda: materialize(raw_transactions(spark, sf_dir), "raw"))
    timed("dq_profile", lambda: collected(quality.profile(raw)))
    _, cleaned = timed("profile_and_clean", lambda: _profile_and_clean(raw))
    rows = cleaned.count()
    model = timed("forest_fit", lambda: forest.fit_trees(cleaned, rows=rows, key=ROW_KEY))
    cleaned = cleaned.drop(ROW_KEY)
    scored = timed("forest_score", lambda: materialize(model.with_raw_score(cleaned), "scored"))

    def flag():
        model.threshold = forest.score_threshold(scored, rows=rows)
        return materialize(forest.flag_scores(scored, model.threshold).drop("raw_score"), "flagged")

    table = timed("contamination_flag", flag)
    return rows, load_table(table)


def _profile_and_clean(raw):
    report, cleaned = quality.profile_and_clean(raw, row_key=ROW_KEY)
    return report.collect(), materialize(cleaned, "cleaned")


def table_queries(spark, table):
    chosen = filters.filter_transactions(
        table, start="1996-03-15", end="1998-10-20", categories=["CAT_1", "CAT_4"], flagged=False
    )
    out = {name: lambda name=name: reports.run_report(spark, name) for name in reports.REPORTS}
    out["all_reports"] = lambda: reports.report_sizes(reports.run_all_reports(spark))
    out["anomaly_summary"] = lambda: summary.anomaly_summary(table)
    out["kpi_cards_filtered"] = lambda: summary.kpi_cards(chosen)
    out["filter_domains"] = lambda: filters.value_domains(table)
    for name in (
        "monthly_resample",
        "category_spend",
        "state_count",
        "international_share",
        "amount_histogram",
        "score_histogram",
        "flagged_table",
    ):
        out[name] = lambda name=name: getattr(aggregates, name)(table)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, work):
        start = time.perf_counter()
        out = work()
        times.setdefault(name, []).append(time.perf_counter() - start)
        return out

    for _ in range(runs + 1):
        rows, table = stages(spark, sf_dir, timed)
        for name, query in table_queries(spark, table).items():
            timed(name, lambda query=query: collected(query()))
    medians = {n: round(statistics.median(t[1:] or t), 4) for n, t in times.items()}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "score_rows_per_sec": round(rows / medians["forest_score"]),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
