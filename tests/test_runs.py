"""Whole runs: what they leave behind, tables that are replaced, streams."""

import pytest
from frames import numbered
from pyspark.sql import functions as F

import __spark_entry__ as entry
from txrisk import run_risk
from txrisk.operators import forest, sampling
from txrisk.operators.quality import profile_and_clean
from txrisk.plans import streaming
from txrisk.plans.risk import ROW_KEY
from txrisk.sources import stages, transactions
from txrisk.sources.orders_fixture import raw_transactions


def children(spark, path):
    files, folder = stages.files_at(spark, path)
    return {s.getPath().getName() for s in files.listStatus(folder)} if files.exists(folder) else set()


def stage_names(spark):
    return children(spark, stages.stage_root(spark))


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return stages.materialize(raw_transactions(spark, sf_dir), "raw")


# ------------------------------------------------------------------------------ stages


def test_a_run_leaves_only_what_its_results_read(spark, raw):
    before = stage_names(spark)
    run = run_risk(raw)
    left = {n.rsplit("-", 1)[0] for n in stage_names(spark) - before}
    assert left == {"distinct", "medians", "scored"}
    assert len(stage_names(spark) - before) == 3
    assert run.scored.count() == run.cleaned.count() == 1468
    assert run.quality.first()["total_records_after_cleaning"] == 1468
    assert ROW_KEY not in run.scored.columns and ROW_KEY not in run.cleaned.columns
    assert run.reports["anomaly_rate_by_category"].count() > 0


def test_a_failed_run_leaves_no_stage(spark, raw):
    before = stage_names(spark)
    with pytest.raises(ValueError, match="is_weekend"):
        run_risk(raw.withColumn("is_weekend", F.lit(None).cast("bigint")))
    assert stage_names(spark) == before


def test_owners_nest(spark):
    before = stage_names(spark)
    with stages.owned_stages(spark) as outer:
        with stages.owned_stages(spark) as inner:
            kept = stages.materialize(spark.range(3), "kept")
            stages.materialize(spark.range(3), "gone")
            inner.keep(kept)
        assert {n.split("-")[0] for n in stage_names(spark) - before} == {"kept"}
        own = stages.materialize(kept, "own")
        outer.keep(own)
    assert {n.split("-")[0] for n in stage_names(spark) - before} == {"own"}
    assert own.count() == 3


class Session:
    """A session without the setting."""

    def __init__(self, master):
        self.conf = {"spark.app.id": "unset", "spark.master": master}


def test_an_unset_folder_is_told():
    with pytest.warns(UserWarning, match="not set"):
        first = stages.stage_root(Session("local[2]"))
    assert stages.stage_root(Session("local[2]")) == first
    with pytest.raises(ValueError, match=stages.SETTING):
        stages.stage_root(Session("spark://somewhere:7077"))


# -------------------------------------------------------------------------- row keys


def test_rows_are_drawn_where_they_lie(spark, raw):
    _, cleaned = profile_and_clean(raw, row_key=ROW_KEY)
    keys = cleaned.select(ROW_KEY)
    assert keys.distinct().count() == keys.count() == 1468
    drawn = sampling.tree_candidates(cleaned, ["transaction_amount"], 0.01, key=ROW_KEY)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "hashpartitioning" not in plan


def test_rows_that_cleaning_makes_equal_keep_their_keys(spark):
    twins = numbered(spark, {"city": "Unknown"}, {"city": None})
    twins = twins.withColumn("transaction_id", F.lit("T"))
    _, cleaned = profile_and_clean(twins, row_key=ROW_KEY)
    assert cleaned.drop(ROW_KEY).distinct().count() == 1
    assert cleaned.select(ROW_KEY).distinct().count() == 2


# ------------------------------------------------------------------- replaced tables


def failing(df):
    bad = F.when(F.col("transaction_id") == "T1", F.raise_error(F.lit("lost"))).otherwise("c")
    return df.withColumn("city", bad)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    rows = numbered(spark, {}, {}, {})
    for path, write in (
        (str(tmp_path / "months"), lambda df, p: transactions.load_table(df, path=p)),
        (str(tmp_path / "plain"), transactions.write_transactions),
        (str(tmp_path / "csv"), lambda df, p: transactions.write_transactions(df, p, "csv")),
    ):
        write(rows, path)
        held = children(spark, path)
        with pytest.raises(Exception, match="lost"):
            write(failing(rows), path)
        assert children(spark, path) == held
    assert children(spark, str(tmp_path)) == {"months", "plain", "csv"}
    assert spark.read.parquet(str(tmp_path / "months")).count() == 3


def test_a_table_can_be_written_over_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    table = transactions.load_table(numbered(spark, {}, {}, {}), path=path)
    kept = transactions.load_table(table.where("transaction_id <> 'T1'").drop("month"), path=path)
    assert sorted(r.transaction_id for r in kept.collect()) == ["T0", "T2"]
    transactions.write_transactions(spark.read.parquet(path).limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_a_swap_that_was_cut_short_is_undone(spark, tmp_path):
    path = str(tmp_path / "table")
    transactions.write_transactions(numbered(spark, {}, {}), path)
    (tmp_path / "table").rename(tmp_path / "table.old-0123")
    stored = transactions.load_or_build(spark, path, lambda: numbered(spark, {}))
    assert stored.count() == 2 and children(spark, str(tmp_path)) == {"table"}


# ------------------------------------------------------------------------------ streams


def test_a_stream_gives_the_scores_of_a_batch(spark, raw, tmp_path):
    cleaned = stages.materialize(profile_and_clean(raw)[1], "cleaned")
    model = forest.fit_forest(cleaned, trees=20, key="transaction_id")
    expected = sorted(entry._scores(model.score(cleaned)).collect())
    source, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    half = F.xxhash64("transaction_id") % 2 == 0

    def run():
        rows = streaming.read_stream(spark, source, cleaned.schema, files=1)
        query = streaming.score_stream(model, rows, table, checkpoint=log)
        query.awaitTermination()
        return sorted(entry._scores(spark.read.parquet(table)).collect())

    cleaned.where(half).repartition(3).write.mode("append").parquet(source)
    first = run()
    assert first == [r for r in expected if r in set(first)] and 0 < len(first) < len(expected)
    assert run() == first  # nothing new, nothing twice
    cleaned.where(~half).repartition(2).write.mode("append").parquet(source)
    assert run() == expected


def test_a_stream_that_failed_goes_on(spark, raw, tmp_path):
    """A batch that fails, after others were written, is scored once by the next start."""
    cleaned = stages.materialize(profile_and_clean(raw)[1], "cleaned")
    model = forest.fit_forest(cleaned, trees=5, key="transaction_id")
    source, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    cleaned.repartition(3).write.parquet(source)
    broken = tmp_path / "in" / "part-zzz.parquet"
    broken.write_bytes(b"no table")

    def start():
        rows = streaming.read_stream(spark, source, cleaned.schema, files=1)
        return streaming.score_stream(model, rows, table, checkpoint=log)

    with pytest.raises(Exception):
        start().awaitTermination()
    whole = next(p for p in (tmp_path / "in").glob("part-0*.parquet"))
    broken.write_bytes(whole.read_bytes())  # the same rows once more, now readable
    start().awaitTermination()
    twice = spark.read.parquet(str(whole)).count()
    assert spark.read.parquet(table).count() == cleaned.count() + twice


def test_a_batch_of_one_file_is_scored_by_several_tasks(spark, raw, tmp_path):
    cleaned = stages.materialize(profile_and_clean(raw)[1], "cleaned")
    model = forest.fit_forest(cleaned, trees=5, key="transaction_id")
    source, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    tagged = cleaned.withColumn("tags", F.create_map(F.lit("a"), "transaction_id"))
    tagged.coalesce(1).write.parquet(source)
    rows = streaming.read_stream(spark, source, tagged.schema, files=1)
    streaming.score_stream(model, rows, table, checkpoint=log).awaitTermination()
    scored = spark.read.parquet(table)
    assert len(scored.inputFiles()) == spark.sparkContext.defaultParallelism
    assert sorted(entry._scores(scored).collect()) == sorted(entry._scores(model.score(cleaned)).collect())
