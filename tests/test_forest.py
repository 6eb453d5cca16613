import dataclasses
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.operators import features as X
from txrisk.operators import forest as T
from txrisk.operators import sampling as P
from txrisk.operators.summary import planted_recall

TREES, SIZE = 25, 64


def table(spark, n=1500, planted=30):
    """Rows around one centre, the first few far away from it."""
    r = np.random.default_rng(3)
    far = np.arange(n) < planted
    data = pd.DataFrame(
        {
            "transaction_id": [f"T{i:06d}" for i in range(n)],
            "transaction_amount": np.where(far, r.uniform(1500, 9000, n), r.gamma(2, 50, n)).round(2),
            "transaction_hour": np.where(far, r.integers(1, 5, n), r.integers(8, 23, n)),
            "distance_from_home_km": np.where(far, r.uniform(2000, 12000, n), r.exponential(15, n)),
            "previous_transaction_amount": r.gamma(2, 50, n).round(2),
            "customer_income": r.normal(60000, 12000, n).round(2),
            "is_international": far.astype(int),
            S.LABEL: far.astype(int),
        }
    )
    data.loc[5:9, "customer_income"] = None
    return spark.createDataFrame(data).withColumn("customer_income", F.nanvl("customer_income", F.lit(None)))


@pytest.fixture(scope="module")
def rows(spark):
    df = table(spark).cache()
    yield df
    df.unpersist()


def fit(df, **options):
    return T.fit_trees(df, trees=TREES, size=SIZE, key="transaction_id", **options)


@pytest.fixture(scope="module")
def model(rows):
    return fit(rows)


def scores(df):
    return {r["transaction_id"]: r["raw_score"] for r in df.collect()}


def test_path_constant():
    assert [T.path_constant(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert T.path_constant(256) == pytest.approx(10.2447709)
    assert [T.depth_cap(n) for n in (1, 2, 3, 64, 256)] == [1, 1, 2, 6, 8]


@pytest.mark.parametrize("key", ["transaction_id", None])
def test_every_tree_has_its_full_sample(rows, key):
    trees = 10
    got = P.tree_samples(rows, 1500, ["transaction_id"], trees=trees, size=SIZE, key=key)
    groups = got.groupBy("tree").agg(F.count("*"), F.countDistinct("transaction_id")).collect()
    assert sorted(g[0] for g in groups) == list(range(trees))
    assert all(g[1] == g[2] == SIZE for g in groups)


def test_samples_do_not_depend_on_partitions(rows):
    def pick(df, **options):
        got = P.tree_samples(df, 1500, ["transaction_id"], trees=8, size=SIZE, **options)
        return sorted(got.collect())

    for key in ("transaction_id", None):
        assert pick(rows.repartition(16), key=key) == pick(rows, key=key)
    # a share far too low is raised until every tree is served
    assert len(pick(rows, key="transaction_id", oversample=0.3)) == 8 * SIZE


def test_trees_draw_on_their_own_at_any_size(spark):
    """Hits per row are binomial on both sides of what was once a limit."""
    for n in (204_000, 205_600):
        rows = spark.range(n).select(F.col("id").cast("string").alias("k"))
        hits = P.tree_candidates(rows, ["k"], 0.002, trees=200, key="k")
        per_row = {r[0]: r[1] for r in hits.groupBy("k").count().groupBy("count").count().collect()}
        total = sum(k * v for k, v in per_row.items())
        assert abs(total - 0.4 * n) < 5 * math.sqrt(0.4 * n)
        none = n - sum(per_row.values())
        assert abs(none - n * 0.998**200) < 5 * math.sqrt(n * 0.25)
        assert abs(per_row[2] - n * 0.0536) < 5 * math.sqrt(n * 0.0536)
        trees = [r[1] for r in hits.groupBy("tree").count().collect()]
        assert len(trees) == 200 and 15 < np.std(trees) < 26


def test_sample_of_a_small_table_is_all_of_it(spark, rows):
    few = rows.limit(10).cache()
    got = P.tree_samples(few, 10, ["transaction_id"], trees=5, size=SIZE)
    assert got.count() == 50


def test_copies_count_as_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "COPIES", 100)
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("x"))
    got = P.tree_samples(rows, 1000, trees=20, size=100).groupBy("tree").agg(
        F.count("*").alias("n"), F.sum((F.col("x") == 0).cast("int")).alias("same")
    )
    counts = [(r["n"], r["same"]) for r in got.collect()]
    assert all(n == 100 for n, _ in counts)
    assert 86 < np.mean([same for _, same in counts]) < 94
    numbered = P.numbered_copies(rows, ["x"])
    assert numbered.distinct().count() == numbered.count() == 1000


def test_a_common_row_is_the_least_unusual(spark):
    rows = spark.createDataFrame(
        [tuple([5.0] * 6) for _ in range(900)]
        + [tuple(map(float, v)) for v in np.random.default_rng(0).uniform(0, 10, (100, 6))],
        list(S.FEATURES),
    )
    scored = T.fit_trees(rows, trees=50).with_raw_score(rows).toPandas()
    same = (scored[list(S.FEATURES)] == 5.0).all(axis=1)
    assert scored[same]["raw_score"].min() > scored[~same]["raw_score"].mean() + 0.1


def test_constant_table_has_the_middle_score(spark):
    rows = spark.createDataFrame([tuple([1.0] * 6)] * 1000, list(S.FEATURES))
    raw = T.fit_trees(rows, trees=10).with_raw_score(rows).select("raw_score").distinct().collect()
    assert [r[0] for r in raw] == [pytest.approx(-0.5)]


def test_an_oversized_saved_model_is_refused(spark, model, tmp_path, monkeypatch):
    dataclasses.replace(model, threshold=0.0).save(spark, str(tmp_path / "m"))
    monkeypatch.setattr(T, "MAX_MODEL_CELLS", 100)
    with pytest.raises(ValueError):
        T.ForestModel.load(spark, str(tmp_path / "m"))


def test_nodes(model):
    nodes = model.nodes
    assert nodes["tree"].nunique() == TREES
    leaves = nodes[nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == SIZE).all()
    assert nodes["depth"].max() <= math.ceil(math.log2(SIZE))
    inner = nodes[nodes["feature"] >= 0].merge(
        nodes[["tree", "node", "size"]], left_on=["tree", "left"], right_on=["tree", "node"]
    ).merge(nodes[["tree", "node", "size"]], left_on=["tree", "right"], right_on=["tree", "node"])
    assert len(inner) == (nodes["feature"] >= 0).sum()
    assert (inner["size_x"] == inner["size_y"] + inner["size"]).all()
    assert (inner[["size_y", "size"]] > 0).all().all()


def test_model_and_scores_do_not_depend_on_partitions(rows, model):
    usual = scores(model.with_raw_score(rows))
    assert len(usual) == 1500 and all(-1 < s < 0 for s in usual.values())
    for n in (1, 4, 16):
        shuffled = rows.orderBy(F.rand(n)).repartition(n)
        other = fit(shuffled)
        pd.testing.assert_frame_equal(other.nodes, model.nodes)
        assert scores(other.with_raw_score(shuffled)) == usual


def test_seed_changes_the_forest(rows, model):
    assert not fit(rows, seed=7).nodes.equals(model.nodes)


def test_scaling_of_a_feature_leaves_scores(rows, model):
    usual = scores(model.with_raw_score(rows))
    stretched = rows.withColumn("transaction_amount", F.col("transaction_amount") * 4 + 1000)
    for options in ({}, {"standardize": False}):
        other = scores(fit(stretched, **options).with_raw_score(stretched))
        wrong = [k for k in usual if abs(usual[k] - other[k]) > 1e-6]
        assert len(wrong) <= 3  # a value on a split, by its last digit


def walk(model, row):
    """Path length of one row, node by node."""
    total = 0.0
    for _, tree in model.nodes.groupby("tree"):
        nodes = tree.set_index("node").to_dict("index")
        at = nodes[0]
        while at["feature"] >= 0:
            name = model.features[at["feature"]]
            x = row[name] if row[name] is not None else model.medians[name]
            mean, std = model.moments[name]
            x = (x - mean) / (std or 1.0)
            at = nodes[at["left"] if x <= at["split"] else at["right"]]
        total += at["depth"] + T.path_constant(at["size"])
    return total / TREES


def test_scores_equal_a_walk_through_the_nodes(rows, model):
    usual = scores(model.with_raw_score(rows))
    for row in rows.limit(40).collect():
        expected = -(2 ** (-walk(model, row) / T.path_constant(SIZE)))
        assert usual[row["transaction_id"]] == pytest.approx(expected, rel=1e-12)


def test_flags(rows):
    model, scored = T.fit_and_score(rows, 0.02, trees=TREES, size=SIZE, key="transaction_id")
    assert scored.columns == [*rows.columns, "anomaly_score", "is_anomaly"]
    got = scored.select("anomaly_score", "is_anomaly", S.LABEL).toPandas()
    assert len(got) == 1500
    assert ((got["anomaly_score"] < 0) == (got["is_anomaly"] == 1)).all()
    raw = got["anomaly_score"] + model.threshold
    assert model.threshold == pytest.approx(np.quantile(raw, 0.02), rel=1e-9)
    assert 25 <= got["is_anomaly"].sum() <= 30
    by_label = got.groupby(S.LABEL)["anomaly_score"].mean()
    assert by_label[1] < by_label[0]
    caught, planted = planted_recall(scored).first()
    assert planted == 30 and caught / planted >= 0.5


def test_threshold_large_path(rows, model):
    scored = model.with_raw_score(rows)
    assert T.score_threshold(scored, 0.02, small=50) == T.score_threshold(scored, 0.02)


def test_save_and_load(spark, rows, tmp_path):
    model, scored = T.fit_and_score(rows, trees=TREES, size=SIZE, key="transaction_id")
    model.save(spark, str(tmp_path / "model"))
    loaded = T.ForestModel.load(spark, str(tmp_path / "model"))
    pd.testing.assert_frame_equal(loaded.nodes, model.nodes)
    assert (loaded.medians, loaded.moments) == (model.medians, model.moments)
    columns = ["transaction_id", "anomaly_score", "is_anomaly"]
    assert sorted(loaded.score(rows).select(columns).collect()) == sorted(
        scored.select(columns).collect()
    )
    # a filter on rows leaves their scores as they are
    some = rows.where("is_international = 0")
    kept = scored.where("is_international = 0").select(columns)
    assert sorted(loaded.score(some).select(columns).collect()) == sorted(kept.collect())


def test_fit_only(rows):
    options = {"trees": 5, "size": 32, "features": ["transaction_amount"]}
    fitted, scored = T.fit_and_score(rows, 0.05, **options)
    alone = T.fit_forest(rows, 0.05, **options)
    pd.testing.assert_frame_equal(alone.nodes, fitted.nodes)
    assert alone.threshold == fitted.threshold
    assert alone.score(rows).where("is_anomaly = 1").count() == (
        scored.where("is_anomaly = 1").count()
    )


def test_model_size_is_checked(rows):
    with pytest.raises(ValueError, match="too large"):
        T.fit_trees(rows, trees=10_000_000)


def test_score_without_threshold(rows, model):
    with pytest.raises(ValueError, match="threshold"):
        model.score(rows)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_tiny_tables(rows, n):
    got = T.detect_anomalies(rows.limit(n).cache(), trees=5).collect()
    assert len(got) == n
    if n == 1:
        assert got[0]["is_anomaly"] == 0 and got[0]["anomaly_score"] == 0.0


def test_constant_table(spark, rows):
    same = rows.withColumns({c: F.lit(1.0) for c in S.FEATURES})
    got = T.detect_anomalies(same, trees=5, size=16).select("anomaly_score", "is_anomaly").distinct()
    assert [tuple(r) for r in got.collect()] == [(0.0, 0)]


def test_no_rows(rows):
    got = T.detect_anomalies(rows.limit(0), trees=5)
    assert got.count() == 0 and "is_anomaly" in got.columns


def test_features(rows):
    filled = X.impute_median(rows)
    assert filled.columns == S.FEATURES
    assert filled.where("customer_income is null").count() == 0
    medians = X.feature_medians(rows)
    assert X.feature_medians(rows, small=10) == medians
    for small in (10, 10_000):
        together = X.feature_statistics(rows, small=small)
        assert together[0] == medians
        for c, (mean, std) in X.feature_moments(filled).items():
            assert together[1][c] == pytest.approx((mean, std), rel=1e-12)
    scaled = X.standardize(filled)
    for mean, std in X.feature_moments(scaled).values():
        assert abs(mean) < 1e-9 and std == pytest.approx(1.0)
    constant = filled.withColumn("customer_income", F.lit(3.0))
    assert X.standardize(constant).agg(F.max("customer_income")).first()[0] == 0.0


def test_missing_feature_column(rows):
    with pytest.raises(ValueError, match="customer_income"):
        T.detect_anomalies(rows.drop("customer_income"))
