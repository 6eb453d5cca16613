"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Fit: bounded samples per tree are found by one scan, each tree grows in its own small
group, and the node table (at most ``trees * (2 * size - 1)`` rows, whatever the data)
is the model. Score: the node table goes to the executors and every row is scored where
it lies, in Arrow batches.

The functions sent to executors are closures over numpy only, so a cluster needs no
copy of this package.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk import schema as S
from txrisk.functions.hashing import BITS, SPAN
from txrisk.operators.features import feature_statistics, fill_features, scale_features
from txrisk.operators.quantiles import SMALL_GROUP, exact_quantile
from txrisk.operators.sampling import tree_samples
from txrisk.sources.stages import materialize

EULER_GAMMA = 0.5772156649015329
NODE_COLUMNS = ["tree", "node", "feature", "split", "left", "right", "size", "depth"]
NODE_SCHEMA = ", ".join(f"{c} {'double' if c == 'split' else 'bigint'}" for c in NODE_COLUMNS)
# Scaling digits kept in the model: sums of doubles may differ in their last digits
# from run to run, the model must not.
MOMENT_DIGITS = 9
# A model is broadcast to score: its size is set by trees and sample size, and checked.
MAX_MODEL_CELLS = 20_000_000
SCORE_CHUNK = 10_000  # rows scored at a time, so that their values stay in cache


def path_constant(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def depth_cap(size: int) -> int:
    return math.ceil(math.log2(max(size, 2)))


def tree_grower(features, seed: int, cap: int):
    """Function from one tree's sample to its nodes, for ``applyInPandas``.

    Nodes are numbered as in a heap (children of i: 2i + 1 and 2i + 2). A split takes a
    feature at random among those that vary in the node, and a point at random between
    its least and greatest value. Both come from the MD5 of seed, tree and node, so
    neither row order nor the order of growing matters.
    """
    features, names = list(features), list(NODE_COLUMNS)
    digits, span = BITS // 4, float(SPAN)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        data = rows[features].to_numpy(dtype=float)
        nodes, open_nodes = [], [(0, 0, data)]
        while open_nodes:
            node, depth, part = open_nodes.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            varying = np.flatnonzero(low < high)
            if depth >= cap or len(part) <= 1 or len(varying) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, len(part), depth))
                continue
            digest = hashlib.md5(f"{seed}|{tree}|{node}".encode()).hexdigest()
            feature = int(varying[int(digest[:digits], 16) % len(varying)])
            share = int(digest[digits : 2 * digits], 16) / span
            least, greatest = float(low[feature]), float(high[feature])
            split = least + share * (greatest - least)
            if split >= greatest:
                split = least
            left = part[:, feature] <= split
            nodes.append((tree, node, feature, split, 2 * node + 1, 2 * node + 2, len(part), depth))
            open_nodes.append((2 * node + 2, depth + 1, part[~left]))
            open_nodes.append((2 * node + 1, depth + 1, part[left]))
        return pd.DataFrame(nodes, columns=names)

    return grow


def grow_forest(samples: DataFrame, features, size: int, seed: int = S.SEED) -> DataFrame:
    """Node table of a forest: one isolation tree per group of ``tree``."""
    columns = samples.select("tree", *[F.col(c).cast("double").alias(c) for c in features])
    grower = tree_grower(features, seed, depth_cap(size))
    return columns.groupBy("tree").applyInPandas(grower, NODE_SCHEMA)


@dataclass
class ForestModel:
    """A fitted forest: its node table and the steps applied to rows before it.

    ``nodes`` holds at most ``trees * (2 * size - 1)`` rows, a bound set by parameters.
    """

    nodes: pd.DataFrame
    features: list[str]
    size: int
    medians: dict = field(default_factory=dict)
    moments: dict = field(default_factory=dict)
    threshold: float | None = None

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def _levels(self):
        """Split tests and leaf path lengths, laid out level by level for scoring.

        Every tree is completed to the full depth: below a leaf, tests always go left
        and the path length of the leaf is found at its leftmost descendant.
        """
        nodes = self.nodes
        trees = np.sort(nodes["tree"].unique())
        depth = int(nodes["depth"].max()) if len(nodes) else 0
        slots = 2**depth - 1
        feature = np.zeros((len(trees), max(slots, 1)), dtype=np.int64)
        split = np.full((len(trees), max(slots, 1)), np.inf)
        path = np.zeros((len(trees), 2**depth))
        row = np.searchsorted(trees, nodes["tree"].to_numpy())
        node, level = nodes["node"].to_numpy(), nodes["depth"].to_numpy()
        inner = nodes["feature"].to_numpy() >= 0
        feature[row[inner], node[inner]] = nodes["feature"].to_numpy()[inner]
        split[row[inner], node[inner]] = nodes["split"].to_numpy()[inner]
        leaf = ~inner
        place = (node[leaf] + 1 - 2 ** level[leaf]) * 2 ** (depth - level[leaf])
        constants = [path_constant(int(n)) for n in nodes["size"].to_numpy()[leaf]]
        path[row[leaf], place] = level[leaf] + np.array(constants)
        return depth, feature, split, path

    def prepare(self, df: DataFrame) -> DataFrame:
        """Feature columns of ``df`` made ready for the trees, beside its own columns."""
        names = {c: f"_x_{i}" for i, c in enumerate(self.features)}
        out = df.withColumns({n: F.col(c).cast("double") for c, n in names.items()})
        out = fill_features(out, {names[c]: m for c, m in self.medians.items()})
        return scale_features(out, {names[c]: m for c, m in self.moments.items()})

    def raw_score(self, spark: SparkSession) -> Column:
        """Scoring expression over prepared rows: lower is more unusual."""
        shared = spark.sparkContext.broadcast(self._levels())
        normal, chunk = path_constant(self.size), SCORE_CHUNK

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            depth, feature, split, path = shared.value
            levels = [slice(2**d - 1, 2 ** (d + 1) - 1) for d in range(depth)]
            for columns in batches:
                if isinstance(columns, pd.Series):  # Spark passes a single feature bare
                    columns = (columns,)
                parts = []
                for start in range(0, len(columns[0]), chunk):
                    part = [c.iloc[start : start + chunk].to_numpy(dtype=float) for c in columns]
                    values, n = np.concatenate(part), len(part[0])
                    rows, total = np.arange(n), np.zeros(n)
                    for t in range(len(path)):
                        column_start = feature[t] * n
                        at = np.zeros(n, dtype=np.int64)  # place among the level's nodes
                        for level in levels:
                            cell = column_start[level].take(at)
                            cell += rows
                            right = values.take(cell) > split[t, level].take(at)
                            at += at
                            at += right
                        total += path[t].take(at)
                    parts.append(total)
                total = np.concatenate(parts) if parts else np.zeros(0)
                if normal > 0:
                    yield pd.Series(-np.exp2(-total / (len(path) * normal)))
                else:
                    yield pd.Series(np.full(len(total), -0.5))

        return score(*[F.col(f"_x_{i}") for i in range(len(self.features))])

    def with_raw_score(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        scored = self.prepare(df).withColumn(name, self.raw_score(df.sparkSession))
        return scored.select(*df.columns, name)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly``; a map over rows, no shuffle."""
        if self.threshold is None:
            raise ValueError("the model has no threshold; fit it with fit_forest")
        return flag_scores(self.with_raw_score(df), self.threshold).drop("raw_score")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as two small Parquet tables."""
        rows = [
            (i, c, self.medians.get(c), *self.moments.get(c, (None, None)), self.size, self.threshold)
            for i, c in enumerate(self.features)
        ]
        schema = (
            "position int, feature string, median double, mean double, std double, "
            "size int, threshold double"
        )
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        settings = spark.createDataFrame(rows, schema)
        settings.coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        stored = spark.read.parquet(f"{path}/nodes")
        trees, deepest, count = stored.agg(
            F.count_distinct("tree"), F.max("depth"), F.count("*")
        ).first()
        # scoring lays every tree out to the full depth
        if count > MAX_MODEL_CELLS or trees * 2 ** ((deepest or 0) + 1) > MAX_MODEL_CELLS:
            raise ValueError(f"{count} nodes of depth {deepest} are too large a model")
        nodes = stored.orderBy("tree", "node").toPandas()
        rows = spark.read.parquet(f"{path}/settings").orderBy("position").collect()
        return cls(
            nodes,
            [r["feature"] for r in rows],
            rows[0]["size"],
            {r["feature"]: r["median"] for r in rows if r["median"] is not None},
            {r["feature"]: (r["mean"], r["std"]) for r in rows if r["mean"] is not None},
            rows[0]["threshold"],
        )


def score_threshold(
    df: DataFrame,
    contamination: float = S.CONTAMINATION,
    column: str = "raw_score",
    *,
    rows: int | None = None,
    small: int = SMALL_GROUP,
) -> float | None:
    """The interpolated quantile of the scores below which rows are flagged."""
    return exact_quantile(df, column, contamination, rows=rows, small=small).first()[0]


def flag_scores(df: DataFrame, threshold: float, column: str = "raw_score") -> DataFrame:
    """Shift scores so the threshold is zero, and flag what lies strictly below it."""
    shifted = F.col(column) - F.lit(threshold)
    return df.withColumns(
        {"anomaly_score": shifted, "is_anomaly": (shifted < 0).cast("bigint")}
    )


def _rounded(moments: dict) -> dict:
    def cut(x):
        return x if x is None else float(f"{x:.{MOMENT_DIGITS}g}")

    return {c: (cut(m), cut(s)) for c, (m, s) in moments.items()}


def fit_trees(
    df: DataFrame,
    *,
    features=tuple(S.FEATURES),
    trees: int = S.N_TREES,
    size: int = S.SAMPLE_SIZE,
    seed: int = S.SEED,
    key=None,
    standardize: bool = True,
    rows: int | None = None,
    small: int = SMALL_GROUP,
) -> ForestModel:
    """Grow the forest; the threshold is still open. ``df`` should be a stored table.

    ``key`` names columns that tell all rows apart; without it, rows with equal features
    are counted and drawn as so many rows.
    """
    features = list(features)
    S.check_columns(df, features)
    rows = df.count() if rows is None else rows
    size = max(min(size, rows), 1)
    if trees * 2 ** (depth_cap(size) + 1) > MAX_MODEL_CELLS:
        raise ValueError(f"{trees} trees over samples of {size} rows are too large a model")
    if rows == 0:
        return ForestModel(pd.DataFrame(columns=NODE_COLUMNS), features, size)
    medians, moments = feature_statistics(df, features, rows=rows, small=small)
    moments = _rounded(moments) if standardize else {}
    samples = tree_samples(df, rows, features, trees=trees, size=size, seed=seed, key=key)
    ready = scale_features(fill_features(samples, medians), moments)
    nodes = grow_forest(ready, features, size, seed).toPandas()  # bounded by parameters
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    return ForestModel(nodes, features, size, medians, moments)


def score_and_flag(
    model: ForestModel, df: DataFrame, contamination: float, rows: int, small: int = SMALL_GROUP
) -> DataFrame:
    """Score a table once with a grown forest, set its threshold, and flag the given share.

    Raw scores are written to a stage, since scoring is the dear step; the threshold is
    an exact quantile over that one column, and the flags are a projection.
    """
    if rows == 0:
        empty = df.withColumn("raw_score", F.lit(None).cast("double"))
        return flag_scores(empty, 0.0).drop("raw_score")
    scored = materialize(model.with_raw_score(df), "scored")
    model.threshold = score_threshold(scored, contamination, rows=rows, small=small)
    return flag_scores(scored, model.threshold).drop("raw_score")


def fit_and_score(
    df: DataFrame, contamination: float = S.CONTAMINATION, **options
) -> tuple[ForestModel, DataFrame]:
    """Fit on a stored table, score it, and flag the given share of its rows."""
    rows = options.pop("rows", None)
    rows = df.count() if rows is None else rows
    model = fit_trees(df, rows=rows, **options)
    small = options.get("small", SMALL_GROUP)
    return model, score_and_flag(model, df, contamination, rows, small)


def fit_forest(
    df: DataFrame, contamination: float = S.CONTAMINATION, *, rows: int | None = None, **options
) -> ForestModel:
    """Fit on a stored table, for scoring other rows; only the scores are written."""
    rows = df.count() if rows is None else rows
    model = fit_trees(df, rows=rows, **options)
    if rows:
        inputs = df.select(*model.features)
        scores = materialize(model.with_raw_score(inputs).select("raw_score"), "scores")
        small = options.get("small", SMALL_GROUP)
        model.threshold = score_threshold(scores, contamination, rows=rows, small=small)
    return model


def detect_anomalies(
    df: DataFrame, contamination: float = S.CONTAMINATION, **options
) -> DataFrame:
    """The table with ``anomaly_score`` (lower is more unusual) and ``is_anomaly``."""
    return fit_and_score(df, contamination, **options)[1]
