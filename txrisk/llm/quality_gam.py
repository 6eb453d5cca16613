"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a fixed list of counts and shares. The model holds one lookup table for
each feature and one for each chosen pair of features, over bins; a score is the sum of a
text's bin entries, through the logistic function. Tables are learned by cyclic boosting:
round after round, each feature in turn gets a shallow tree fitted to the gradient of
the moment, damped, and added to its table. Pairs are picked by the gain of one further
tree over both features, then boosted the same way.

Fitting uses at most ``FIT_ROWS`` labelled rows, those whose ids have the least hashes.
Everything else covers all rows: features are made once, written, and scored from there.

Cases: a missing or empty text has features of zero and a score like any other; a missing
doc_id is scored, never held out, never used for fitting; labels that are missing are not
used, several labels of one document are averaged; repeated rows are scored each; with no
usable label every score is 1, since nothing speaks against a text; an empty table gives
no rows; columns other than doc_id and text are not read.
"""

import itertools
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import tables
from txrisk.sources.stages import materialize

FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 150, 60, 0.1, 3
RIDGE, LEAST_HESSIAN = 1.0, 2.0
HOLD_PARTS, HOLD_PART = 4, 2
ACCEPT = 0.7

FEATURES = (
    "log_chars log_words mean_word sd_word caps_words upper digits symbols marks bangs blanks "
    "non_ascii distinct top_word stutter repeated_lines bars line_words "
    "title_words stop_end"
).split()

# Byte classes counted by one table lookup per byte.
_CLASSES = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": "0123456789",
    "symbols": "#$%&*@^~=+<>\\{}[]",
    "marks": ".,;:?-'\"()",
    "bangs": "!",
    "bars": "|",
    "blanks": " \t\n\r\v\f",
}
_CLASS_OF = np.zeros(256, np.uint8)
_CLASS_OF[128:] = len(_CLASSES) + 1
for _i, _chars in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[[ord(c) for c in _chars]] = _i


def text_features(text: str) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(_CLASS_OF[raw], minlength=len(_CLASSES) + 2) / len(raw)
    share = dict(zip(_CLASSES, counts[1:], strict=False))
    words = text.split()
    n = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    # a word three times in a row; twice happens in good prose
    thrice = sum(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False))
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        float(sizes.mean()),
        float(sizes.std()),
        sum(map(str.isupper, words)) / n,
        share["upper"],
        share["digits"],
        share["symbols"],
        share["marks"],
        share["bangs"],
        share["blanks"],
        counts[-1],
        len(seen) / n**0.8,
        max(seen.values(), default=0) / n,
        thrice / n,
        1 - len(set(lines)) / max(len(lines), 1),
        share["bars"],
        float(np.log1p(n / max(len(lines), 1))),
        sum(map(str.istitle, words)) / n,
        sum(w[-1] in ".!?" for w in words) / n,
    ]


def held_out(doc_id: Column) -> Column:
    part = F.crc32(doc_id.cast("string")) % HOLD_PARTS
    return F.coalesce(part == HOLD_PART, F.lit(False))


def featurize(docs: DataFrame) -> DataFrame:
    """doc_id and the array of features of every document."""

    def rows(some: dict) -> dict:
        return {"doc_id": some["doc_id"], "features": list(map(text_features, some["text"]))}

    texts = tables.spread(tables.texts(docs))
    return tables.map_slices(texts, lambda: rows, "doc_id bigint, features array<double>")


def _leaf(g, h):
    return -g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over ordered bins with these sums of gradient and
    curvature: the value of each bin."""
    spans, values = [(0, len(g))], np.zeros(len(g))
    for _ in range(leaves - 1):
        best = (1e-6, None, None)
        for a, b in spans:
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a : b - 1]), np.cumsum(h[a : b - 1])
            gs, hs = g[a:b].sum(), h[a:b].sum()
            gain = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
            gain[(hl < LEAST_HESSIAN) | (hs - hl < LEAST_HESSIAN)] = 0
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], (a, b), a + i + 1)
        if best[1] is None:
            break
        a, b = best[1]
        spans.remove((a, b))
        spans += [(a, best[2]), (best[2], b)]
    for a, b in spans:
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of one feature with a cut of the other on either side: its gain and
    the value of each cell."""
    found, values = 0.0, np.zeros(g.shape)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for i in range(1, gg.shape[0]):
            out, gain = np.zeros(gg.shape), -_gain(gg.sum(), hh.sum())
            for side in (slice(0, i), slice(i, None)):
                gs, hs = gg[side].sum(0), hh[side].sum(0)
                tree = _tree(gs, hs, 2)
                out[side] = tree
                for v in np.unique(tree):
                    gain += _gain(gs[tree == v].sum(), hs[tree == v].sum())
            if gain > found:
                found, values = gain, out.T if flip else out
    return found, values


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The tables for features ``x`` (a row each) and labels ``y`` between 0 and 1."""
    if not len(y):
        return {"base": None}
    n, width = x.shape
    base = float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5)))
    cuts = [_cuts(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    single, score = [np.zeros(len(c) + 1) for c in cuts], np.full(n, base)

    def slopes():
        p = 1 / (1 + np.exp(-score))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            size = len(single[j])
            tree = RATE * _tree(
                np.bincount(bins[j], g, size), np.bincount(bins[j], h, size), LEAVES
            )
            single[j] += tree
            score += tree[bins[j]]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    cells = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]
    sizes = [len(c) + 1 for c in coarse]

    def grid(values, a, b):
        flat = np.bincount(cells[a] * sizes[b] + cells[b], values, sizes[a] * sizes[b])
        return flat.reshape(sizes[a], sizes[b])

    g, h = slopes()
    gains = [
        (_pair_tree(grid(g, a, b), grid(h, a, b))[0], a, b)
        for a, b in itertools.combinations(range(width), 2)
    ]
    chosen = [(a, b) for _, a, b in sorted(gains, key=lambda t: (-t[0], t[1:]))[:PAIRS]]
    pair = [np.zeros((sizes[a], sizes[b])) for a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(chosen, pair, strict=True):
            g, h = slopes()
            tree = RATE * _pair_tree(grid(g, a, b), grid(h, a, b))[1]
            table += tree
            score += tree[cells[a], cells[b]]
    return {"base": base, "cuts": cuts, "single": single, "coarse": coarse, "pairs": chosen, "pair": pair}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of the rows of ``x``: bin entries added up."""
    if model["base"] is None:
        return np.ones(len(x))
    score = np.full(len(x), model["base"])
    for j, (cuts, table) in enumerate(zip(model["cuts"], model["single"], strict=True)):
        score += table[np.searchsorted(cuts, x[:, j], side="right")]
    cells = {
        j: np.searchsorted(model["coarse"][j], x[:, j], side="right")
        for j in {j for pair in model["pairs"] for j in pair}
    }
    for (a, b), table in zip(model["pairs"], model["pair"], strict=True):
        score += table[cells[a], cells[b]]
    return 1 / (1 + np.exp(-score))


def usable_labels(labels: DataFrame) -> DataFrame:
    """doc_id and label (y) of the labelled documents that are not held out."""
    label = F.avg(F.col("quality").cast("double")).alias("y")
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    usable = usable.filter(~held_out(F.col("doc_id").cast("bigint")))
    return usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(label)


def label_sample(labels: DataFrame, docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id and label (y) of ``fit_rows`` documents of ``docs`` at most. Labels of documents
    that are not there take no place."""
    there = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    each = usable_labels(labels).join(there, "doc_id", "left_semi")
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def train(features: DataFrame, sample: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """A model from the rows of the documents of ``label_sample``, ``fit_rows`` at most."""
    rows = features.join(F.broadcast(sample), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(fit_rows)
    held = rows.select("features", "y").toPandas()
    x = np.array(held["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, held["y"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    features = materialize(featurize(docs), "features")
    model = docs.sparkSession.sparkContext.broadcast(
        train(features, label_sample(labels, docs, fit_rows), fit_rows)
    )

    def score(some: dict) -> dict:
        x = np.array(some["features"], float).reshape(-1, len(FEATURES))
        return {"doc_id": some["doc_id"], "score": predict(model.value, x)}

    scored = tables.map_slices(features, lambda: score, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_accepted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the rows whose text the classifier rejects, all columns as they
    are. Texts are read once for training, by labelled documents only, and once for
    dropping, so no row needs a key."""
    sample = materialize(label_sample(labels, docs, fit_rows), "labelled")
    labelled = tables.texts(docs).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    model = docs.sparkSession.sparkContext.broadcast(
        train(featurize(labelled), sample, fit_rows)
    )

    def keep(texts: list) -> list:
        x = np.array([text_features(t or "") for t in texts], float).reshape(-1, len(FEATURES))
        return (predict(model.value, x) >= ACCEPT).tolist()

    return tables.filter_rows(tables.spread(docs), lambda: keep)


def quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (tables.read(spark, sf_dir, t) for t in ("documents", "labels"))
    return score_quality(docs, labels)
