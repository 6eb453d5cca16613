"""Nearest neighbours by cosine from randomly rotated one-bit codes.

The index turns every vector to unit length, rotates it at random into ``bits`` dimensions
and keeps the signs, packed, with one correction scalar: the inner product of the rotated
vector with its own code. The inner product with a rotated query, divided by that scalar,
is an unbiased estimate of the cosine, and its error is bounded, but for rare rotations,
by ``BOUND`` * sqrt(1 - f^2) / (f * sqrt(bits - 1)) for the scalar f. A vector is reranked
with its full numbers only if its estimate plus its error bound reaches the k-th best
cosine found so far.

Queries and candidates are dealt by hash to blocks of bounded size, and each pair of blocks
is one task, which returns k rows a query. Of vectors with the same numbers only the k + 1
smallest ids can be an answer, so others are left out before blocks are made; a vector that a
third of all rows share costs k + 1 candidates.

Cases: vectors that are missing, zero, or hold missing or non-finite numbers take no part,
nor do rows without vec_id; rows with one vec_id count once (the least vector); vectors of
different lengths never meet; ties go to the smaller vec_id; a query with fewer candidates
returns all; an empty table gives no rows; other columns are not read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm import tables
from txrisk.sources.stages import materialize

BITS_PER_DIMENSION = 4
BOUND = 3.0
BASE_BLOCK, QUERY_BLOCK, AT_ONCE = 8192, 1024, 256
SEED = 20240
OUT = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, one for each vec_id."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("vector"))
    v = F.col("vector")
    some = F.exists(v, lambda x: x != 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(v.isNotNull() & F.col("vec_id").isNotNull()).filter(finite & some)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def rotation(dims: int, bits: int) -> np.ndarray:
    """A random matrix (bits x dims) with orthonormal columns, the same in every task."""
    made = np.random.default_rng([SEED, dims, bits]).normal(size=(bits, dims))
    q, r = np.linalg.qr(made)
    return q * np.sign(np.diag(r))


def stacked(vectors) -> np.ndarray:
    """Vectors as rows, each scaled by a power of two so that squares don't overflow; no
    cosine changes by that, not in its last bit."""
    x = np.stack(vectors.tolist())
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated rows, and their correction scalars."""
    turned = unit(x) @ rotation(x.shape[1], bits).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(bits)


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query, the same for equal rows wherever they stand."""
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _search(ids, x, codes, factor, query_ids, queries, k: int, bits: int) -> list[tuple]:
    """The k nearest of a block for each query, by estimate, bound and rerank."""
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    factor = np.clip(factor, 1e-6, 1.0)
    error = BOUND * np.sqrt(np.maximum(1 - factor**2, 0)) / (factor * np.sqrt(max(bits - 1, 1)))
    turned = (unit(queries) @ rotation(x.shape[1], bits).T).astype(np.float32)
    out = []
    for a in range(0, len(queries), AT_ONCE):
        estimate = signs @ turned[a : a + AT_ONCE].T / np.float32(np.sqrt(bits))
        estimate = estimate / factor[:, None].astype(np.float32)
        for i in range(estimate.shape[1]):
            own, query = query_ids[a + i], queries[a + i]
            guess = np.where(ids == own, -np.inf, estimate[:, i])
            n = min(k, len(ids))
            first = np.argpartition(-guess, n - 1)[:n]
            least = -np.inf
            if n == k and np.isfinite(guess[first]).all():
                least = cosines(x[first], query).min() - 1e-5
            near = np.flatnonzero((guess + error >= least) & (ids != own))
            score = cosines(x[near], query)
            best = np.lexsort((ids[near], -score))[:k]
            out += zip([own] * len(best), ids[near[best]], score[best], strict=True)
    return out


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    bits: int | None = None,
    base_block: int = BASE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` vectors nearest to each query (both
    tables: vec_id, embedding), a query's own vec_id left out."""
    rows = materialize(usable(vectors), "vectors")
    copies = Window.partitionBy("vector").orderBy("vec_id")
    base = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)

    def index(batches):
        for batch in batches:
            out = batch.assign(code=b"", factor=0.0)
            for _, own in batch.groupby(batch["vector"].map(len)):
                x = stacked(own["vector"])
                codes, factor = encode(x, bits or BITS_PER_DIMENSION * x.shape[1])
                out.loc[own.index, "code"] = [c.tobytes() for c in codes]
                out.loc[own.index, "factor"] = factor
            yield out

    held = materialize(
        base.drop("copy").mapInPandas(
            index, "vec_id bigint, vector array<double>, code binary, factor double"
        ),
        "codes",
    )
    asked = materialize(usable(queries), "queries")
    n_base = max(1, -(-held.count() // base_block))
    n_query = max(1, -(-asked.count() // query_block))
    dims = F.size("vector").alias("dims")

    def dealt(table, own, blocks, other, others):
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return table.select("*", dims, block.cast("int").alias(own), copies)

    cells = ["dims", "base", "query"]
    left = dealt(held, "base", n_base, "query", n_query).groupBy(*cells)
    right = dealt(asked, "query", n_query, "base", n_base).groupBy(*cells)

    def search(key: tuple, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asking):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        x = stacked(own["vector"])
        width = bits or BITS_PER_DIMENSION * x.shape[1]
        codes = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1)
        found = _search(
            own["vec_id"].to_numpy(),
            x,
            codes,
            own["factor"].to_numpy(),
            asking["vec_id"].to_numpy(),
            stacked(asking["vector"]),
            k,
            width,
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInPandas(search, OUT)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = tables.read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))
