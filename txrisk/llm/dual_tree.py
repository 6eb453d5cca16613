"""Vector codes by Lloyd's rounds on two trees, in whole numbers.

Vectors are cut into parts; each part position has a codebook. For each position, a tree
over some thousand parts (a block) and a tree over the codebook's entries are walked
together. A pair of nodes, one of each tree, has a least and a greatest distance between
their boxes: a pair is dropped when it is farther at best than another pair of the same
parts at worst. A node of parts that is left with one entry is assigned whole, by its stored
sum and count. Leaves that keep several entries are settled part by part, by exact
distances of whole numbers, ties to the smaller index. Bounds are whole numbers too and
are dropped only when strictly farther, so the result is that of comparing everything.

Blocks and their trees are built once and written; a round reads them, and sends one row
for each entry and task that met it to be summed. The driver holds only codebooks, whose
size is set by parameters.

Cases: vectors that are null, or hold null or non-finite components, are left out. The
length of vectors is that of the first one kept, by vec_id (nulls last), then content;
vectors of another length are left out too. Components of 4096 and more, in absolute value,
raise. Where the length is no multiple of the parts, the first parts are one longer. Repeated
rows count as often as they occur, equal ids are ordered by content. With fewer vectors than
entries, the codebook has fewer; equal entries are all kept, and the first is used. An empty
table gives no rows. Other columns are not read.
"""

import hashlib
import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txrisk.llm.tables import read, settle, spread

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK_CELLS = 1 << 18  # components of a block: 4,096 vectors of 64
LEAF = 16  # parts of a leaf, at most
LIMIT = 1 << 24  # of a component: squares, summed and numbered, stay below 2^63


# ---------------------------------------------------------------- trees in numpy


@dataclass
class Tree:
    """Points in the order of a complete binary tree; each level's nodes are ranges of it.

    ``lo``, ``hi`` and ``sums`` hold one row a node, level after level."""

    order: np.ndarray
    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    sums: np.ndarray
    bounds: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.bounds) - 1

    def box(self, level: int, nodes: np.ndarray):
        at = (1 << level) - 1 + nodes
        return self.lo[at], self.hi[at]


def level_bounds(n: int, depth: int) -> list[np.ndarray]:
    """Where the nodes of each level begin and end: halves of those above."""
    found = [np.array([0, n])]
    for _ in range(depth):
        above = found[-1]
        halves = (above[:-1] + above[1:]) // 2
        below = np.empty(2 * len(above) - 1, np.int64)
        below[::2], below[1::2] = above, halves
        found.append(below)
    return found


def depth_for(n: int, leaf: int) -> int:
    """Levels below the root, so that no leaf is empty and few hold more than ``leaf``."""
    return max(n // leaf, 1).bit_length() - 1


def build(points: np.ndarray, leaf: int) -> Tree:
    """A tree whose nodes are halved along the axis on which they are widest."""
    n = len(points)
    bounds = level_bounds(n, depth_for(n, leaf))
    order, held = np.arange(n), points
    lo, hi, sums = [], [], []
    for level, b in enumerate(bounds):
        lo.append(np.minimum.reduceat(held, b[:-1], axis=0))
        hi.append(np.maximum.reduceat(held, b[:-1], axis=0))
        sums.append(np.add.reduceat(held, b[:-1], axis=0))
        if level < len(bounds) - 1 and points.shape[1]:
            node = np.repeat(np.arange(len(b) - 1), np.diff(b))
            widest = (hi[-1] - lo[-1]).argmax(axis=1)
            sort = np.lexsort((held[np.arange(n), widest[node]], node))
            order, held = order[sort], held[sort]
    return Tree(order, held, *(np.concatenate(x) for x in (lo, hi, sums)), bounds)


def pack(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    named = {}
    for i, t in enumerate(trees):
        named |= {f"o{i}": t.order.astype(np.int32), f"p{i}": t.points.astype(np.int32)}
        named |= {f"l{i}": t.lo.astype(np.int32), f"h{i}": t.hi.astype(np.int32), f"s{i}": t.sums}
    np.savez(out, **named)
    return out.getvalue()


def unpack(data: bytes, parts: int) -> list[Tree]:
    out = []
    with np.load(io.BytesIO(data)) as held:
        for i in range(parts):
            order, *cells = (held[f"{k}{i}"].astype(np.int64) for k in "oplhs")
            depth = len(cells[1]).bit_length() - 1
            out.append(Tree(order, *cells, level_bounds(len(order), depth)))
    return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of many ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def assign(tree: Tree, entries: np.ndarray, index: Tree):
    """Nearest entry of each point, in tree order, with the counts and sums of each entry.

    ``index`` is the tree over ``entries``. Also returned: how many points were assigned
    with a whole node."""
    k = len(entries)
    codes = np.zeros(len(tree.points), np.int64)
    counts, sums = np.zeros(k, np.int64), np.zeros(entries.shape, np.int64)
    whole = 0
    q, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    q_level = e_level = 0
    while len(q):
        (q_lo, q_hi), (e_lo, e_hi) = tree.box(q_level, q), index.box(e_level, e)
        gap = np.maximum(np.maximum(e_lo - q_hi, q_lo - e_hi), 0)
        reach = np.maximum(np.abs(q_hi - e_lo), np.abs(e_hi - q_lo))
        least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        size = np.diff(np.r_[first, len(q)])
        near = least <= np.repeat(np.minimum.reduceat(most, first), size)
        q, e = q[near], e[near]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        size = np.diff(np.r_[first, len(q)])
        b, held = index.bounds[e_level], tree.bounds[q_level]
        alone = (size == 1) & (np.diff(b)[e[first]] == 1)
        done, entry = q[first[alone]], index.order[b[e[first[alone]]]]
        if len(done):
            n = np.diff(held)[done]
            np.add.at(counts, entry, n)
            np.add.at(sums, entry, tree.sums[(1 << q_level) - 1 + done])
            codes[ragged(held[done], n)] = np.repeat(entry, n)
            whole += int(n.sum())
        rest = ~np.repeat(alone, size)
        q, e = q[rest], e[rest]
        split_q, split_e = q_level < tree.depth, e_level < index.depth
        if not split_q and not split_e:
            break
        if split_e:
            q, e, e_level = np.repeat(q, 2), np.repeat(2 * e, 2), e_level + 1
            e[1::2] += 1
        if split_q:
            q, e, q_level = np.r_[2 * q, 2 * q + 1], np.r_[e, e], q_level + 1
            sort = np.argsort(q, kind="stable")
            q, e = q[sort], e[sort]
    if len(q):
        # uncertain leaves: every point against the entries its leaf is left with
        b, held = index.bounds[e_level], tree.bounds[q_level]
        n = np.diff(b)[e]
        entry, leaf = index.order[ragged(b[e], n)], np.repeat(q, n)
        n = np.diff(held)[leaf]
        point, entry = ragged(held[leaf], n), np.repeat(entry, n)
        off = tree.points[point] - entries[entry]
        best = np.full(len(codes), np.iinfo(np.int64).max)
        np.minimum.at(best, point, (off * off).sum(axis=1) * k + entry)
        open_ = np.unique(point)
        codes[open_] = best[open_] % k
        counts += np.bincount(codes[open_], minlength=k)
        np.add.at(sums, codes[open_], tree.points[open_])
    return codes, counts, sums, whole


# ---------------------------------------------------------------- on Spark


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that take part, in doubles."""
    x = F.col("embedding").cast("array<double>")
    infinite = F.lit(float("inf"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    named = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", x.alias("vector"))
    return named.where(x.isNotNull() & good)


def part_bounds(dims: int, parts: int) -> np.ndarray:
    sizes = np.full(parts, dims // parts)
    sizes[: dims % parts] += 1
    return np.r_[0, np.cumsum(sizes)]


def whole(vectors: list, scale: int) -> np.ndarray:
    x = np.floor(np.array(vectors, np.float64) * scale)
    if x.size and np.abs(x).max() >= LIMIT:
        raise ValueError(f"a component is {LIMIT // scale} or more, too large for exact sums")
    return x.astype(np.int64)


def blocks(vectors: DataFrame, dims: int, parts: int, scale: int) -> DataFrame:
    """The table of blocks: ids and labels of some vectors, and a tree for each position."""
    cut = part_bounds(dims, parts)
    most = max(BLOCK_CELLS // max(dims, 1), 1)
    kind = T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("labels", T.ArrayType(vectors.schema["label"].dataType)),
            T.StructField("trees", T.BinaryType()),
        ]
    )

    def run(batches):
        arrow = to_arrow_schema(kind)

        def block(held):
            x = whole(held.column("vector").to_pylist(), scale)
            trees = [build(x[:, a:b], LEAF) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            row = {c: [held.column(n).to_pylist()] for c, n in (("ids", "vec_id"), ("labels", "label"))}
            return pa.RecordBatch.from_pydict({**row, "trees": [pack(trees)]}, schema=arrow)

        held = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            held = some if held is None else pa.concat_tables([held, some])
            while len(held) >= most:
                yield block(held.slice(0, most))
                held = held.slice(most)
        if held is not None and len(held):
            yield block(held)

    return spread(vectors).mapInArrow(run, kind)


def partial_sums(table: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """Count and sum of the parts nearest to each entry: one row a task, position and entry."""
    kind = T.StructType.fromDDL("position int, entry int, n bigint, total array<bigint>")

    def run(batches):
        indexes = [build(c, 1) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        for batch in batches:
            for data in batch.column("trees"):
                for i, tree in enumerate(unpack(data.as_py(), len(codebooks))):
                    _, n, s, _ = assign(tree, codebooks[i], indexes[i])
                    counts[i] += n
                    sums[i] += s
        met = [(i, j) for i, n in enumerate(counts) for j in np.flatnonzero(n).tolist()]
        out = {
            "position": [i for i, _ in met],
            "entry": [j for _, j in met],
            "n": [int(counts[i][j]) for i, j in met],
            "total": [sums[i][j].tolist() for i, j in met],
        }
        yield pa.RecordBatch.from_pydict(out, schema=to_arrow_schema(kind))

    return table.select("trees").mapInArrow(run, kind)


def next_codebooks(table: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round: each entry becomes the floor of the mean of its parts; unused ones stay."""
    found = partial_sums(table, codebooks)
    counts = found.groupBy("position", "entry").agg(F.sum("n").alias("n"))
    each = found.select("position", "entry", F.posexplode("total").alias("at", "x"))
    # decimals: the sum over a large table may pass 2^63
    totals = each.groupBy("position", "entry", "at").agg(
        F.sum(F.col("x").cast("decimal(28,0)")).alias("x")
    )
    rows = totals.join(counts, ["position", "entry"]).collect()  # one a component of a codebook
    made = [c.copy() for c in codebooks]
    for r in rows:
        made[r.position][r.entry, r.at] = int(r.x) // r.n
    return made


def code_schema(label: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("label", label),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
            T.StructField("error", T.LongType()),
        ]
    )


def encoded(table: DataFrame, codebooks: list[np.ndarray], label: T.DataType) -> DataFrame:
    """vec_id, label, ``codes`` (indexes in part order) and ``error`` of each vector."""
    kind = code_schema(label)

    def run(batches):
        indexes, arrow = [build(c, 1) for c in codebooks], to_arrow_schema(kind)
        for batch in batches:
            for row in batch.to_pylist():
                ids = row["ids"]
                codes = np.zeros((len(ids), len(codebooks)), np.int64)
                error = np.zeros(len(ids), np.int64)
                for i, tree in enumerate(unpack(row["trees"], len(codebooks))):
                    own = assign(tree, codebooks[i], indexes[i])[0]
                    off = tree.points - codebooks[i][own]
                    codes[tree.order, i] = own
                    error[tree.order] += (off * off).sum(axis=1)
                out = {"vec_id": ids, "label": row["labels"], "codes": codes.tolist(), "error": error}
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return table.mapInArrow(run, kind)


def fit(vectors: DataFrame, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """(blocks, codebooks) after ``rounds`` rounds over the usable ``vectors``; None when
    there are none."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector")
    head = first.limit(1).collect()
    if not head:
        return None
    dims = len(head[0].vector)
    vectors = vectors.where(F.size("vector") == dims)
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    start = whole([r.vector for r in vectors.orderBy(*order).limit(entries).collect()], scale)
    cut = part_bounds(dims, parts)
    codebooks = [start[:, a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    table = settle(blocks(vectors, dims, parts, scale), "blocks")
    for _ in range(rounds):
        codebooks = next_codebooks(table, codebooks)
    return table, codebooks


def compress(vectors: DataFrame, **options) -> tuple[DataFrame, list[np.ndarray]]:
    """The codes and error of each usable vector (written), and the codebooks."""
    label = vectors.schema["label"].dataType
    fitted = fit(usable(vectors), **options)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], code_schema(label)), []
    table, codebooks = fitted
    return settle(encoded(table, codebooks, label), "codes"), codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    text = ",".join(str(x) for c in codebooks for x in c.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = compress(read(spark, sf_dir, "embeddings"))
    by_label = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "_label")
    hexes = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id",
        F.array_join(hexes, "").alias("code"),
        "error",
        "label_error",
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )


def _sql() -> str:
    """The rounds one after the other, all entries compared."""
    out = f"""
WITH kept AS (SELECT vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x
  FROM kept, range({PARTS}) AS r(part)),
cells AS MATERIALIZED (SELECT vec_id, part, generate_subscripts(x, 1) AS pos, unnest(x) AS x FROM p),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS MATERIALIZED (SELECT part, entry, x FROM p JOIN first USING (vec_id))"""
    near = """
n{r} AS MATERIALIZED (SELECT vec_id, label, part, arg_min(entry, d * {k} + entry) AS entry, min(d) AS d FROM (
  SELECT p.vec_id, p.label, p.part, b.entry,
    list_sum([CAST((p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) AS BIGINT) FOR i IN range(1, len(p.x) + 1)]) AS d
  FROM p JOIN b{r} b USING (part)) GROUP BY vec_id, label, part)"""
    for r in range(ROUNDS + 1):
        out += "," + near.format(r=r, k=ENTRIES)
        if r < ROUNDS:
            out += f""",
m{r} AS (SELECT part, entry, pos, CAST(floor_div AS BIGINT) AS x FROM (
  SELECT part, entry, pos, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS floor_div
  FROM n{r} JOIN cells USING (vec_id, part) GROUP BY part, entry, pos)),
b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
  SELECT part, entry, list(x ORDER BY pos) AS x FROM m{r} GROUP BY part, entry) m
  ON m.part = b.part AND m.entry = b.entry)"""
    return out + f""",
coded AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
  CAST(sum(d) AS BIGINT) AS error FROM n{ROUNDS} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  h AS codebooks_sha256 FROM coded, books"""


SQL = _sql()
