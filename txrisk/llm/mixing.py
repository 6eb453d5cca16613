"""Mixing sources to target weights by systematic sampling.

Each source gets a share of all words by its weight, at most ``most`` times its own words;
what a source cannot take goes to the others by weight. Every document of a source then
expects the same number of copies. The copies expected are summed along the documents of
the source, from a random start, and a document is taken once for each whole number that
the running sum crosses on it. The documents stand in order of size, so that the words
taken differ from the target by no more than about two of the source's longest documents.

No source is sorted in one task. Sizes and keys, a few bytes a document, are dealt by range
over all tasks, so a source of a third of all rows lies in a third of the parts; sums of
parts are summed by source, and each part counts on from where the ones before it end.

Cases: a null text has size 0; a null source is a source, and the last; a source without
words has target 0 and takes nothing; empty texts are taken, and count no words. Rows that
are the same in id, size and text are interchangeable and each gets its own copies. Equal
sizes are ordered by a hash of id and text. Other columns are not read. A very long text is
counted where it lies. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.functions import hashing as H
from txrisk.llm.tables import read, settle

MOST = 3  # copies of one document, and words of a source taken per word it has
SEED = 42
UNITS = 1 << 24  # of one copy: expected copies are whole numbers of these, so sums are exact
WEIGHTS = (1, 2, 3)  # of the registered query, repeating along the sources
PART_ROWS = 2_000_000  # rows of a part of the order
WORD = "[^\\x20\\x09-\\x0D]+"


def null_last(column: str) -> list[Column]:
    return [F.col(column).isNull(), F.col(column)]


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (source, weight, source_size) with the words each should give.

    Shares go by weight; a source stops at ``most`` times its size. Filling all sources to one
    level of words per weight gives the same result as resharing the excess until none is above:
    sources stop in the order of what they can give per weight. Each round sets the level
    from the sources that have not stopped and ends when no more stop, over one row a source.
    """
    can = F.col("source_size") * most
    total, level = None, 0.0
    weight = F.col("weight")
    while True:
        stops = can.cast("double") <= weight * F.lit(level)
        found = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(stops, can).otherwise(0)),
            F.sum(F.when(~stops, weight)),
        ).first()
        total, stopped, open_weight = found
        if not total or open_weight is None:
            break
        now = float(total - stopped) / float(open_weight)
        if now <= level:
            break
        level = now
    target = F.least(can.cast("double"), weight * F.lit(level))
    return sources.withColumn("target", target)


def _ordered(rows: DataFrame, by: list, order: list, parts: int) -> DataFrame:
    """``rows``, dealt by range over ``parts``, with the ``_part`` each lies in; written."""
    dealt = rows.repartitionByRange(parts, *by, *order)
    return settle(dealt.withColumn("_part", F.spark_partition_id()), "ordered")


def running_sum(rows: DataFrame, value: str, order: list, *, part_rows: int = PART_ROWS):
    """``rows`` with ``_upto``: the sum of a whole-number column over the rows of the same
    ``source`` up to this one, in the order of ``order``."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part_rows))
    dealt = _ordered(rows, null_last("source"), order, parts)
    # one row a part and source: their number does not grow with a source's rows
    sums = dealt.groupBy("_part", "source").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("_part").alias("_p"),
        F.col("source").alias("_s"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy("_part", "source").orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    counted = dealt.withColumn("_within", F.sum(value).over(within))
    same = (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))
    joined = counted.join(sums, same)
    return joined.withColumn("_upto", F.col("_before") + F.col("_within")).drop(
        "_part", "_p", "_s", "_before", "_within"
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """What the mix needs of each document: id, source, words, a hash of id and text, and a
    number of its own (the column ``row``, if there is one)."""
    key = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit("|"),
        F.coalesce("text", F.lit("")),
    )
    thin = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(key).alias("_key"),
        # tells equal rows apart, so that ranges split them too; fixed once written
        (F.monotonically_increasing_id() if row is None else F.col(row)).alias("_row"),
    )
    return settle(thin, "sized")


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    *,
    rows: DataFrame | None = None,
    most: int = MOST,
    seed: int = SEED,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Each document (doc_id, source, size) with its source's size and target, and the
    ``copies`` the mix takes of it: at most ``most``, rounded up.

    ``weights`` has the columns source and weight (whole numbers above zero), one row a source;
    ``rows`` is ``sized(docs)``, if at hand. Sources without a weight are left out.
    """
    rows = sized(docs) if rows is None else rows
    sizes = source_sizes(rows).withColumnRenamed("source", "_s")
    known = weights.join(sizes, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    known = settle(known, "sources")
    planned = targets(known, most)
    # a whole number of units, and so never above ``most`` copies
    rate = F.floor(F.col("target") / F.col("source_size") * F.lit(float(UNITS)))
    seeded = F.concat(F.lit("source|"), F.coalesce("source", F.lit("null|")))
    start = H.word(H.digest(seeded, seed), 0) % UNITS
    planned = planned.select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, rate).otherwise(0).cast("bigint").alias("_expected"),
        start.alias("_start"),
    )
    expecting = rows.join(planned, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    order = [F.col("size"), F.col("_key"), F.col("_row")]
    summed = running_sum(expecting, "_expected", order, part_rows=part_rows)
    crossed = F.expr(
        f"(_upto + _start) div {UNITS} - (_upto + _start - _expected) div {UNITS}"
    )
    return summed.select(
        "doc_id", "source", "size", "source_size", "target", crossed.alias("copies"), "_row"
    )


def take(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """The mixed table itself: the columns of ``docs``, each row as often as the mix takes it.

    The documents are written once with a number each, by which rows are found again."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    numbered = settle(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    mixed = mix(docs, weights, rows=sized(numbered, name), **options)
    chosen = mixed.where("copies > 0").select(F.col("_row").alias(name), "copies")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    joined = numbered.join(chosen.withColumn(name + "_copy", times).drop("copies"), name)
    return joined.select(*docs.columns)


def repeating_weights(rows: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The sources in code point order, null last, with weights that repeat: one row a source.

    A source's place is counted by ranges like that of a document."""
    names = rows.select("source").distinct().withColumns({"_all": F.lit(1).cast("bigint")})
    named = names.select(F.col("source").alias("_name"), "_all", F.lit("").alias("source"))
    place = running_sum(named, "_all", null_last("_name"))
    pick = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("_upto") - 1) % len(weights) + 1).cast("int")
    )
    return place.select(F.col("_name").alias("source"), pick.cast("bigint").alias("weight"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = sized(docs)
    mixed = mix(docs, repeating_weights(rows), rows=rows)
    taken = F.col("copies") * F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
  WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS w FROM sizes),
-- sources stop in the order of what they can give per weight: the level with the first j stopped
ranked AS (SELECT *, row_number() OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST) AS j,
  CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS all_w FROM weighed),
levels AS (SELECT *, CAST(total - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
  / CAST(all_w - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level FROM ranked
  WINDOW before AS (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT level FROM levels WHERE CAST(3 * source_size AS DOUBLE) > w * level ORDER BY j LIMIT 1),
planned AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * level) AS target,
  CAST('0x' || substr(md5('{SEED}|source|' || coalesce(source, 'null|')), 1, 13) AS BIGINT) % {UNITS} AS start
  FROM weighed, found),
expecting AS (SELECT s.*, p.source_size, p.target, p.start, CASE WHEN p.source_size > 0 THEN
  CAST(floor(p.target / p.source_size * CAST({UNITS} AS DOUBLE)) AS BIGINT) ELSE 0 END AS e
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
summed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, k) * e + start AS upto FROM expecting)
SELECT doc_id, size, source_size, target,
  CAST((upto // {UNITS} - (upto - e) // {UNITS}) * size AS BIGINT) AS taken FROM summed
"""
