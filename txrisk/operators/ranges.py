"""Running counts over sorted rows, without sorting a group in one task.

Rows are dealt by range, so a group of any size lies in as many parts as it needs; the
counts of parts are summed by group, and each part counts on from where the ones before
it end.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.sources.stages import materialize

PART_ROWS = 1_000_000  # rows that one task sorts at a time


def running_sum(
    df: DataFrame, by, order, rows: int, *, weight: str | None = None, part_rows: int | None = None
) -> DataFrame:
    """``df`` with ``_upto``: the sum of ``weight`` (or the count) over the rows of the same
    ``by`` up to this one, in the order of the columns ``order``.

    ``rows`` is an upper bound of the row count. The order should tell all rows apart, or
    rows that share a place should be interchangeable; ``df`` is read once.
    """
    by, part_rows = list(by), part_rows or PART_ROWS
    amount = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    upto = Window.unboundedPreceding
    parts = max(math.ceil(rows / part_rows), 1)
    if parts == 1:
        within = Window.partitionBy(*by).orderBy(*order).rowsBetween(upto, 0)
        return df.withColumn("_upto", F.sum(amount).over(within))
    dealt = df.repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "dealt")
    # one row a part and group: a group of any size has no more of them than there are parts
    names = [f"_by{i}" for i in range(len(by))]
    sums = dealt.groupBy("_part", *by).agg(F.sum(amount).alias("_sum"))
    sums = sums.toDF("_p", *names, "_sum")
    before = Window.partitionBy(*names).orderBy("_p").rowsBetween(upto, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(upto, 0)
    counted = dealt.withColumn("_within", F.sum(amount).over(within))
    same = [F.col("_part") == F.col("_p")]
    same += [counted[c].eqNullSafe(F.col(k)) for c, k in zip(by, names, strict=True)]
    joined = counted.join(starts, same).withColumn("_upto", F.col("_start") + F.col("_within"))
    return joined.select(*df.columns, "_upto")


def with_first(
    df: DataFrame, n: int, rows: int, name: str, *, part_rows: int | None = None
) -> DataFrame:
    """``df`` with a column that is true on the first ``n`` of its ``rows`` rows, in the order
    of their columns.

    Equal rows are interchangeable; a number of their own, fixed once written, lets ranges
    split them too.
    """
    if n <= 0 or n >= rows:
        return df.withColumn(name, F.lit(n > 0))
    told = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
    counted = running_sum(told, [], [*df.columns, "_tie"], rows, part_rows=part_rows)
    return counted.withColumn(name, F.col("_upto") <= n).select(*df.columns, name)
