"""What the operators of this subpackage share: which columns they read, how many parts
they cut their work into."""

import gc
import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from txrisk.sources.stages import materialize

SLICE_ROWS = 500  # rows that Python holds as objects at a time


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df``, written and read again, with the shuffle files it was made from let go: Spark
    drops those of results that nothing refers to, once the driver has collected garbage."""
    out = materialize(df, name)
    del df
    gc.collect()
    context = out.sparkSession.sparkContext
    # a thread of Python's tells the JVM what was let go, within a second or so
    queue = getattr(context._gateway._gateway_client, "finalizer_deque", None)
    for _ in range(30):
        if not queue:
            break
        time.sleep(0.1)
    time.sleep(0.1)
    context._jvm.System.gc()
    return out


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """The id and text of each document, whatever other columns ``docs`` has. A missing
    text counts as empty; one row comes out for each row that goes in."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def parts_for(docs: DataFrame, part_chars: int) -> int:
    """How many parts of about ``part_chars`` characters the texts make, at least one for
    each core: from one aggregate over all rows."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(math.ceil(chars / part_chars), min(cores, 1 + chars // 100_000))


def names_of(schema: str) -> list[str]:
    return StructType.fromDDL(schema).names


def map_slices(rows: DataFrame, start: Callable[[], Callable], schema: str | StructType) -> DataFrame:
    """``rows`` through a function of whole numbers, strings and lists, with None for missing.

    ``start`` is called once for each partition and returns the function, which takes the
    columns of some rows as a dictionary of lists and returns, or yields, the same of the
    result."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, arrow = start(), to_arrow_schema(kind)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                made = work(batch.slice(a, SLICE_ROWS).to_pydict())
                for out in [made] if isinstance(made, dict) else made:
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return rows.mapInArrow(run, kind)


def filter_rows(rows: DataFrame, start: Callable[[], Callable]) -> DataFrame:
    """``rows`` whose text a function keeps, all columns as they are. ``start`` returns a
    function from a list of texts to a list of yes and no."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = start()
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(a, SLICE_ROWS)
                yield some.filter(pa.array(keep(some.column("text").to_pylist()), pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def replace_texts(rows: DataFrame, work: Callable[[str], str]) -> DataFrame:
    """``rows`` with ``work`` applied to each text that is there, other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kind = batch.schema.get_field_index("text"), batch.schema.field("text")
            for a in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(a, SLICE_ROWS)
                texts = [t if t is None else work(t) for t in some.column(at).to_pylist()]
                yield some.set_column(at, kind, pa.array(texts, kind.type))

    return rows.mapInArrow(run, rows.schema)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` as they are when they already lie in enough partitions to use the cluster,
    else dealt out evenly."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
