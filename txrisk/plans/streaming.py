"""Scoring transactions as they arrive, with a model fitted before."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txrisk.operators.forest import ForestModel


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files: int = 100
) -> DataFrame:
    """Rows of the files that appear in a folder, at most ``files`` new ones a batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.format(fmt).load(path)


def score_stream(
    model: ForestModel,
    rows: DataFrame,
    path: str,
    *,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Score a stream of rows and add them to the Parquet table at ``path``.

    Scoring is a map and needs no state. A batch is dealt to all cores first: it is often one
    file, of one row group, which a single task would score. Rows go by a hash of theirs, which
    a task that runs again repeats. ``checkpoint``, a
    shared folder of the query's own, holds which rows were read and which files were
    written: a query that starts again there goes on where the last one ended, and the table
    has each row once. With ``every`` (as "1 minute") the query goes on until it is stopped;
    without, it ends when all rows that are there have been scored.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    told = [c for c, kind in rows.dtypes if "map<" not in kind]  # a map has no hash
    dealt = rows.repartition(cores, F.xxhash64(*told))
    writer = model.score(dealt).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)
