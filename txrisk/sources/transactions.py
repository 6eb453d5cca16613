"""Transaction scans and sinks (CSV, Parquet, table)."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk import schema as S
from txrisk.functions import scalars as X
from txrisk.sources.stages import files_at

TABLE = "transactions"
# Quotes are doubled inside quoted fields, in files read and files written.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def _parse(text: Column, kind: T.DataType, lenient: bool) -> Column:
    cast = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.LongType):
        # an integer column with gaps is often written as 34.0
        return cast(cast(F.trim(text), "double"), "bigint")
    if isinstance(kind, T.DoubleType):
        return X.nan_to_null(cast(F.trim(text), "double"))
    return cast(F.trim(text), kind)


def _known_types() -> dict:
    return {**S.COLUMN_TYPES, **S.OPTIONAL_TYPES}


def _fits(misfit: Column, first: Column, width: int) -> Column:
    """True, or an error for a row with more fields than the header has. ``misfit`` is the
    text of rows with too many or too few; a scan must read another column (``first``) too."""
    fields = ", ".join(f"c{i} string" for i in range(width))
    # an end mark put behind a shorter row is among the header's fields
    marked = F.from_csv(F.concat(misfit, F.lit(",\u0002")), fields, {"quote": '"', "escape": '"'})
    ended = F.array_contains(F.array(*[F.coalesce(marked[f"c{i}"], F.lit("")) for i in range(width)]), "\u0002")
    says = F.lit("more fields than the header has, in the row that begins with %s: %s")
    error = F.raise_error(F.printf(says, first, misfit))
    return F.when(misfit.isNotNull() & ~ended, error.cast("boolean")).otherwise(F.lit(True))


def _read_csv(spark, path, na_values, lenient, corrupt_column, multi_line) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    names = reader.csv(path).columns  # reads one header line; every column is text
    bad = corrupt_column or "_misfit"
    fields = [T.StructField(c, T.StringType()) for c in [*names, bad]]
    text = (
        reader.schema(T.StructType(fields))
        .option("enforceSchema", False)  # every file's header must be this one
        .option("columnNameOfCorruptRecord", bad)
        .option("columnPruning", False)  # else unread fields aren't counted
        .csv(path)
    )
    if not lenient:
        text = text.where(_fits(F.col(bad), F.col(names[0]), len(names)))
    kinds = _known_types()
    cols = [
        _parse(X.na_to_null(F.col(c), na_values), kinds.get(c, T.StringType()), lenient).alias(c)
        for c in names
    ]
    return text.select(*cols, *([corrupt_column] if corrupt_column else []))


def normalize(df: DataFrame) -> DataFrame:
    """Give known columns their types and turn NaN into null."""
    kinds = _known_types()
    cols = []
    for field in df.schema.fields:
        col, kind = F.col(field.name), kinds.get(field.name, field.dataType)
        if field.dataType != kind:
            col = col.cast(kind)
        if isinstance(kind, T.DoubleType):
            col = X.nan_to_null(col)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def read_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    *,
    na_values=X.NA_VALUES,
    lenient: bool = False,
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan raw transactions with fixed types and one null rule.

    CSV columns are found by header name; files of a folder must share one header, else the
    scan raises. Missing-value words become null in every column. Text that is no number
    or date raises, or becomes null when ``lenient``. A row with more fields than the header
    raises, or loses them when ``lenient``; in a row with fewer, the last columns are null.
    ``corrupt_column`` adds a column with the text of rows that do not fit the header.
    """
    if fmt == "csv":
        df = _read_csv(spark, path, na_values, lenient, corrupt_column, multi_line)
    else:
        df = normalize(spark.read.format(fmt).load(path))
    S.check_columns(df, S.REQUIRED)
    return df


def _restore(spark: SparkSession, path: str) -> None:
    """Put back a table that a writer, lost in the middle of a swap, had moved aside."""
    files, folder = files_at(spark, path)
    if not files.exists(folder):
        aside = files.globStatus(files_at(spark, f"{path}.old-*")[1])
        if aside:
            files.rename(max((s.getPath() for s in aside), key=str), folder)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Put what ``write`` writes in place of the folder ``path``, whole or not at all.

    It is written beside the folder and takes its place by a rename once it is complete, so a
    write that fails leaves the old content, and rows read from the folder itself can be
    written to it. One writer at a time; a swap that was cut short is undone by the next one.
    """
    path = path.rstrip("/")
    _restore(spark, path)
    mark = uuid.uuid4().hex[:12]
    files, folder = files_at(spark, path)
    _, new = files_at(spark, f"{path}.new-{mark}")
    _, old = files_at(spark, f"{path}.old-{mark}")
    try:
        write(new.toString())
        if files.exists(folder):
            files.rename(folder, old)
        if files.exists(folder) or not files.rename(new, folder):
            raise OSError(f"cannot put the new table in place of {path}")
    except BaseException:
        _restore(spark, path)
        files.delete(new, True)
        raise
    files.delete(old, True)


def write_transactions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table, replacing what is there in one step. Dates become ISO text in CSV files."""
    if fmt == "csv":
        text = {
            f.name: X.iso_text(F.col(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
        }
        df = df.withColumns(text) if text else df
    options = CSV_OPTIONS if fmt == "csv" else {}
    replace_folder(
        df.sparkSession, path, lambda aside: df.write.options(**options).format(fmt).save(aside)
    )


def load_table(df: DataFrame, name: str = TABLE, path: str | None = None) -> DataFrame:
    """Replace table ``name``: a view over ``df``, or over Parquet written by month.

    Rows are rebalanced by month before the write: adaptive execution splits a large
    month over several tasks and joins small ones, so files are even and few. The old files
    stay until the new ones are complete.
    """
    if path is not None:
        spark = df.sparkSession
        by_month = df.withColumn("month", X.month_text(F.col("transaction_date")))
        writer = by_month.hint("rebalance", "month").write.partitionBy("month")
        replace_folder(spark, path, writer.parquet)
        fields = [f for f in df.schema.fields if f.name != "month"]
        kept = T.StructType([*fields, T.StructField("month", T.StringType())])
        df = spark.read.schema(kept).parquet(path)
    df.createOrReplaceTempView(name)
    return df


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a finished dataset stands at ``path``; raises at an unfinished one."""
    _restore(spark, path.rstrip("/"))
    files, folder = files_at(spark, path)
    if not files.exists(folder):
        return False
    if files.getFileStatus(folder).isFile() or files.exists(files_at(spark, f"{path}/_SUCCESS")[1]):
        return True
    raise ValueError(f"{path} holds no finished dataset")


def load_or_build(
    spark: SparkSession,
    path: str,
    builder: Callable[[], DataFrame],
    fmt: str = "parquet",
) -> DataFrame:
    """Read the dataset stored at ``path``; when there is none, build and store it.

    A folder counts as stored once its writer has finished, which leaves ``_SUCCESS``; one
    that a writer left behind, or is still filling, raises and is not touched.
    """
    if not _finished(spark, path):
        write_transactions(builder(), path, fmt)
    return read_transactions(spark, path, fmt)
