"""Stage tables: results that several later steps read.

A stage is a Parquet table in the shared folder named by ``spark.checkpoint.dir``. It
survives lost executors, cuts the lineage, and (unlike a row checkpoint) still prunes
columns and pushes filters. Stages live in one folder per application. A run that ends with
results of its own owns the stages written in it (``owned_stages``): those that its results
read stay, the others are deleted when it ends, and all of them when it fails.
"""

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}  # application id -> scratch folder, local master only
_owners: list["Owner"] = []  # runs that are under way, the innermost last


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables, from the session's own setting.

    Where it is unset, a session on one machine is given a scratch folder, with a warning;
    on a cluster that raises.
    """
    app = spark.conf.get("spark.app.id", "app")
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that every executor can reach")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="txrisk-")
            warnings.warn(f"{SETTING} is not set: stages go to {_local_roots[app]}", stacklevel=2)
        root = _local_roots[app]
    return f"{root.rstrip('/')}/txrisk-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table."""
    spark = df.sparkSession
    if path is None:
        path = new_path(spark, name)
        if _owners:
            _owners[-1].paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_at(spark: SparkSession, path: str):
    """(file system, path) of a folder, as Hadoop sees it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = files_at(spark, path)
    files.delete(folder, True)


class Owner:
    """The stages written during a run, and the results that still read some of them."""

    def __init__(self):
        self.paths: list[str] = []
        self.results: list[DataFrame] = []

    def keep(self, *results: DataFrame) -> None:
        self.results += results

    def read(self) -> set[str]:
        """Stages that the kept results read."""
        files = [f for df in self.results for f in df.inputFiles()]
        return {p for p in self.paths if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in files)}


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[Owner]:
    """A run whose stages go when it ends, but for those read by results it ``keep``s.

    The stages that are left belong to the run around it, if there is one.
    """
    owner = Owner()
    _owners.append(owner)
    left: set[str] = set()
    try:
        yield owner
        left = owner.read()
    finally:
        _owners.remove(owner)
        for path in owner.paths:
            if path not in left:
                _delete(spark, path)
        if _owners:
            _owners[-1].paths += sorted(left)


def drop_stages(spark: SparkSession) -> None:
    """Delete this application's stage folder, once its results are no longer read."""
    _delete(spark, stage_root(spark))
