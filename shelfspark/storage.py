"""Tables in the folder that all executors share: cut lineage there, and delete what nobody reads any more."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
#: Open frames of this thread or task: what is to be deleted at their end, and whether that goes for kept tables, too.
_frames: ContextVar[tuple[tuple[list[str], bool], ...]] = ContextVar("frames", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only for a local master that has none."""
    sc = spark.sparkContext
    if configured := sc.getConf().get("spark.checkpoint.dir"):
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = made = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, made, True)
    return f"file://{_local_dirs[sc.applicationId]}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends there, so a lost executor costs only tasks of the current job.

    Inside of `scratch` the table is deleted at its end, unless it is to be kept for a result that is read later.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    for paths, kept_too in reversed(_frames.get()):
        if kept_too or not keep:
            paths.append(path)
            break
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, kept_too: bool = False) -> Iterator[None]:
    """Deletes at its end what materialise wrote in between, in this thread, and nobody reads any more; with kept_too also kept tables."""
    paths: list[str] = []
    before = _frames.set((*_frames.get(), (paths, kept_too)))
    try:
        yield
    finally:
        _frames.reset(before)
        for name in paths:
            delete(spark, name)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> tuple[DataFrame, str]:
    """What build() returns, written and read again, and its path; all tables that it was made from are deleted."""
    path = new_path(spark, label)
    with scratch(spark, kept_too=True):
        df = build()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path), path


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt out over all cores if its input has fewer partitions or files than that, as one small file has; other inputs stay where they are.

    Files are cut by bytes, but a row group is read by one task: a file that is one group fills one of its partitions only. With keys (nearly
    unique ones), rows go by their hash; without, the task that reads them sorts them first.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    even = parts >= cores and (len(df.inputFiles()) or parts) >= cores
    return df if even else df.repartition(max(cores, parts), *keys)
