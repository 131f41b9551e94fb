"""Shared storage for intermediate tables.

A cluster names a folder that every executor can reach in ``spark.checkpoint.dir``. Intermediate tables
live there as Parquet, so a lost executor costs a re-read, never a recomputation of the whole lineage, and
later steps still prune columns and push filters down. A session that names no folder uses that of its warehouse, if all
executors can reach it.

Each block of ``deleted_afterwards`` has a list of its own in the context of its thread, so that queries of several threads do not
delete each other's tables. Threads that a block starts take the list along with ``side_by_side``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINTS, _WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names for what executors share."""
    named = spark.conf.get(_CHECKPOINTS, None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get(_WAREHOUSE).rstrip("/")
    if re.match(r"file:|/", warehouse) and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {_CHECKPOINTS} to a folder that all executors reach; {warehouse} is on each machine")
    return warehouse


def application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/patronlens/{spark.sparkContext.applicationId}"


_scope: ContextVar[list[str | Callable[[], object]] | None] = ContextVar("scope", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    on_leaving(path)
    return path


def write_table(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet to a new path of the shared folder and return the path."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table read back; call it before a frame is used several times."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, label))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least one partition for each core: for work that costs far more a row than its shuffle, over a table of few files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it was there. Of several callers one succeeds."""
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    return files.createNewFile(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


@contextmanager
def deleted_afterwards(spark: SparkSession) -> Iterator[None]:
    """Delete every path made inside the block when it ends; write what should stay to a path made before."""
    own: list[str | Callable[[], object]] = []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        for item in reversed(own):
            item() if callable(item) else delete(spark, item)


def on_leaving(action: str | Callable[[], object]) -> None:
    """Call ``action``, or delete that path, when the block of ``deleted_afterwards`` around it ends."""
    own = _scope.get()
    if own is not None:
        own.append(action)


@contextmanager
def kept_afterwards() -> Iterator[list[str | Callable[[], object]]]:
    """Paths made inside this block stay, whatever block is around it. Gives the list of them, for ``delete`` when they are of no more use."""
    own: list[str | Callable[[], object]] = []
    token = _scope.set(own)
    try:
        yield own
    finally:
        _scope.reset(token)


def side_by_side(actions: list[Callable[[], object]], threads: int) -> list:
    """The results of ``actions``, at most ``threads`` at a time; what they write belongs to the block around the call."""
    if threads <= 1:
        return [action() for action in actions]
    with ThreadPoolExecutor(threads) as pool:
        return [future.result() for future in [pool.submit(copy_context().run, action) for action in actions]]


def drop_written(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; frames that read them stop working."""
    delete(spark, application_dir(spark))
