"""Intermediate results written once to shared storage.

A staged frame has no lineage, is read back by every executor, survives the loss
of any of them, and has a known size, so later broadcast decisions rest on facts.  Jobs
that write their result end with their staged folders removed, see ``scope``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FOLDER_SETTING = "spark.checkpoint.dir"


_own: list[str] = []


def use_folder(path: str) -> None:
    """Stage in ``path`` where a session has no setting; Spark fixes it when it starts."""
    _own[:] = [path]


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    All executors and the driver must share it, so there is no default.
    """
    folder = spark.conf.get(FOLDER_SETTING, None) or next(iter(_own), None)
    if not folder:
        raise ValueError(f"set {FOLDER_SETTING} to a folder that all executors share")
    return folder.rstrip("/")


# Folders made in each open ``scope``, the innermost last.
_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return folder


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Folders made inside are removed at the end, when what was made of them is written."""
    _scopes.append([])
    try:
        yield
    finally:
        configuration = spark._jsc.hadoopConfiguration()
        for folder in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(configuration).delete(path, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
