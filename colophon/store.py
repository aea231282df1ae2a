"""Scratch tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Folders that `scope` deletes when it ends; the innermost is the last.
_scopes: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder's URI under spark.checkpoint.dir, which every executor must reach.

    Only on one machine (tests) may that be unset: then a temporary folder is taken.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="colophon-")
        sc.setCheckpointDir(root)
    return f"{(_scopes[-1] if _scopes else root).rstrip('/')}/colophon-{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that scratch named, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is written under it in the shared folder is deleted at its end; a result must be written elsewhere before."""
    folder = scratch(spark)
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        delete(spark, folder)


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a result as a table in the shared folder and read it back: it is worked out once, and lost executors cost no recomputation of what is before."""
    spark = df.sparkSession
    path = path or scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
