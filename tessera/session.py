"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def attach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where it lies, where it isn't installed on the nodes."""
    root = str(Path(__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}" if known else root
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, which all executors share. Only a local session may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder := tempfile.mkdtemp(prefix="checkpoint-"))
    return folder.rstrip("/")


#: Folder under the shared one that takes the tables written now.
_TABLES: ContextVar[str] = ContextVar("tables", default="tables")


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder as Parquet and read again: cuts lineage, survives lost executors, and is made once."""
    path = f"{shared_folder(df.sparkSession)}/{_TABLES.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose written tables go when it ends, also by an error. It gives a function that writes a table to stay: what
    is used after the block must come from such tables alone."""
    outer = _TABLES.get()
    mine = f"{outer}/scratch-{uuid.uuid4().hex}"

    def kept(df: DataFrame) -> DataFrame:
        inner = _TABLES.set(outer)
        try:
            return written(df)
        finally:
            _TABLES.reset(inner)

    before = _TABLES.set(mine)
    try:
        yield kept
    finally:
        _TABLES.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{mine}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
