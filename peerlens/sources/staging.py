"""Tables written to the shared folder to cut lineage between jobs.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  A
machine-local folder is used only by a local session that names none.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_root: list[str] = []
_making_root = threading.Lock()
# Of this thread or task: jobs that run side by side each have their own.
_scope: ContextVar[str | None] = ContextVar("staging_scope", default=None)


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    with _making_root:
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="peerlens-"))
    return _local_root[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name in the shared folder that nothing else uses."""
    home = _scope.get() or f"{shared_root(spark)}/peerlens"
    return f"{home}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Tables staged inside go to one folder, which is removed at the end.

    For jobs that write their results out; a DataFrame that still reads a
    staged table must not leave the scope.
    """
    home = new_folder(spark, label)
    outer = _scope.set(home)
    try:
        yield
    finally:
        _scope.reset(outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the stored table.

    Later passes (a row count, a statistics pass, the block join) then read
    columns from Parquet instead of repeating the whole upstream job, and a
    lost executor only costs the stages after this point.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
