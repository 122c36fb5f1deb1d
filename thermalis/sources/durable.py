"""Tables written once into the shared scratch folder.

A settled table cuts the lineage, survives the loss of executors, and has a size that Catalyst
knows: the joins that follow are broadcast only if the file size is under
``spark.sql.autoBroadcastJoinThreshold``; beyond it they are shuffle joins, whose hot keys AQE splits.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of the run that is on, below the scratch root.
_run: ContextVar[str | None] = ContextVar("scratch_run", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="thermalis-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    run = _run.get()
    return f"{scratch_root(spark)}/{f'{run}/' if run else ''}{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write df to a new scratch table and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """A run whose scratch tables go when it ends, well or not: what is read later must be written elsewhere before."""
    name = f"run-{uuid.uuid4().hex}"
    outer = _run.set(name)
    try:
        yield
    finally:
        _run.reset(outer)
        remove(spark, f"{scratch_root(spark)}/{name}")
