"""Where jobs keep written intermediate tables, and how wide they may fan out."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent only a local master may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
        folder = context.getCheckpointDir()
    return folder


# Folders of the open scratch scopes, the innermost last.
_scopes: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table, in the innermost open scope if there is one."""
    folder = _scopes[-1] if _scopes else shared_folder(spark).rstrip("/")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` has named."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Within this scope intermediate tables share a folder, which is removed at its end.

    For a stage that has written its results elsewhere by then.
    """
    folder = scratch_path(spark, "scratch")
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        remove(spark, folder)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the files.

    Used where several later steps read the same rows: it cuts the lineage, so a lost executor
    costs a re-read and not a recomputation, and unlike a cache it holds no executor memory.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """The shuffle width the session is tuned for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
