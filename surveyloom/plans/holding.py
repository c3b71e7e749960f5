"""Tables that several jobs of one analysis read again."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_held: list[DataFrame] = []
_scopes: list[list[DataFrame]] = [_held]
_local_folder: list[str] = []


def hold(df: DataFrame) -> DataFrame:
    """Keep ``df`` on executors (memory, then disk); a lost block is computed again from lineage."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    _scopes[-1].append(held)
    return held


@contextmanager
def owning(frames: list[DataFrame]):
    """Frames held inside belong to ``frames``, whose owner lets them go."""
    _scopes.append(frames)
    try:
        yield frames
    finally:
        _scopes.pop()


def release(frames: list[DataFrame]) -> None:
    while frames:
        frames.pop().unpersist()


def release_all() -> None:
    """Lets go of what no owner holds."""
    release(_held)


def shared_folder(spark: SparkSession) -> str:
    """A fresh path that all executors see: below spark.checkpoint.dir.

    Where that is unset, a local master gets a folder of its machine, cleaned up when the process
    ends; any other master is refused, as its executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="surveyloom-"))
            atexit.register(shutil.rmtree, _local_folder[0], ignore_errors=True)
        base = _local_folder[0]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The later jobs start from a columnar table: they read only their columns, their plans stay
    short, and losing executors costs nothing.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
