"""Helpers for materialising and joining small, bounded tables."""

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, functions as F

# About 10 MB of narrow rows: past this a side is joined by shuffle.
BROADCAST_ROWS = 100_000


def ensure_checkpoint_dir(spark) -> str:
    """Return the session's checkpoint folder; only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            folder = tempfile.mkdtemp(prefix="borelog-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_scratch = {}


def scratch_folder(spark) -> str:
    """A new folder name below the shared checkpoint folder; what is written there goes when the session's process ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4()}"
    _scratch[path] = spark
    return path


def remove_folder(spark, path: str) -> None:
    """Delete a folder that ``scratch_folder`` named; other folders are left alone."""
    if _scratch.pop(path, None) is not None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@atexit.register
def _remove_all() -> None:
    for path, spark in list(_scratch.items()):
        with contextlib.suppress(Exception):  # the session may have ended before
            remove_folder(spark, path)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Every later use sees the same rows, reads only the columns it needs, and does not depend on the executors that
    computed them. The files go at the end of the process, or earlier by ``remove_folder`` if the caller named ``path``.
    """
    spark = df.sparkSession
    path = path or scratch_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fetch a table meant to be small and mark it for broadcast; a larger one comes back as it was, for a shuffled join."""
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def same_keys(keys, prefix: str):
    """Equi-join condition between ``keys`` and their ``prefix``-ed namesakes, in which NULL meets NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"{prefix}{key}"))
    return condition
