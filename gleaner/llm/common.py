"""What several operators share: checkpoints, documents' columns, batches of rows."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and the ASCII controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular expression for Spark (Java) and for SQL oracles.
SPACES_RE = r"[\x20\x09-\x0D]+"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the cluster's shared folder, spark.checkpoint.dir; on one machine to a folder of our own where it is unset."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="gleaner-checkpoints-")
    spark.sparkContext.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: computed once, and independent of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_stashed: set[tuple[int, str]] = set()


def stash(df: DataFrame) -> DataFrame:
    """Like ``cut``, for wide or long rows: a compressed Parquet table in the shared checkpoint folder, removed when the driver ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/gleaner-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _stashed:
        atexit.register(_drop_stashed, spark)
    _stashed.add((os.getpid(), path))
    return spark.read.schema(df.schema).parquet(path)


def _drop_stashed(spark: SparkSession) -> None:
    try:
        for pid, path in _stashed:
            if pid == os.getpid():
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before
        pass


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_held: dict = {}


def held(key, make):
    """A worker's large table (a codec, a vocabulary), made once and used by all tasks of one operator; one at a time."""
    if key not in _held:
        let_go()
        _held[key] = make()
    else:
        trim()
    return _held[key]


def let_go() -> None:
    """At the start of a task: give back the memory of the table of an operator that ran in this worker before."""
    lean()
    if _held:
        _held.clear()
        gc.collect()
    trim()


_lean: list[bool] = []


def lean() -> None:
    """Large arrays of this worker go back to the system as soon as they are freed, Arrow's too."""
    if _lean:
        return
    _lean.append(True)
    import pyarrow as pa

    pa.set_memory_pool(pa.system_memory_pool())
    if (libc := _libc()) is not None:
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD: from this size on a block is mapped by itself
        libc.mallopt(-1, 8 << 20)  # M_TRIM_THRESHOLD


def trim() -> None:
    if (libc := _libc()) is not None:
        libc.malloc_trim(0)


def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library
        return None


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
