"""Sessions, and the package's way to the executors."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(name: str = "gleaner", **conf: str) -> SparkSession:
    """A session with the settings that the plans are written for; conf overrides them."""
    builder = SparkSession.builder.appName(name)
    for k, v in ({"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"} | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="gleaner-"), "gleaner_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    context.addPyFile(path)
    _shipped.add(context.applicationId)


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


def cut(df):
    """The same rows, written to the shared checkpoint folder: computed once, and independent of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any path that Spark can open."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)
