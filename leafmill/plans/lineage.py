"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where that setting is absent and all work is on this machine (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        own = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN[app] = "file://" + own
    return _OWN[app]


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/leafmill/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing stands at yet."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def files(spark: SparkSession, path: str) -> list[str]:
    """The data files right in a folder, by name."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().toString() for f in found if f.isFile() and f.getPath().getName()[0] not in "._")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Later jobs start from the written files, so a lost executor costs a re-read and never a recomputation, and
    a table used by several jobs is computed once.  Column order and types are kept.
    """
    path = scratch(df.sparkSession, name)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Delete the tables that this application has cut; only when none of its results is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
