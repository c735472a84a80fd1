"""Session for local runs; on a cluster the caller's own session is used as it is."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a session find this package, whatever folder the driver was started in.

    Workers on this machine are told where it lies; to others it is sent, once an application.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if context.master.startswith("local"):
        have = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if str(root) not in have:
            context.environment["PYTHONPATH"] = os.pathsep.join([str(root), *have])
    elif context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1].name
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), package), "zip", root, package))  # the driver serves the file
        _SHIPPED.add(context.applicationId)
    return spark


def local_session(cores: int | None = None, name: str = "leafmill") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEAFMILL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
