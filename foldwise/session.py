"""A session for tests and the bench; on a cluster, use the session the cluster gives you."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="foldwise-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foldwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
