"""What the operators share: the white space of their contracts, tables read by name, numbers of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str = "text"):
    """The text's bytes; Python tasks then need no decoding. NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def tasks(spark: SparkSession, units: float, per_task: float) -> int:
    """How many partitions ``units`` need when a task should hold about ``per_task`` of them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-units // per_task)), 1)
