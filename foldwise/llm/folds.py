"""Held-out documents and bounded samples of labelled ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


#: of a label, each ranked by itself first
PARTS = 64


def remainder(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def held_out(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; false without an id."""
    return F.coalesce(remainder(column) == 1, F.lit(False))


def sample(labelled: DataFrame, label: str, per_label: int, most: int) -> list:
    """At most ``per_label`` rows of each label and ``most`` rows in all, by a hash of doc_id, with the columns of ``labelled``."""
    ranked = labelled.withColumn("__hash", F.xxhash64("doc_id"))
    if per_label > int(labelled.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        # above this, tasks do not limit their rows before the shuffle: first of each part of a label, then of what is left
        parted = ranked.withColumn("__part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)))
        nth = F.row_number().over(W.partitionBy(label, "__part").orderBy("__hash", "doc_id"))
        ranked = parted.withColumn("__nth", nth).filter(F.col("__nth") <= per_label).drop("__nth", "__part")
    nth = F.row_number().over(W.partitionBy(label).orderBy("__hash", "doc_id"))
    chosen = ranked.withColumn("__nth", nth).filter(F.col("__nth") <= per_label)
    return chosen.orderBy("__nth", label, "__hash").limit(most).drop("__nth", "__hash").collect()
