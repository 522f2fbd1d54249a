"""``op1_repeats``: all documents without the 50-byte strings of documents before them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.registry import query
from foldwise.llm.repeats import removed_repeats


@query("op1_repeats")
def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_repeats(table(spark, sf_dir, "documents")).drop("spans")
