"""``op7_simhash``: groups of documents whose SimHash fingerprints differ by at most three bits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.registry import query
from foldwise.llm.simhash import near_duplicates


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3)
