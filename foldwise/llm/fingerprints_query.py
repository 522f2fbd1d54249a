"""``op10_fingerprints``: Order MinHash of all documents, of their edited texts, and their likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.fingerprints import compared
from foldwise.llm.registry import query


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"), k=3, tuples=32, picks=2)
