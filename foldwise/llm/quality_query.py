"""``op9_quality``: how likely every document is of quality 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.folds import held_out
from foldwise.llm.quality import learn, score
from foldwise.llm.registry import query


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
