"""``op5_language``: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.folds import held_out
from foldwise.llm.language import identify, learn
from foldwise.llm.registry import query


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
