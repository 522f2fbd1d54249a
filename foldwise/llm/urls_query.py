"""``op6_urls``: the verdict on the address of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.registry import query
from foldwise.llm.urls import ALLOW, BLOCK, Rule, verdicts

RULES = [Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/")]


@query("op6_urls")
def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"), RULES)
