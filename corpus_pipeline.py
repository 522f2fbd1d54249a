"""Documents to packed sequences: the stages of a training corpus, each over all its predecessor kept.

language ID -> line dedup -> SimHash near-dedup -> mixing to target weights -> best-fit packing. Every stage but the last returns the
columns of ``documents``; ``run`` writes each result as Parquet below the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.common import table
from foldwise.llm.language import OTHER, UNDETERMINED, identify, learn
from foldwise.llm.lines import drop_repeated_lines
from foldwise.llm.mixing import mix
from foldwise.llm.packing import pack
from foldwise.llm.packing_query import word_tokenizer
from foldwise.llm.simhash import first_of_each
from foldwise.sources.scratch import stored

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those in no language that the documents' labels name, go. The text stays as it is.

    Where no document has a language to learn from, only documents without letters go.
    """
    network = learn(docs, other=True)
    # the columns the operator adds must not replace the documents' own
    own = {c: f"__{c}" for c in docs.columns if c in ("lang_pred", "score")}
    found = identify(docs.withColumnsRenamed(own), network)
    if network:
        known = ~F.col("lang_pred").isin(UNDETERMINED, OTHER)
    else:
        known = F.exists(F.split(F.coalesce("text", F.lit("")), ""), lambda c: F.lower(c) != F.upper(c))
    return found.filter(known).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least five documents share stay in the last of them only; n_chars follows the text. No document goes."""
    kept = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest doc_id stays."""
    return first_of_each(docs, words=3, distance=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportions 5, 2, 1; a document taken twice is there twice."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, one row per piece of a document."""
    return pack(docs, word_tokenizer())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL can express neither the trained network nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
