"""``op12_similar``: links and components of all vectors with a cosine of 0.95 or more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.registry import query
from foldwise.llm.similar import near_vectors

SQL = """WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT r, vec_id, list_transform(v, lambda x: coalesce(x, 0.0)) AS v FROM numbered
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
  SELECT r AS a, r AS b, vec_id FROM numbered
  UNION
  SELECT reached.a, links.b, links.vec_id FROM reached JOIN links ON links.a = reached.b
), named AS (
  SELECT a, min(vec_id) AS component_id FROM reached GROUP BY a
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM numbered JOIN named ON named.a = r LEFT JOIN counted ON counted.a = r"""


@query("op12_similar", SQL)
def op12_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)
