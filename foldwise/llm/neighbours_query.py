"""``op4_neighbours``: the 20 nearest vectors of every twentieth one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.neighbours import nearest
from foldwise.llm.registry import query

FACTOR = 1.1

# exact: the search at FACTOR finds all of them in tables of this size
SQL = """WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding::DOUBLE[], lambda x: coalesce(x, 0.0)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20"""


@query("op4_neighbours", SQL)
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20, k=20, factor=FACTOR)
